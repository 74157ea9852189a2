"""The corpus pipeline end to end on odd rows, and its stages one by one."""

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from runweave.llm import bpe, simhash
from tests.llm.test_texts import PATTERN, RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __key string, key string, moved string"


def rows(spark, sf_dir):
    """The given documents with helper-like columns, and odd ones."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    prose = docs.orderBy(F.desc("n_chars")).first().text
    mail = prose[:1500] + " Write to jane.doe@mail.example.com or call +1 415-555-0199."
    odd = [
        (None, prose[:1200]), (90001, None), (90002, ""), (90003, prose), (90003, prose), (90004, mail), (90005, prose * 40),
        (90006, " " * 100_000), (90007, "a" * 100_000),
    ]
    more = spark.createDataFrame([(i, t, None, None, None, "k", "k", "m") for i, t in odd], SCHEMA)
    given = docs.withColumns({c: F.lit("x") for c in ("__key", "key", "moved")})
    return given.unionByName(more)


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    """What each stage was given and returned, written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = rows(spark, sf_dir), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        made = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs.collect(), made.collect(), docs.columns, made.columns))
        docs = made
    return out


def test_columns_stay(results):
    for name, _, _, before, after in results[:-1]:
        assert before == after, name


def test_filters_only_drop_rows(results):
    for name, before, after, *_ in results[:3]:
        assert 0 < len(after) <= len(before), name
        left = [tuple(r) for r in before]
        for r in after:
            left.remove(tuple(r))


def test_one_of_each_group_stays(results):
    name, before, after, *_ = results[1]
    texts = [r.text for r in after if r.text]
    assert len(texts) == len(set(texts)) and set(r.doc_id for r in after) <= set(r.doc_id for r in before)
    assert [r.doc_id for r in after].count(90003) <= 1


def test_personal_data_goes(results):
    name, before, after, *_ = results[3]
    assert len(before) == len(after)
    new = {r.doc_id: r for r in after}
    for r in before:
        if r.text and "jane.doe@mail.example.com" in r.text:
            got = new[r.doc_id]
            assert "jane.doe@" not in got.text and "555-0199" not in got.text and got.n_chars == len(got.text)


def test_ids_are_those_of_the_reference_tokenizer(results):
    name, before, after, *_ = results[4]
    ranks = bpe.vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))).ranks
    reference = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = sorted(reference.encode_ordinary(r.text or "") for r in before)
    assert sorted(list(r.ids) for r in after) == texts and len(before) == len(after)


def test_empty_tables(spark, sf_dir, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0


def test_encode_and_decode_with_clashing_names(spark):
    df = spark.createDataFrame([("Some text", 1, 2)], "text string, __text int, __ids int")
    made = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS)
    assert made.first().decoded == b"Some text" and {"__text", "__ids"} <= set(made.columns)


def test_near_duplicates_send_no_cells_to_the_driver(spark, sf_dir, monkeypatch):
    """The cells of all documents are joined by a shuffle, however small Spark takes them for."""
    plans, write = {}, simhash.stored

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(simhash, "stored", watched)
    corpus_pipeline.keep_one(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    assert "SortMergeJoin" in plans["simhash-links"] and "Broadcast" not in plans["simhash-links"]
