"""The Merkle manifest against a plain recursion, and against its SQL twin."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from runweave.llm import merkle
from runweave.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, text):
    fields = [doc["doc_id"], doc["source"], doc["lang"], doc["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(nodes):
    """Root, and the (before, after) pairs of each node from the bottom."""
    if len(nodes) == 1:
        return nodes[0], [[]]
    runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
    root, above = tree([sha(*r) for r in runs])
    paths = []
    for r, path in zip(runs, above):
        paths += [[("".join(r[:i]), "".join(r[i + 1 :])), *path] for i in range(len(r))]
    return root, paths


def folded(path, at):
    for before, after in path:
        at = sha(before, at, after)
    return at


def expected(docs):
    by = {}
    for d in docs:
        by.setdefault(d["source"], []).append(d)
    out, sources = [], sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = []
    for s in sources:
        by[s].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d, d["text"])))
        subs.append(tree([leaf(d, d["text"]) for d in by[s]]))
    root, above = tree([sub for sub, _ in subs])
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for s, (sub, paths), top in zip(sources, subs, above):
        for d, path in zip(by[s], paths):
            path = [*path, *top]
            text = d["text"]
            if d["doc_id"] is not None and text is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0:
                text = text.translate(low)
            start = leaf(d, text)
            own = leaf(d, d["text"])
            proof = sha(*[x for pair in path for x in pair])
            back = folded(path, start)
            out.append((d["doc_id"], own, sub, root, proof, back, back == root))
    return sorted(out, key=repr)


def run(spark, docs):
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"]) for d in docs]
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("key", "idx", "n", "digest", "row", "path"):
        df = df.withColumn(extra, F.lit(1))
    made = merkle.manifest(df, merkle.every_fifth(), merkle.ascii_lower(F.col("text")))
    return sorted((tuple(r) for r in made.collect()), key=repr)


def doc(i, source="a", text="Some Text", lang="en", n=9):
    return {"doc_id": i, "source": source, "text": text, "lang": lang, "n_chars": n}


CASES = {
    "one row": [doc(1)],
    "one source of two levels": [doc(i, text=f"T {i}") for i in range(16 * 3 + 1)],
    "sizes around the fanout": [
        doc(1000 * k + i, source=s, text=f"É{i}")
        for k, (s, n) in enumerate([("x", 1), ("b", 15), ("ß", 16), ("", 17), (None, 257), ("Z", 32)])
        for i in range(n)
    ],
    "many sources": [doc(i, source=f"s{i % 40}", text="Aa") for i in range(90)],
    "nulls, empty and long texts, repeated rows": [
        doc(None), doc(None, None, None, None, None), doc(5, text=""), doc(5, text=None), doc(5, text="-"),
        doc(6), doc(6), doc(6), doc(7, text="A long one " * 200_000), doc(-3, n=-1), doc(2**62),
    ],
}


@pytest.mark.parametrize("name", CASES)
def test_against_recursion(spark, name):
    assert run(spark, CASES[name]) == expected(CASES[name])


def test_empty_table(spark):
    assert run(spark, []) == []


def test_only_changed_texts_fail(spark, sf_dir):
    made = QUERIES["op11_merkle"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = docs.where(merkle.every_fifth() & (merkle.ascii_lower(F.col("text")) != F.col("text")))
    wrong = {r.doc_id for r in made.where("not verified").collect()}
    assert wrong == {r.doc_id for r in changed.select("doc_id").collect()} and wrong


def test_sql_twin(spark, sf_dir):
    con = connect(sf_dir)
    assert not differences(QUERIES["op11_merkle"](spark, sf_dir), ORACLE["op11_merkle"], con)
