"""The registered queries of this subpackage: thin, each gets its rows through its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.llm import bpe, decontam, licenses, merkle, negatives, pii, quality, simhash, tokens, toxicity, urls, vectors, warc
from runweave.llm.common import table
from runweave.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, equal payloads once; length and digest of what is read back."""
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages"), least_bytes=0), path)
    return warc.verified(spark, path).select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


#: The key of the registered queries; whoever publishes surrogates passes a secret one.
PII_KEY = b"key of the registered queries"


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for personal data, and how many it had."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, PII_KEY)


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the head, tables and body of every document; one on a border goes where most of it is."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    parts = tokens.attribute(docs, ranks, public_tokenizers.PATTERN, "most", tokens.line_sections)
    return tokens.by_kind(parts)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the fold that is held out teach nothing."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(docs, labels, threshold=0.3)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, links at 4 bits or fewer."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a cosine of 0.95 or more, and the components they make, of every vector."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document: id, license, containment and place."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.template_table(spark)).drop("key")


def op9_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of 13-word windows of the benchmark in every document."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.contamination(docs, benchmark, width=13, share=20).drop("key")


def op9_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of benchmark items whose rare words stand near each other, of every document."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.near_items(docs, benchmark, width=13, slack=3).drop("key")


#: Rules as (host, path, verdict); the longest that fits a url wins.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, urls.train(labelled))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a changed text leads to."""
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.every_fifth(), merkle.ascii_lower(F.col("text")))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the fold that is held out teach nothing."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(docs, labels, threshold=0.3)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, after one in seven labels has moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_pii": op2_pii,
    "op3_tokens": op3_tokens,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_vectors": op6_vectors,
    "op7_bpe": op7_bpe,
    "op8_licenses": op8_licenses,
    "op9_decontam": op9_decontam,
    "op9_proximity": op9_proximity,
    "op10_urls": op10_urls,
    "op11_merkle": op11_merkle,
    "op12_toxicity": op12_toxicity,
    "op13_negatives": op13_negatives,
}
ORACLE: dict[str, str] = {"op1_warc": warc.ORACLE_SQL, "op9_decontam": decontam.ORACLE_SQL, "op11_merkle": merkle.ORACLE_SQL}
