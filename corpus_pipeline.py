"""A corpus pipeline of five operators: quality, near duplicates, benchmark passages, personal data, tokens."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.llm import bpe, decontam, pii, quality, simhash
from runweave.llm.common import stored, table
from runweave.llm.queries import PII_KEY


#: Rows and bytes of an Arrow batch between Spark and Python workers. Whole texts differ much in size, and what
#: buffers of some hundred MB leave behind stays with an executor.
ARROW_ROWS, ARROW_BYTES = 1000, "4m"


def small_batches(stage):
    """The stage, with the session told to send rows to Python in small batches."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, learnt from the labelled ones among them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


@small_batches
def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return simhash.keep_one(docs, words=4, max_bits=4)


@small_batches
def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"), width=13, share=20)


@small_batches
def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` follows the new text."""
    new = pii.replace(docs, PII_KEY, count=None)
    if "n_chars" in new.columns:
        new = new.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return new


@small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with their digests."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one),
    ("decontamination", keep_uncontaminated),
    ("personal data", replace_personal_data),
    ("tokens", encode),
]

#: No SQL: it cannot fit the classifier, rewrite the texts or encode them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
