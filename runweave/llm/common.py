"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, so that neither a lost executor nor a second use computes ``df`` again, and
    gives the optimizer the table's true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_batches(
    batches: Iterable[pa.RecordBatch], column: str | int, most_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one hold about ``most_bytes``, and one text at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        first = held = 0
        for i, size in enumerate(sizes):
            if i > first and held + size > most_bytes:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        yield batch.slice(first)


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, made longer until no column has it, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a schema given as DDL."""
    return df.mapInArrow(fn, schema)


def content_key(text: str = "text"):
    """128 bits that stand for a whole text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


#: A table of no more rows than this is sent to all executors; a larger one takes part in a shuffled join.
SMALL_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its rows, counted, are few; ``df`` is cheap to count (stored)."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


#: Bytes that a table of rows of any size may have to be sent to all executors.
SMALL_BYTES = 32 << 20


def small_in_bytes(df: DataFrame, size: Column) -> DataFrame:
    """``df`` with a broadcast hint if ``size``, the bytes of a row, adds up to little; for rows without a bound."""
    whole = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if whole <= SMALL_BYTES else df
