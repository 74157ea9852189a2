"""Pages, totals and sorted listings. Every order ends in a unique id."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_offset(
    df: DataFrame, order_by: Sequence[str | Column], offset: int = 0, limit: int = 0
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the ordered table; ``limit`` 0 means all.

    A page is a top-k of ``offset + limit`` rows; for deep pages use :func:`page_after`.
    """
    if limit < 0 or offset < 0:
        raise ValueError("`limit` and `offset` cannot be negative")
    out = df.orderBy(*order_by)
    if offset:
        out = out.offset(offset)
    return out.limit(limit) if limit else out


def page_no(
    df: DataFrame, order_by: Sequence[str | Column], page: int = -1, size: int = 10
) -> DataFrame:
    """Page ``page`` (from 1; 0 and -1 are the first) of ``size`` rows."""
    if size <= 0:
        raise ValueError("page size must be positive")
    if page < -1:
        raise ValueError("page must be -1 or more")
    return page_offset(df, order_by, offset=(max(page, 1) - 1) * size, limit=size)


def page_after(
    df: DataFrame, order_by: Sequence[str], last: Sequence[Any] | None, limit: int
) -> DataFrame:
    """The next ``limit`` rows after the key ``last``: a pushed-down range filter, so any depth
    costs the same. Order columns are non-null."""
    if last is not None:
        later: Column | None = None
        for i in reversed(range(len(order_by))):
            col, value = F.col(order_by[i]), F.lit(last[i])
            later = col > value if later is None else (col > value) | ((col == value) & later)
        # The first column alone is a plain comparison, which Parquet can use.
        df = df.where(F.col(order_by[0]) >= F.lit(last[0])).where(later)
    return page_offset(df, order_by, limit=limit)


def page_totals(df: DataFrame, limit: int) -> DataFrame:
    """One row: ``total`` rows and ``total_pages`` of ``limit`` rows (1 when ``limit`` is 0)."""
    if limit < 0:
        raise ValueError("`limit` cannot be negative")
    pages = F.ceil(F.col("total") / limit) if limit else F.lit(1)
    return df.agg(F.count(F.lit(1)).alias("total")).withColumn(
        "total_pages", pages.cast("bigint")
    )


def sort_listing(df: DataFrame, sort: str, id_column: str) -> DataFrame:
    """Order by a named column, then id; an unknown column leaves the table as it is."""
    if sort not in df.columns:
        return df
    return df.orderBy(sort, id_column)
