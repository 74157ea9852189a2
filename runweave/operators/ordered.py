"""Ordinals, look-backs and equi-joins that survive a hot key.

A plain window over ``partitionBy(key)`` sends every row of one key to one task. Here the rows of each key
are counted first. Keys that fit a task, which mostly is all of them, get the plain window. A key of
more rows is cut into buckets at measured quantiles of its order, so that a burst is cut like a calm
time: the window runs inside a bucket, and one summary row per (key, bucket) carries the result over the
boundary. Summaries number one for each key and each cut.

Group keys must be non-null ids. Rows of one key with the very same value of the measured order stay in
one bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"

#: Rows of one key that one task may hold.
TASK_ROWS = 2_000_000


def micros(ts: str | Column = "ts") -> Column:
    """A time as a number, for measuring."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def with_bucket(
    df: DataFrame, by: Sequence[str], measure: Column, rows: int = TASK_ROWS
) -> tuple[DataFrame, bool]:
    """``df`` with the bucket of each row, and whether any key was cut.

    ``measure`` is a number that does not decrease along the order. One count per key, combined in the
    map tasks, decides; only the largest count comes to the driver. The cuts of keys with more than
    ``rows`` rows are approximate quantiles of ``measure``; a wrong guess shifts a border, never a result.
    """
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.where(F.col("__n") > rows).select(*by, "__n")
    most = hot.agg(F.max("__n")).first()[0]
    if most is None:
        return df.withColumn(BUCKET, F.lit(0)), False
    pieces = math.ceil(most / rows)
    marks = [i / pieces for i in range(1, pieces)]
    cuts = (
        df.select(*by, measure.cast("bigint").alias("__m"))
        .join(hot.drop("__n"), [*by], "left_semi")
        .groupBy(*by)
        .agg(F.percentile_approx("__m", marks, max(100, 10 * pieces)).alias("__cuts"))
    )
    place = F.size(F.filter("__cuts", lambda c: c < measure))
    cut = df.join(cuts, [*by], "left").withColumn(
        BUCKET, F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(place)
    )
    return cut.drop("__cuts"), True


def spread_rows(df: DataFrame, by: Sequence[str], count: int, rows: int = TASK_ROWS) -> DataFrame:
    """The ``count`` rows of ``df`` shuffled by ``by``, ``rows`` or fewer to a task on average.

    Partitions of a fixed number, or merged by their compressed size, would give a task more rows with more input.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(count / rows)), *by)


def _attach_carry(local: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, BUCKET]
    names = {k: f"__c_{i}" for i, k in enumerate(keys)}
    right = carry.select(*[F.col(k).alias(n) for k, n in names.items()], "__carry")
    on = None
    for key, name in names.items():
        cond = local[key] == right[name]
        on = cond if on is None else on & cond
    return local.join(right, on, "left").drop(*names.values())


def with_ordinal(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    measure: Column,
    name: str = "x",
    rows: int = TASK_ROWS,
) -> DataFrame:
    """0-based position of each row inside its key; ``measure`` as in :func:`with_bucket`."""
    df, cut = with_bucket(df, by, measure, rows)
    position = (F.row_number().over(Window.partitionBy(*by, BUCKET).orderBy(*order_by)) - 1).cast("bigint")
    local = df.withColumn(name, position)
    if not cut:
        return local.drop(BUCKET)
    before = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        df.groupBy(*by, BUCKET)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__carry", F.sum("__n").over(before))
    )
    return (
        _attach_carry(local, carry, by)
        .withColumn(name, F.col(name) + F.coalesce("__carry", F.lit(0)))
        .drop(BUCKET, "__carry")
    )


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[str],
    measure: Column,
    value: str,
    name: str = "previous",
    rows: int = TASK_ROWS,
) -> DataFrame:
    """``value`` of the row before, null on the first row of a key. ``value`` is non-null."""
    df, cut = with_bucket(df, by, measure, rows)
    inside = Window.partitionBy(*by, BUCKET).orderBy(*order_by)
    local = df.withColumn(name, F.lag(value).over(inside))
    if not cut:
        return local.drop(BUCKET)
    # One plain column keeps the aggregation hashed; a struct would have to be sorted.
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)
    across = Window.partitionBy(*by).orderBy(BUCKET)
    carry = (
        df.groupBy(*by, BUCKET)
        .agg(F.max_by(value, order).alias("__last"))
        .withColumn("__carry", F.lag("__last").over(across))
    )
    return (
        _attach_carry(local, carry, by)
        .withColumn(name, F.coalesce(name, "__carry"))
        .drop(BUCKET, "__carry")
    )


def hot_keys(df: DataFrame, on: Sequence[str], pieces: int) -> DataFrame:
    """Keys with more than 1/``pieces`` of the rows, so fewer than ``pieces`` keys, and in
    ``__salts`` how many average partitions each would fill.

    Reads the key columns only and counts in the map tasks first. Rows without a key do not count.
    """
    counts = df.na.drop(subset=[*on]).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    share = F.col("__n") * pieces / total
    return counts.where(share > 1).select(*on, F.ceil(share).cast("int").alias("__salts"))


def spread_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    pieces: int | None = None,
) -> DataFrame:
    """Equi-join rows to a table with few rows per key when one key may hold much of ``fact``.

    A hot key's rows are split into about as many pieces as average partitions they would fill,
    and only the few ``dim`` rows of hot keys are repeated, ``2 * pieces`` times in all at most.
    The hot keys number less than ``pieces`` (by default the shuffle partitions), which is the
    proof that they can be broadcast. The piece of a row follows from its map partition and
    ``spread_by``, so copies of one row spread too and a task that runs again repeats its choice.
    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    if pieces is None:
        pieces = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(fact, on, pieces))
    absent = F.lit(False)
    for key in on:
        absent = absent | F.col(key).isNull()
    # Rows without a key match nothing and may lie anywhere.
    parts = F.when(absent, F.lit(pieces)).otherwise(F.coalesce("__salts", F.lit(1)))
    spot = F.xxhash64(F.spark_partition_id(), *spread_by)
    salted = (
        fact.join(hot, [*on], "left")
        .withColumn("__salt", F.pmod(spot, parts).cast("int"))
        .drop("__salts")
    )
    repeated = (
        dim.join(hot, [*on], "left")
        .withColumn(
            "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
        )
        .drop("__salts")
    )
    return salted.join(repeated, [*on, "__salt"], how).drop("__salt")
