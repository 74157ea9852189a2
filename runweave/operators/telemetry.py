"""Requests, latency regions, heartbeats, system samples and retried records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from runweave.operators.ordered import BUCKET, TASK_ROWS, micros, spread_rows, with_bucket, with_previous
from runweave.schemas import HEARTBEAT_SECONDS, UNLOGGED_PATHS


def request_filter(requests: DataFrame) -> DataFrame:
    """Logged requests: HTTP, and not one of the two service paths."""
    return requests.where((F.col("type") == "http") & ~F.col("path").isin(UNLOGGED_PATHS))


def template_pattern(template: str) -> str:
    """Regular expression of a path template: each ``{name}`` is one word, the rest as written."""
    fixed = re.split(r"\{[^{}]*\}", template)
    return r"(?dU)^" + r"\w+".join(fixed) + "$"


def route_match(requests: DataFrame, templates: Sequence[str], path: str = "path") -> DataFrame:
    """Add ``route``: the first template, in the given order, that the path fits; else null.

    The templates of an API are a short driver-side list, so they compile to one CASE expression
    and no join takes place.
    """
    if not templates:
        return requests.withColumn("route", F.lit(None).cast("string"))
    first, *rest = [(F.col(path).rlike(template_pattern(t)), F.lit(t)) for t in templates]
    chain = reduce(lambda c, pair: c.when(*pair), rest, F.when(*first))
    return requests.withColumn("route", chain)


def route_latency(requests: DataFrame, templates: Sequence[str]) -> DataFrame:
    """Requests, failures and latency (ns) per route."""
    matched = route_match(request_filter(requests), templates)
    return matched.groupBy("route").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("failed").alias("exceptions"),
        F.avg("latency_ns").alias("mean_ns"),
        F.max("latency_ns").alias("max_ns"),
    )


def region_latency(
    events: DataFrame,
    thread: str = "thread",
    order_by: Sequence[str] = ("ts", "region"),
    rows: int = TASK_ROWS,
) -> DataFrame:
    """Elapsed seconds of each region from ENTER and LEAVE events, with its nesting level.

    Inside one span of one thread, a LEAVE closes the last ENTER of its level. What stays open at
    the edges of a span (at most a stack on either side) is matched in a second, far smaller
    step, so a busy thread is never one task. Spans are spread over as many tasks as all events
    ask for, so what a task sorts does not grow with the input. Regions still open have no ``leave_ts``.
    ``order_by`` starts with ``ts`` and tells all events of a thread apart.
    """
    here = [thread, BUCKET]
    order = list(order_by)
    enters = F.col("kind") == "ENTER"
    inside = Window.partitionBy(*here).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The level before an ENTER and after a LEAVE, relative to the start of the span.
    bucketed, cut = with_bucket(events.where(F.col(thread).isNotNull()), [thread], micros("ts"), rows)
    leveled = (
        spread_rows(bucketed, here if cut else [thread], events.count(), rows)
        .withColumn("__delta", F.when(enters, 1).otherwise(-1))
        .withColumn("__level", F.sum("__delta").over(so_far) - enters.cast("int"))
    )
    near = _pair_regions(leveled, Window.partitionBy(*here, "__level").orderBy(*order))

    if not cut:
        # A level alternates between ENTER and LEAVE, so one whole span leaves nothing to match.
        return _regions(near.where(F.when(enters, ~F.col("__left")).otherwise(F.col("__enter_ts").isNotNull())), thread)

    across = (
        Window.partitionBy(thread).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    start = (
        leveled.groupBy(*here)
        .agg(F.sum("__delta").alias("__shift"))
        .select(*here, F.coalesce(F.sum("__shift").over(across), F.lit(0)).alias("__start"))
    )
    absolute = near.join(start, here).withColumn("__level", F.col("__level") + F.col("__start"))

    unmatched = F.when(enters, ~F.col("__left")).otherwise(F.col("__enter_ts").isNull())
    edges = absolute.where(unmatched).drop("__enter_ts", "__enter_region", "__left")
    far = _pair_regions(edges, Window.partitionBy(thread, "__level").orderBy(*order))

    closed = absolute.where(~enters & F.col("__enter_ts").isNotNull())
    crossing = far.where(F.when(enters, ~F.col("__left")).otherwise(F.col("__enter_ts").isNotNull()))

    return _regions(closed, thread).unionByName(_regions(crossing, thread))


def _regions(events: DataFrame, thread: str) -> DataFrame:
    """A region for each LEAVE that closes an ENTER and each ENTER that stays open."""
    enters = F.col("kind") == "ENTER"
    elapsed = (F.unix_micros("leave_ts") - F.unix_micros("enter_ts")) / 1e6
    return events.select(
        thread,
        F.when(enters, F.col("region")).otherwise(F.col("__enter_region")).alias("region"),
        F.col("__level").cast("bigint").alias("level"),
        F.when(enters, F.col("ts")).otherwise(F.col("__enter_ts")).alias("enter_ts"),
        F.when(~enters, F.col("ts")).alias("leave_ts"),
    ).withColumn("elapsed", elapsed)


def _pair_regions(events: DataFrame, same_level: WindowSpec) -> DataFrame:
    """Look at the neighbours of one level: the ENTER that a LEAVE closes, and whether an ENTER
    is closed (``__left``)."""
    entered = F.lag("kind").over(same_level) == "ENTER"
    return (
        events.withColumn("__enter_ts", F.when(entered, F.lag("ts").over(same_level)))
        .withColumn("__enter_region", F.when(entered, F.lag("region").over(same_level)))
        .withColumn(
            "__left", F.coalesce(F.lead("kind").over(same_level) == "LEAVE", F.lit(False))
        )
    )


def heartbeat_gaps(
    beats: DataFrame,
    by: str = "tracker_id",
    period_seconds: float = HEARTBEAT_SECONDS,
    factor: float = 1.0,
    rows: int = TASK_ROWS,
) -> DataFrame:
    """Silences longer than ``factor`` periods: previous beat, next beat and gap in seconds."""
    looked = with_previous(beats, [by], ["ts"], micros("ts"), "ts", "previous", rows)
    gap = (F.unix_micros("ts") - F.unix_micros("previous")) / 1e6
    return (
        looked.withColumn("gap_seconds", gap)
        .where(F.col("gap_seconds") > factor * period_seconds)
        .select(by, "previous", "ts", "gap_seconds")
    )


def heartbeat_sessions(
    beats: DataFrame,
    timeout_seconds: float,
    by: str = "tracker_id",
    rows: int = TASK_ROWS,
) -> DataFrame:
    """Spans of liveness: beats no further apart than the timeout.

    Sessions are built inside each measured bucket of a key first. Only the first and the last one of
    a bucket can go on beyond it, so only those are merged per key: two rows per bucket however often a
    key falls silent. The end is the last beat plus the timeout, as session windows report it.
    """
    timeout = int(timeout_seconds * 1_000_000)
    us = F.unix_micros("ts")
    inside = Window.partitionBy(by, BUCKET).orderBy("__us")
    opened = F.coalesce(
        (F.col("__us") - F.lag("__us").over(inside) >= timeout).cast("int"), F.lit(1)
    )
    bucketed, _ = with_bucket(beats.select(by, us.alias("__us")), [by], F.col("__us"), rows)
    local = (
        bucketed
        .withColumn("__open", opened)
        .withColumn("__s", F.sum("__open").over(inside))
        .groupBy(by, BUCKET, "__s")
        .agg(
            F.min("__us").alias("__first"),
            F.max("__us").alias("__last"),
            F.count(F.lit(1)).alias("__beats"),
        )
    )
    sessions_here = Window.partitionBy(by, BUCKET)
    edge = (F.col("__s") == 1) | (F.col("__s") == F.max("__s").over(sessions_here))
    local = local.withColumn("__edge", edge)

    across = Window.partitionBy(by).orderBy("__first")
    reopened = F.coalesce(
        (F.col("__first") - F.lag("__last").over(across) >= timeout).cast("int"), F.lit(1)
    )
    merged = (
        local.where("__edge")
        .withColumn("__open", reopened)
        .withColumn("__session", F.sum("__open").over(across))
        .groupBy(by, "__session")
        .agg(
            F.min("__first").alias("__first"),
            F.max("__last").alias("__last"),
            F.sum("__beats").alias("__beats"),
        )
        .drop("__session")
    )
    whole = local.where(~F.col("__edge")).select(by, "__first", "__last", "__beats")
    return merged.unionByName(whole).select(
        by,
        F.timestamp_micros("__first").alias("session_start"),
        F.timestamp_micros(F.col("__last") + timeout).alias("session_end"),
        F.col("__beats").alias("beats"),
    )


def system_metrics(samples: DataFrame, gpus: Sequence[int] = ()) -> DataFrame:
    """One row per (host, ts): mean CPU use, memory in whole MB, and each GPU's use.

    Samples may also have ``memory_available_bytes``, ``memory_percent`` and ``disk_percent``, and of
    GPUs ``gpu_memory_free_bytes`` and ``gpu_memory_used_bytes``; those that they have are reported.
    """
    has = samples.columns

    def megabytes(column: Column | str) -> Column:
        return F.call_function("div", F.max(column), F.lit(1024 * 1024))

    columns = [F.avg("cpu_usage").alias("cpu_usage"), megabytes("memory_bytes").alias("memory_usage_mb")]
    if "memory_available_bytes" in has:
        columns.append(megabytes("memory_available_bytes").alias("memory_available_mb"))
    for source, name in (("memory_percent", "memory_percentage"), ("disk_percent", "disk_utilisation")):
        if source in has:
            columns.append(F.max(source).alias(name))
    for i in gpus:
        mine = F.col("gpu") == i
        columns.append(F.max(F.when(mine, F.col("gpu_usage"))).alias(f"gpu-{i}_usage"))
        for source, name in (("free", "available"), ("used", "usage")):
            if f"gpu_memory_{source}_bytes" in has:
                value = F.when(mine, F.col(f"gpu_memory_{source}_bytes"))
                columns.append(megabytes(value).alias(f"gpu-{i}_memory_{name}_mb"))
    return samples.groupBy("host", "ts").agg(*columns)


def downsample(
    samples: DataFrame, every_seconds: int, by: Sequence[str], value_columns: Sequence[str],
    tie_break: str,
) -> DataFrame:
    """At most one sample, the newest, per key and time slot. Combined before the shuffle."""
    slot = F.window("ts", f"{every_seconds} seconds")
    newest = F.max_by(F.struct("ts", *value_columns), F.struct("ts", tie_break))
    return (
        samples.groupBy(*by, slot.alias("slot"))
        .agg(newest.alias("s"))
        .select(*by, F.col("slot.start").alias("slot"), "s.*")
    )


def dedupe_retries(logs: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """One row per ``log_id`` from an at-least-once feed: the first by time.

    The copies of an id are reduced in each map task, so many copies of one id cost one row each.
    """
    row = F.struct("ts", *value_columns)
    # The text of a row orders copies of one time, for maps have no order of their own.
    first = F.min_by(row, F.struct("ts", F.to_json(row).alias("tie")))
    return logs.groupBy("log_id").agg(first.alias("r")).select("log_id", "r.*")


def node_latest(updates: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """Last write per (run, node): newest by ``ts``, then ``seq``."""
    newest = F.max_by(F.struct("ts", *value_columns), F.struct("ts", "seq"))
    return (
        updates.groupBy("run_id", "id").agg(newest.alias("n")).select("run_id", "id", "n.*")
    )
