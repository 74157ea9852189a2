"""Live tables: record feeds, deduplication, sampling, liveness and status as streams.

Each stream has a batch twin in ``runweave.operators``. All state is kept by Structured Streaming in
the checkpoint folder, which must be on shared storage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from runweave.operators.logs import reject_after_completed
from runweave.operators.telemetry import request_filter, route_match
from runweave.operators.trackers import tracker_status
from runweave.schemas import LOGS
from runweave.sources.tailing import RANGE_BYTES, tail_lines

BATCH = "batch_id"

#: Sinks take the present input and end, unless the caller names another trigger, such as
#: ``{"processingTime": "10 seconds"}`` to go on for as long as the query lives.
ONCE: Mapping[str, Any] = {"availableNow": True}


def stream_logs(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = LOGS,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Records as a stream from the files that land in a folder."""
    reader = spark.readStream.schema(schema).format(format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def live_request_logs(requests: DataFrame, templates: Sequence[str]) -> DataFrame:
    """One live record per served request: id, path, route and latency."""
    kept = route_match(request_filter(requests), templates)
    return kept.select("id", "path", "route", "latency_ns", "ts")


def append_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, Any] = ONCE
) -> StreamingQuery:
    """Append a stream to Parquet, exactly once."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def update_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, Any] = ONCE
) -> StreamingQuery:
    """Write the changed rows of every batch to a folder of its own.

    A batch that runs again overwrites its folder, so results are exactly-once. Read the table with
    :func:`current_rows`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        df.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest row per key of a table written by :func:`update_stream`."""
    changes = spark.read.parquet(path)
    values = [c for c in changes.columns if c not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), BATCH)
    return changes.groupBy(*keys).agg(newest.alias("r")).select(*keys, "r.*")


def dedupe_retries_stream(logs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop copies of a ``log_id`` that arrive within ``delay`` of the first.

    An id names one record, so its copies are the few retries of one sender: one shuffle and one
    state row per id, which the watermark takes away again.
    """
    return logs.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["log_id"])


def downsample_stream(
    samples: DataFrame,
    every_seconds: int,
    by: Sequence[str],
    value_columns: Sequence[str],
    tie_break: str,
    delay: str = "1 hour",
) -> DataFrame:
    """At most one sample, the newest, per key and slot, sent once the watermark has closed the slot."""
    newest = F.max_by(F.struct("ts", *value_columns), F.struct("ts", tie_break))
    return (
        samples.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{every_seconds} seconds").alias("slot"), *by)
        .agg(newest.alias("s"))
        .select(*by, F.col("slot.start").alias("slot"), "s.*")
    )


def heartbeat_sessions_stream(
    beats: DataFrame, timeout_seconds: int, by: str = "tracker_id", delay: str = "1 hour"
) -> DataFrame:
    """Spans of liveness, sent once a run has been silent past the timeout."""
    return (
        beats.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", f"{timeout_seconds} seconds").alias("s"), by)
        .agg(F.count(F.lit(1)).alias("beats"))
        .select(
            by,
            F.col("s.start").alias("session_start"),
            F.col("s.end").alias("session_end"),
            "beats",
        )
    )


def node_state_stream(updates: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """Last write per (run, node), for update mode, with a state row for each node for ever.

    Where nodes come and go, ``runweave.streaming.nodes.closing_nodes_stream`` sends a closing row for a
    silent node and forgets it, at the price of a Python call a node and batch.
    """
    newest = F.max_by(F.struct("ts", *value_columns), F.struct("ts", "seq"))
    return updates.groupBy("run_id", "id").agg(newest.alias("n")).select("run_id", "id", "n.*")


def tracker_status_stream(events: DataFrame) -> DataFrame:
    """Live status per tracker from lifecycle events, for update mode."""
    return tracker_status(events)


def guard_completed(
    events: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, Any] = ONCE
) -> StreamingQuery:
    """Store live records and the ends of their trackers as they arrive.

    ``events``: tracker_id, log_id, ts, kind (``log`` or ``end``). A batch is written in one pass, to a
    folder of its own that a second run overwrites, and reads nothing of earlier ones. Which records
    are late is told by :func:`guarded_rows` from all ends known then, so that an end that arrives
    after its tracker's records, or in another batch, gives the same answer.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        events.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def guarded_rows(spark: SparkSession, path: str) -> DataFrame:
    """Records stored by :func:`guard_completed`, with ``problems`` for those after their tracker's first end."""
    stored = spark.read.parquet(path).drop(BATCH)
    ends = stored.where(F.col("kind") == "end").groupBy("tracker_id").agg(F.min("ts").alias("end_ts"))
    return reject_after_completed(stored.where(F.col("kind") == "log"), ends)


def tail_logs(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    glob: str | None = None,
    raise_on_error: bool = True,
    trigger: Mapping[str, Any] = ONCE,
    range_bytes: int = RANGE_BYTES,
) -> bool:
    """Copy log lines to a writer as they arrive, also those appended to files seen before; see
    :func:`tail_lines`. True when all went well; a failed stream raises or, without ``raise_on_error``,
    gives False. With a trigger that goes on, so does the call."""
    lines = tail_lines(spark, folder, glob or "*", range_bytes)
    writer = (
        lines.select(F.col("line").alias("value"))
        .writeStream.format("text")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    try:
        writer.start(path).awaitTermination()
    except Exception:
        if raise_on_error:
            raise
        return False
    return True
