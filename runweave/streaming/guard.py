"""Records of completed trackers told apart as they arrive, by a join of two streams.

Records meet the ends of their trackers in an interval join under watermarks. A record that comes after an end is
known at once; one without an end waits until the watermark says that none can come any more. State holds
the records that still wait and the ends that can still matter, and shrinks behind the watermark.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runweave.streaming.live import BATCH, ONCE


def told_late(
    logs: DataFrame, ends: DataFrame, horizon: str = "30 days", delay: str = "1 hour", pieces: int = 8
) -> DataFrame:
    """``logs`` with ``late``: true for a record later than an end of its tracker, in append mode.

    ``logs``: tracker_id, log_id, ts and more; ``ends``: tracker_id, end_ts, any number a tracker, in any order.
    Either may arrive up to ``delay`` out of order; what is older than the watermark is dropped. An end
    counts for records up to ``horizon`` after it, which bounds the state; for older ends see
    ``reject_after_completed`` over the stored tables. Late records come out at once, each once, the others when
    the watermark has passed them. Records without a tracker or time are not late. A tracker's records are
    spread over ``pieces`` by their ids, and its ends repeated, so that a hot one is no single task's.
    """
    timeless = logs.where("ts is null").withColumn("late", F.lit(False))
    names = [c for c in logs.columns if c != "late"]
    left = logs.where("ts is not null").withWatermark("ts", delay)
    left = left.withColumn("__piece", F.pmod(F.xxhash64("log_id"), F.lit(pieces)).cast("int"))
    right = ends.select(F.col("tracker_id").alias("__tracker"), F.col("end_ts").alias("__end"))
    right = right.where("__end is not null").withWatermark("__end", delay)
    right = right.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    on = (
        (F.col("tracker_id") == F.col("__tracker"))
        & (F.col("__piece") == F.col("__part"))
        & (F.col("__end") < F.col("ts"))
        & (F.col("ts") <= F.col("__end") + F.expr(f"interval {horizon}"))
    )
    met = left.join(right, on, "left_outer").withColumn("late", F.col("__tracker").isNotNull())
    # A record meets every earlier end of its tracker: the first meeting is the one that counts.
    once = met.select(*names, "late").dropDuplicates(["tracker_id", "log_id", "ts"])
    return once.unionByName(timeless.select(*names, "late"))


def guard_stream(
    logs: DataFrame,
    ends: DataFrame,
    path: str,
    checkpoint: str,
    horizon: str = "30 days",
    delay: str = "1 hour",
    trigger: Mapping[str, Any] = ONCE,
    pieces: int = 8,
) -> StreamingQuery:
    """Store records by ``late`` as :func:`told_late` tells them: ``late=true`` is the quarantine.

    Records that agree in tracker_id, log_id and time count once. A batch goes to a folder of its own, which a
    second run overwrites; read them with :func:`guarded`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        told_late(logs, ends, horizon, delay, pieces)
        .writeStream.outputMode("append")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def guarded(spark: SparkSession, path: str) -> DataFrame:
    """The records that :func:`guard_stream` has stored so far, with ``late``."""
    return spark.read.parquet(path).drop(BATCH).withColumn("late", F.col("late").cast("boolean"))
