"""Streams fed in several small batches, in any order, against their batch twins."""

from datetime import datetime, timedelta

import pytest

from runweave.operators.logs import reject_after_completed
from runweave.streaming import live as S
from pyspark.sql import functions as F

START = datetime(2024, 1, 1)
EVENTS = "tracker_id string, log_id string, ts timestamp, kind string"


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_late_ends_count_whatever_the_batches(spark, tmp_path, order):
    rows = [(f"t{i % 3}", f"l{i}", START + timedelta(minutes=i), "log") for i in range(60)]
    rows += [("t0", "e0", START + timedelta(minutes=20), "end"), ("t0", "e1", START + timedelta(minutes=9), "end"),
             ("t1", "e2", START + timedelta(minutes=50), "end")]
    for part in order:
        spark.createDataFrame(rows[part::3], EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        events = S.stream_logs(spark, f"{tmp_path}/in", spark.createDataFrame([], EVENTS).schema, max_files_per_trigger=1)
        S.guard_completed(events, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    got = {(r.log_id, bool(r.problems)) for r in S.guarded_rows(spark, f"{tmp_path}/t").collect()}
    df = spark.createDataFrame(rows, EVENTS)
    ends = df.where("kind = 'end'").groupBy("tracker_id").agg(F.min("ts").alias("end_ts"))
    want = reject_after_completed(df.where("kind = 'log'"), ends)
    assert got == {(r.log_id, bool(r.problems)) for r in want.collect()}


def test_a_stream_goes_on_until_it_is_stopped(spark, tmp_path):
    schema = spark.createDataFrame([], EVENTS).schema

    def feed(i):
        row = [("t", f"l{i}", START, "log")]
        spark.createDataFrame(row, EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    feed(0)
    events = S.stream_logs(spark, f"{tmp_path}/in", schema)
    query = S.append_stream(events, f"{tmp_path}/t", f"{tmp_path}/c", {"processingTime": "0 seconds"})
    try:
        for i in (1, 2):
            query.processAllAvailable()
            feed(i)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert sorted(r.log_id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["l0", "l1", "l2"]
