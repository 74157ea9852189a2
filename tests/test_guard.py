"""Late records told by a join of two streams, against the batch rule."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runweave.operators.logs import reject_after_completed
from runweave.streaming import live as S
from runweave.streaming.guard import guard_stream, guarded

START = datetime(2024, 1, 1)
EVENTS = "tracker_id string, log_id string, ts timestamp, kind string"


def at(minutes):
    return START + timedelta(minutes=minutes)


def events():
    """A hot tracker with two thirds of all records, several ends a tracker, one without an end."""
    out = [(f"t{0 if i % 3 else i % 4}", f"l{i}", at(i % 97), "log") for i in range(240)]
    out += [("t0", "e0", at(70), "end"), ("t0", "e1", at(40), "end"), ("t0", "e2", at(40), "end"),
            ("t1", "e3", at(96), "end"), ("t2", "e4", at(0), "end"), ("t9", "e5", at(3), "end")]
    return out


def feed(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, delay="2 hours"):
    made = S.stream_logs(spark, f"{tmp_path}/in", spark.createDataFrame([], EVENTS).schema, max_files_per_trigger=1)
    logs = made.where("kind = 'log'")
    ends = made.where("kind = 'end'").select("tracker_id", F.col("ts").alias("end_ts"))
    query = guard_stream(logs, ends, f"{tmp_path}/t", f"{tmp_path}/c", delay=delay, pieces=3)
    query.awaitTermination()
    got = guarded(spark, f"{tmp_path}/t").collect()
    assert len(got) == len({(r.tracker_id, r.log_id) for r in got})
    states = [sum(o.numRowsTotal for o in p.stateOperators) for p in query.recentProgress if p.stateOperators]
    return {r.log_id: r.late for r in got}, states


def told(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    ends = df.where("kind = 'end'").groupBy("tracker_id").agg(F.min("ts").alias("end_ts"))
    return {r.log_id: bool(r.problems) for r in reject_after_completed(df.where("kind = 'log'"), ends).collect()}


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_batches_in_any_order(spark, tmp_path, order):
    rows = events()
    want = told(spark, rows)
    for part in order[:2]:
        feed(spark, f"{tmp_path}/in", rows[part::3])
    got, states = run(spark, tmp_path)
    # What is late is told at once; the others wait, as an end may still come.
    assert got and all(got.values()) and all(want[i] for i in got)
    feed(spark, f"{tmp_path}/in", rows[order[2] :: 3])
    got, states = run(spark, tmp_path)
    assert {i for i, late in got.items() if late} == {i for i, late in want.items() if late}
    # Both sides move on by a year: all are told, and the state falls to what these rows need.
    far = [("x", "far", at(600_000), "log"), ("y", "far end", at(600_000), "end")]
    feed(spark, f"{tmp_path}/in", far)
    got, after = run(spark, tmp_path)
    assert got == want and after[-1] < 10 < max(states)


def test_rows_without_time_or_tracker(spark, tmp_path):
    rows = [("t", "a", at(10), "log"), ("t", "b", None, "log"), (None, "c", at(10), "log"), ("t", "e", at(5), "end"), ("t", "f", None, "end"), ("t", "a", at(10), "log")]
    feed(spark, f"{tmp_path}/in", rows)
    feed(spark, f"{tmp_path}/in", [("x", "far", at(90_000), "log"), ("y", "far end", at(90_000), "end")])
    got, _ = run(spark, tmp_path, "1 minute")
    assert got["a"] is True and got["b"] is False and got["c"] is False
