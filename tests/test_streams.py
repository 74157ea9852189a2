"""Streams in several batches equal their batch twins, also after a restart."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runweave.operators import telemetry as T
from runweave.operators.trackers import tracker_status
from runweave.streaming import live as S

START = datetime(2024, 1, 1)
SCHEMA = "tracker_id string, log_id string, ts timestamp, value double, kind string"


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Four files in time order; every fifth record comes again in the next file."""
    folder = str(tmp_path_factory.mktemp("feed"))
    rows, again = [], []
    for part in range(4):
        fresh = []
        for i in range(part * 50, part * 50 + 50):
            kind = "end" if i in (60, 120) else "log"
            ts = START + timedelta(minutes=i * 3)
            fresh.append((f"t{i % 3}", f"l{i}", ts, float(i % 11), kind))
        batch = fresh + again
        again = fresh[::5]
        rows += fresh
        df = spark.createDataFrame(batch, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{folder}/{part}")
    return folder, rows


def stream(spark, feed):
    schema = spark.createDataFrame([], SCHEMA).schema
    return S.stream_logs(spark, f"{feed[0]}/*", schema, max_files_per_trigger=1)


def batch(spark, feed):
    return spark.createDataFrame(feed[1], SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe(spark, feed, tmp_path):
    out = S.dedupe_retries_stream(stream(spark, feed), "1 day")
    S.append_stream(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/t")
    assert rows(got) == rows(batch(spark, feed))
    # A second run finds nothing new.
    S.append_stream(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == rows(got)


def test_downsample(spark, feed, tmp_path):
    out = S.downsample_stream(stream(spark, feed), 600, ["tracker_id"], ["value"], "log_id", "4 hours")
    S.append_stream(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    closed = max(r[2] for r in feed[1]) - timedelta(hours=4)
    want = T.downsample(batch(spark, feed), 600, ["tracker_id"], ["value"], "log_id")
    want = want.where(F.col("slot") + F.expr("interval 10 minutes") <= F.lit(closed))
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == rows(want)


def test_sessions(spark, feed, tmp_path):
    beats = stream(spark, feed).where("kind = 'log'").select("tracker_id", "ts")
    out = S.heartbeat_sessions_stream(beats, 600, delay="4 hours")
    S.append_stream(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    closed = max(r[2] for r in feed[1]) - timedelta(hours=4)
    # Records that came twice count twice here, as the stream sees them.
    again = batch(spark, feed).where("kind = 'log'").where("cast(substr(log_id, 2) as int) < 150 and cast(substr(log_id, 2) as int) % 5 = 0")
    every = batch(spark, feed).where("kind = 'log'").unionAll(again).select("tracker_id", "ts")
    want = T.heartbeat_sessions(every, 600).where(F.col("session_end") <= F.lit(closed))
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == rows(want)


def test_node_state(spark, feed, tmp_path):
    def updates(df):
        return df.select(
            F.col("tracker_id").alias("run_id"),
            F.concat(F.lit("n"), F.col("value") % 4).alias("id"),
            "ts", F.col("log_id").alias("seq"), F.col("value").alias("status"),
        )
    out = S.node_state_stream(updates(stream(spark, feed)), ["status"])
    S.update_stream(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    got = S.current_rows(spark, f"{tmp_path}/t", ["run_id", "id"])
    assert rows(got) == rows(T.node_latest(updates(batch(spark, feed)), ["status"]))


def test_status(spark, feed, tmp_path):
    out = S.tracker_status_stream(stream(spark, feed).select("tracker_id", "kind"))
    S.update_stream(out, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    got = S.current_rows(spark, f"{tmp_path}/t", ["tracker_id"])
    assert rows(got) == rows(tracker_status(batch(spark, feed)))


def test_guard_rejects_later_batches(spark, feed, tmp_path):
    events = stream(spark, feed).select("tracker_id", "log_id", "ts", "kind")
    S.guard_completed(events, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    rows = S.guarded_rows(spark, f"{tmp_path}/t").collect()
    rejected = {r.log_id for r in rows if r.problems}
    accepted = {r.log_id for r in rows if not r.problems}
    end = START + timedelta(minutes=180)
    late = {r[1] for r in feed[1] if r[0] == "t0" and r[2] > end and r[4] == "log"}
    assert late <= rejected and not (late & accepted)
    assert accepted | rejected == {r[1] for r in feed[1] if r[4] == "log"}


def test_tail(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(f"{tmp_path}/in")
    assert S.tail_logs(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c")
    assert rows(spark.read.text(f"{tmp_path}/out")) == [("a",), ("b",)]


def test_tail_error_can_be_quiet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x").write_text("a\n")
    (tmp_path / "blocked").write_text("a file where the folder should be")
    args = (spark, f"{tmp_path}/in", f"{tmp_path}/blocked/out")
    assert S.tail_logs(*args, f"{tmp_path}/c1", raise_on_error=False) is False
    with pytest.raises(Exception):
        S.tail_logs(*args, f"{tmp_path}/c2")
