"""Node states with timers: against the batch twin, closing rows, and state that goes away."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from runweave.operators.telemetry import node_latest
from runweave.streaming import live as S
from runweave.streaming.nodes import closing_nodes_stream

START = datetime(2024, 1, 1)
SCHEMA = "run_id string, id string, ts timestamp, seq string, status string, value double"


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def at(minutes):
    return START + timedelta(minutes=minutes)


def run(spark, tmp_path):
    """One more run of the stream, from its checkpoint; the rows now current, and the rows of state left."""
    updates = S.stream_logs(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    out = closing_nodes_stream(updates, ["status", "value"], silence_seconds=1800, delay="10 minutes")
    query = S.update_stream(out, f"{tmp_path}/t", f"{tmp_path}/c")
    query.awaitTermination()
    state = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    return {(r.run_id, r.id): r for r in S.current_rows(spark, f"{tmp_path}/t", ["run_id", "id"]).collect()}, state


def test_against_batch_closing_and_expiry(spark, tmp_path):
    rows = []
    for i in range(90):
        node = "hot" if i % 3 == 0 else f"n{i % 5}"
        rows.append(("r", node, at(i % 30 + i // 30 * 10), f"s{i:03}", f"st{i % 7}", None if i % 11 == 0 else float(i)))
    for part in range(3):  # in any order, several rows of a node with one time
        feed(spark, f"{tmp_path}/in", rows[part::3])
    got, state = run(spark, tmp_path)
    want = node_latest(spark.createDataFrame(rows, SCHEMA), ["status", "value"]).collect()
    assert {(r.run_id, r.id, r.ts, r.status, r.value) for r in got.values()} == {tuple(r) for r in want}
    assert not any(r.closed for r in got.values()) and state[-1] > 0
    # A lone node writes much later: all others fall silent, also over a restart.
    feed(spark, f"{tmp_path}/in", [("r2", "late", at(300), "z", "up", 1.0)])
    got, _ = run(spark, tmp_path)
    closed = {k for k, r in got.items() if r.closed}
    assert closed == {(r.run_id, r.id) for r in want} and not got["r2", "late"].closed
    assert {(r.run_id, r.id, r.ts, r.status, r.value) for r in got.values() if r.closed} == {tuple(r) for r in want}
    # One opens again; the last one alive is closed by a node whose row came when it was silent already.
    feed(spark, f"{tmp_path}/in", [("r", "hot", at(320), "zz", "again", 2.0)])
    got, _ = run(spark, tmp_path)
    assert not got["r", "hot"].closed and got["r", "hot"].status == "again"
    feed(spark, f"{tmp_path}/in", [("r3", "far", at(9000), "a", "x", 0.0)])
    got, state = run(spark, tmp_path)
    assert [k for k, r in got.items() if not r.closed] == [("r3", "far")]
    assert state[-1] < state[0] or state[0] <= 3


def test_rows_behind_the_watermark_change_nothing(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", [("r", "a", at(500), "1", "new", 1.0)])
    run(spark, tmp_path)
    feed(spark, f"{tmp_path}/in", [("r", "a", at(100), "2", "old", 2.0), ("r", "b", at(495), "3", "fine", 3.0)])
    got, _ = run(spark, tmp_path)
    assert got["r", "a"].status == "new" and got["r", "b"].status == "fine"
