"""Hot keys: one key holds at least a third of the rows. Results against plain Python."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from runweave.operators import logs as L
from runweave.operators import telemetry as T
from runweave.operators.ordered import (
    BUCKET, hot_keys, micros, spread_join, with_bucket, with_ordinal, with_previous,
)

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(7)
    out = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(40)}"
        # Many equal times, and gaps of every size.
        ts = START + timedelta(seconds=rnd.choice([1, 60, 3600]) * rnd.randrange(60))
        out.append((key, ts, f"l{i:05d}"))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "tracker_id string, ts timestamp, log_id string").repartition(7)


def by_key(rows):
    groups = defaultdict(list)
    for key, ts, log_id in rows:
        groups[key].append((ts, log_id))
    return {k: sorted(v) for k, v in groups.items()}


@pytest.mark.parametrize("most", [20, 100, 1000, 10**9])
def test_ordinal(df, rows, most):
    got = with_ordinal(df, ["tracker_id"], ["ts", "log_id"], micros("ts"), rows=most)
    want = {(k, i, x) for k, g in by_key(rows).items() for x, (_, i) in enumerate(g)}
    assert {(r.tracker_id, r.log_id, r.x) for r in got.collect()} == want


@pytest.mark.parametrize("most", [20, 100, 1000, 10**9])
def test_previous(df, rows, most):
    got = with_previous(df, ["tracker_id"], ["ts", "log_id"], micros("ts"), "log_id", rows=most)
    want = set()
    for key, group in by_key(rows).items():
        ids = [None, *(i for _, i in group)]
        want |= {(key, i, p) for p, i in zip(ids, ids[1:])}
    assert {(r.tracker_id, r.log_id, r.previous) for r in got.collect()} == want


@pytest.mark.parametrize("most", [30, 10**9])
@pytest.mark.parametrize("timeout", [1, 45, 4000])
def test_sessions(df, rows, most, timeout):
    got = T.heartbeat_sessions(df.select("tracker_id", "ts"), timeout, rows=most)
    want = []
    for key, group in by_key(rows).items():
        start = last = None
        beats = 0
        for ts, _ in group:
            if last is not None and ts - last >= timedelta(seconds=timeout):
                want.append((key, start, last + timedelta(seconds=timeout), beats))
                start, beats = None, 0
            start, last, beats = start or ts, ts, beats + 1
        want.append((key, start, last + timedelta(seconds=timeout), beats))
    have = [(r.tracker_id, r.session_start, r.session_end, r.beats) for r in got.collect()]
    assert sorted(have) == sorted(want)


@pytest.mark.parametrize("most", [7, 50, 10**9])
def test_regions_cross_buckets(spark, most):
    rnd = random.Random(3)
    events, want = [], []
    for thread in range(6):
        stack, now = [], START
        for n in range(900 if thread == 0 else 60):
            now += timedelta(seconds=rnd.randrange(1, 20))
            if stack and (rnd.random() < 0.5 or len(stack) > 4):
                region, entered, level = stack.pop()
                events.append((thread, region, "LEAVE", now))
                want.append((thread, region, level, entered, now))
            else:
                stack.append((n, now, len(stack)))
                events.append((thread, n, "ENTER", now))
        want.extend((thread, r, level, entered, None) for r, entered, level in stack)
    df = spark.createDataFrame(events, "thread bigint, region bigint, kind string, ts timestamp")
    got = T.region_latency(df, rows=most).collect()
    have = {(r.thread, r.region, r.level, r.enter_ts, r.leave_ts) for r in got}
    assert have == set(want) and len(got) == len(want)
    for r in got:
        if r.leave_ts is not None:
            assert r.elapsed == (r.leave_ts - r.enter_ts).total_seconds()


def test_regions_of_many_threads_spread_over_tasks(spark):
    # Small shuffles are merged by their size; the number of events decides here, so no task sorts most of them.
    at = [(kind, START + timedelta(seconds=s)) for kind, s in (("ENTER", 0), ("ENTER", 1), ("LEAVE", 2), ("LEAVE", 5))]
    events = [(thread, 0, kind, ts) for thread in range(1000) for kind, ts in at] + [(None, 0, *at[0])]
    df = spark.createDataFrame(events, "thread bigint, region bigint, kind string, ts timestamp")
    got = T.region_latency(df, rows=100).withColumn("task", F.spark_partition_id()).collect()
    want = [(t, level, s) for t in range(1000) for level, s in ((0, 5.0), (1, 1.0))]
    assert sorted((r.thread, r.level, r.elapsed) for r in got) == want
    per_task = Counter(r.task for r in got)
    assert len(per_task) >= 20 and max(per_task.values()) <= 300


def test_hot_keys_are_few_and_weighted(df, rows):
    hot = {r.tracker_id: r["__salts"] for r in hot_keys(df, ["tracker_id"], 10).collect()}
    share = sum(1 for r in rows if r[0] == "hot") / len(rows)
    assert set(hot) == {"hot"} and abs(hot["hot"] - share * 10) <= 1


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, df, how):
    fact = df.withColumn("tracker_id", F.when(F.col("log_id") > "l00100", F.col("tracker_id")))
    dim = spark.createDataFrame(
        [("hot", 1), ("k1", 2), ("k1", 3), ("gone", 4), (None, 5)], "tracker_id string, v int"
    )
    got = spread_join(fact, dim, ["tracker_id"], ["log_id"], how, pieces=16)
    want = fact.join(dim, ["tracker_id"], how)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_spread_join_splits_copies_of_one_row(spark):
    copies = spark.range(4000, numPartitions=16).select(F.lit("k").alias("k"), F.lit("same").alias("id"))
    dim = spark.createDataFrame([("k", 1)], "k string, v int")
    joined = spread_join(copies, dim, ["k"], ["id"], pieces=8)
    assert joined.count() == 4000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan


def test_reject_after_completed_hot(df, rows, spark):
    end = START + timedelta(seconds=600)
    ends = spark.createDataFrame([("hot", end)], "tracker_id string, end_ts timestamp")
    split = L.halves(L.reject_after_completed(df, ends))
    late = {i for k, ts, i in rows if k == "hot" and ts > end}
    assert {r.log_id for r in split.quarantine.collect()} == late
    assert {r.log_id for r in split.accepted.collect()} == {i for _, _, i in rows} - late


def test_dedupe_many_copies(spark):
    one = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("log_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 7).alias("ts"),
        (F.col("id") % 5).alias("v"),
    )
    kept = T.dedupe_retries(one, ["v"]).collect()
    assert len(kept) == 2001
    assert [r.v for r in kept if r.log_id == "copy"] == [0]


def test_a_burst_is_cut(spark):
    # Half of all rows are one key's, within one second.
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"),
        F.timestamp_micros(F.lit(1704067200000000) + F.when(F.col("id") % 2 == 0, F.col("id") * 200).otherwise(F.col("id") * 10**7)).alias("ts"),
    )
    cut, any_cut = with_bucket(df, ["k"], micros("ts"), rows=100)
    sizes = {(r.k, r[BUCKET]): r["count"] for r in cut.groupBy("k", BUCKET).count().collect()}
    assert any_cut and max(sizes.values()) <= 300 and len([k for k in sizes if k[0] == "hot"]) >= 15
    assert all(b == 0 for k, b in sizes if k != "hot")
    whole, any_cut = with_bucket(df, ["k"], micros("ts"), rows=5000)
    assert not any_cut and whole.select(BUCKET).distinct().count() == 1
