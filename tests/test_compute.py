"""User functions over tables."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from runweave.operators import compute as C


def test_map_keeps_order_and_errors(spark):
    inputs = spark.range(100).select(F.col("id").alias("idx"), (F.col("id") % 7).alias("x"))
    got = C.parallel_map(inputs, lambda x: 10 // x, "x", "bigint", workers=5).collect()
    assert [r.idx for r in got] == list(range(100))
    for r in got:
        if r.idx % 7 == 0:
            assert r.value is None and r.error.startswith("ZeroDivisionError")
        else:
            assert r.value == 10 // (r.idx % 7) and r.error is None


def test_bad_workers(spark):
    with pytest.raises(ValueError):
        C.parallel_map(spark.range(1), abs, "id", "bigint", "id", workers=0)


def test_operator_forms(spark):
    @C.operator("id", "twice", "bigint")
    def twice(x):
        """Doubles."""
        return 2 * x

    class Keep(C.Operator):
        def forward(self, df):
            return df.where("twice > 2")

    last, outputs = C.sequential(twice, Keep(), capture_output=True)(spark.range(4))
    assert twice.__doc__ == "Doubles."
    assert [r.twice for r in last.orderBy("id").collect()] == [4, 6]
    assert [o.count() for o in outputs] == [4, 2]
    with pytest.raises(NotImplementedError):
        C.Operator()(spark.range(1))
    with pytest.raises(TypeError):
        C.sequential(3)


def test_setup_runs_once_per_task(spark):
    def build():
        import uuid

        token = str(uuid.uuid4())
        return lambda values: pd.Series([token] * len(values))

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 200, numPartitions=2).select(C.init_once_udf(build, "string")("id").alias("t"))
        assert df.distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_argument_contract():
    C.check_arguments(["a", "b"], ["a"], ["b"])
    with pytest.raises(ValueError, match="unknown"):
        C.check_arguments(["a", "z"], ["a"])
    with pytest.raises(ValueError, match="missing"):
        C.check_arguments([], ["a"])


class Longest(C.Actor):
    def __init__(self):
        self.n, self.word = 0, ""

    def update(self, rows):
        self.n += len(rows["w"])
        self.word = max([self.word, *rows["w"]], key=lambda w: (len(w), w))

    def state(self):
        return {"n": self.n, "word": self.word}

    def merge(self, state):
        self.n += int(state["n"])
        self.word = max(self.word, state["word"], key=lambda w: (len(w), w))

    def result(self):
        return self.state()


@pytest.mark.parametrize("live", [1, 3, 10_000])
def test_group_apply_hot_and_null_keys(spark, live):
    rows = [("hot" if i % 2 else (None if i % 5 == 0 else f"k{i % 9}"), "w" * (i % 13) + str(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, w string").repartition(6)
    got = C.group_apply(df, "k", Longest, "n bigint, word string", "n bigint, word string", max_live_actors=live)
    want = {}
    for k, w in rows:
        n, best = want.get(k, (0, ""))
        want[k] = (n + 1, max(best, w, key=lambda v: (len(v), v)))
    assert {r.k: (r.n, r.word) for r in got.collect()} == want


def test_map_runs_each_input_once(spark):
    ran = spark.sparkContext.accumulator(0)

    def count(x):
        ran.add(1)
        return x

    got = C.parallel_map(spark.range(50).withColumn("x", F.col("id")), count, "x", "bigint", "id")
    assert [r.id for r in got.collect()] == list(range(50))
    assert ran.value == 50


BIG = 2**53 + 1


@pytest.mark.parametrize("batch", ["1", "2", "10000"])
def test_values_do_not_depend_on_the_batch(spark, batch):
    rows = [(i, v) for i, v in enumerate([1, None, BIG, 7, None, -BIG])]
    df = spark.createDataFrame(rows, "idx long, x long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        shown = C.parallel_map(df, repr, "x", "string", workers=1).collect()
        assert [r.value for r in shown] == [repr(v) for _, v in rows]

        @C.operator("x", "y", "bigint")
        def same(x):
            return x if x is None else x - 1

        assert [r.y for r in same(df).orderBy("idx").collect()] == [v if v is None else v - 1 for _, v in rows]
        got = C.group_apply(df, "x", Counted, "n bigint, total bigint", "n bigint, total bigint").collect()
        assert {r.x: (r.n, r.total) for r in got} == {1: (1, 0), None: (2, 5), BIG: (1, 2), 7: (1, 3), -BIG: (1, 5)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


class Counted(C.Actor):
    def __init__(self):
        self.n, self.total = 0, 0

    def update(self, rows):
        assert rows["x"].dtype == "int64"
        self.n += len(rows["x"])
        self.total += int(rows["idx"].sum())

    def state(self):
        return {"n": self.n, "total": self.total}

    def merge(self, state):
        assert type(state["n"]) is int
        self.n += state["n"]
        self.total += state["total"]

    def result(self):
        return self.state()
