"""Hard negatives against brute force over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from runweave.llm import negatives
from runweave.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(row):
    i, v, label = row
    fine = v is not None and all(x is not None and math.isfinite(x) for x in v)
    return i is not None and label is not None and fine


def expected(rows, every, positives=5, hard=3):
    seen = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in filter(usable, rows)}
    seen = sorted(r for r in seen if sum(x * x for x in r[2]) < 2**62)
    out = []
    for a in seen:
        if a[0] % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in seen if b != a and len(b[2]) == len(a[2])]
        scored.sort()
        for p in [s for s in scored if s[2] == a[1]][:positives]:
            low, high = 50 * -p[0], 95 * -p[0]
            found = [s for s in scored if s[2] != a[1] and low <= 100 * -s[0] <= high][:hard]
            out += [(a[0], p[1], rank, n[1], -p[0], -n[0]) for rank, n in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, every=50):
    df = spark.createDataFrame(rows, SCHEMA)
    for extra in ("id", "mark", "square", "anchor", "v", "part", "bucket"):
        df = df.withColumn(extra, F.lit("x"))
    made = negatives.mine(df, F.col("vec_id") % every == 0)
    assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in made.collect())


def data(kind, n=600):
    rng = np.random.default_rng(5)
    if kind == "flat":  # directions of one cluster, lengths from short to very long
        x = rng.normal(1, 0.4, (n, 8)) * rng.gamma(1.0, 2.0, (n, 1))
    elif kind == "copies":  # a third of all rows alike, few values, so many ties
        x = rng.integers(0, 3, (n, 5)) / 2
        x[: n // 3] = [1, 0, 1, 1, 0]
    elif kind == "any sign":
        x = rng.normal(0, 1, (n, 24))
    else:  # clusters of unit vectors
        x = rng.normal(0, 0.25, (n, 16)) + np.eye(16)[rng.integers(0, 6, n)]
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("kind", ["flat", "copies", "any sign", "clusters"])
@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, kind, small):
    if small:  # many blocks on both sides
        monkeypatch.setattr(negatives, "BLOCK_NUMBERS", 256)
        monkeypatch.setattr(negatives, "ANCHORS", 4)
    rows = data(kind)
    want = expected(rows, 25)
    assert want and mined(spark, rows, 25) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (None, [1.0, 0.0], 1), (1, None, 1), (2, [1.0, 0.0], None),
        (3, [nan, 1.0], 1), (4, [inf, 1.0], 2), (5, [None, 1.0], 1), (6, [1.0, 0.2], 1), (7, [0.8, 0.1], 2), (8, [0.8, 0.1], 2),
        (9, [], 1), (50, [], 2), (10, [], 2), (11, [0.0, 0.0], 2), (100, [0.0, 0.0], 3), (12, [-1.0, 0.0], 3), (13, [3e38, 1.0], 2),
        (14, [0.7], 2), (150, [0.9], 2), (151, [0.8], 2), (152, [0.6], 1), (15, [0.6, 0.0], -1), (16, [4e6, 1e6], 2), (200, [3e6, 2e6], 1),
        (17, [3e6, 0.0], 1), (-50, [0.9, 0.9], 1),
    ]
    assert mined(spark, rows) == expected(rows, 50)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []


def test_candidates_hold_all_that_reach():
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 100, (20, 12))
    x = np.floor(centre[rng.integers(0, 20, 4000)] + rng.normal(0, 15, (4000, 12))).astype(np.int64)
    block = negatives.Block(x, np.arange(4000), np.zeros(4000, np.int64), np.zeros(4000, np.int64))
    met = {5: 0, 500: 0, 4000: 0}
    for q in x[:30]:
        score = x @ q
        for k in met:
            rows = block.candidates(q, int(np.sort(score)[-k]))
            rows = np.arange(4000) if rows is None else rows
            assert set(np.flatnonzero(score >= np.sort(score)[-k])) <= set(rows.tolist())
            met[k] += len(rows)
    assert met[5] < 0.6 * 30 * 4000 and met[4000] == 30 * 4000  # the ranges leave out much, if little is asked


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    moved = [(i, v, (label + 1) % 10 if label is not None and i % 7 == 0 else label) for i, v, label in rows]
    got = sorted(tuple(r) for r in QUERIES["op13_negatives"](spark, sf_dir).collect())
    want = expected(moved, 50)
    assert want and got == want
