"""SimHash and vector near duplicates, and the components both use, against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from runweave.llm import simhash, vectors
from runweave.llm.components import components
from runweave.llm.xxh64 import slices_hash


def groups(nodes, pairs):
    """Least member of each node's component."""
    of = {n: n for n in nodes}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        of[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    made = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_xxh64_of_slices():
    data = np.random.default_rng(1).integers(0, 256, 4000, np.uint8).tobytes()
    starts = np.arange(0, 3000, 7)
    ends = starts + np.arange(len(starts)) % 150
    want = [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(starts, ends)]
    assert slices_hash(data, starts, ends).tolist() == want
    assert len(slices_hash(b"", np.array([], int), np.array([], int))) == 0


def test_fingerprints_of_whole_texts():
    texts = [None, "", " \n\t", "One", "a b c", "a b\u00a0c D e", "Éa B c d e f g " * 900, "x" * 5000, "a\x0bb c d e"]
    assert simhash.fingerprints_of(texts, 4).tolist() == [fingerprint(t) for t in texts]


def test_distance_of_counts_is_a_lower_bound(spark):
    rng = np.random.default_rng(2)
    a, b = (rng.integers(-(2**63), 2**63, 500, np.int64).tolist() for _ in range(2))
    df = spark.createDataFrame(list(zip(a, b)), "a long, b long")
    x, y = simhash.segment_counts(F.col("a")), simhash.segment_counts(F.col("b"))
    for r in df.select("a", "b", simhash.manhattan(x, y).alias("d")).collect():
        u, v = r.a % 2**64, r.b % 2**64
        counts = [((u >> i & 3).bit_count(), (v >> i & 3).bit_count()) for i in range(0, 64, 2)]
        assert r.d == sum(abs(p - q) for p, q in counts) <= (u ^ v).bit_count()


@pytest.mark.parametrize("most", [1, 4])
def test_links_lose_none(spark, most):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 40)]
    fps = set(base)
    for x in base:
        for k in range(1, 8):
            y = x
            for bit in rng.choice(63, k, replace=False):
                y ^= 1 << int(bit)
            fps.add(y)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = sorted(tuple(r) for r in simhash.links(df, most).collect())
    assert got == sorted((a, b) for a in fps for b in fps if a < b and ((a ^ b) % 2**64).bit_count() <= most)


def test_cells_are_never_broadcast(spark, tmp_path):
    """Cells are 35 rows a fingerprint, which Spark's estimate of a stored table leaves out."""
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    pairs = simhash.links(spark.read.parquet(f"{tmp_path}/fps"))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_lines_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2), (200, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups({n for p in pairs for n in p}, pairs)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [
    (1, "the quick brown fox jumps over the lazy dog " * 20, "x"),
    (2, "the quick brown fox jumps over the lazy dog " * 20, None),
    (2, "the quick brown fox jumps over the lazy dog " * 20, None),
    (5, "the quick brown fox jumps over the lazy dog " * 20 + "end", "y"),
    (None, "the quick brown fox jumps over the lazy dog " * 20, "y"),
    (None, "only here and nowhere else at all", "y"),
    (8, None, "z"),
    (9, "", "z"),
    (10, "word", "z"),
]


def test_simhash_of_odd_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, fp string")
    got = simhash.simhash_components(df).collect()
    assert len(got) == len(ROWS)
    fps = {(r[0], fingerprint(r[1])) for r in ROWS}
    assert {(r.doc_id, r.fp % 2**64) for r in got} == fps
    by = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert by[1] == by[2] == 1 and by[8] == by[9] == 8 and by[10] == 10
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, key string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    near = (fingerprint(ROWS[0][1]) ^ fingerprint(ROWS[3][1])).bit_count() <= 4
    assert sorted(i or 0 for i in ids) == sorted([0, 1, 8, 10] + ([] if near else [5]))
    twice = spark.createDataFrame([(3, "a b c d e", "k")] * 3, "doc_id long, text string, key string")
    assert simhash.keep_one(twice).count() == 1


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 16))
    x[40:80] = x[:40] + rng.normal(size=(40, 16)) * 0.2
    x[80:90] = x[0]
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    odd = [(200, None), (201, [0.0] * 16), (202, [1.0, None] * 8), (203, [float("nan")] * 16), (204, []), (205, [2.0, 0.0]),
           (206, [1.0, 0.0]), (None, rows[0][1]), (207, [float("inf")] * 16)]
    got = vectors.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()}
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    root = groups(range(120), zip(*np.nonzero(near)))
    for i in range(120):
        assert got[i] == (near[i].sum(), root[i], root[i] == i)
    assert got[205] == (1, 205, True) and got[206] == (1, 205, False) and got[None] == (0, None, False)
    assert all(got[i] == (0, i, True) for i in (200, 201, 202, 203, 204, 207))
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicates(empty).count() == 0


def test_probes_and_codes_of_real_vectors_lose_nothing(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    close = df.select("vec_id", "embedding").union(
        df.where("vec_id % 3 = 0").select(F.col("vec_id") + 100_000, F.transform("embedding", lambda v, i: v + 0.02 * (i % 3 - 1)))
    )
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(close).collect()}
    rows = close.collect()
    u = np.array([r[1] for r in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = (u @ u.T >= 0.95).sum(axis=1) - 1
    assert [got[r[0]] for r in rows] == want.tolist()


def low_rank(kind, rng):
    """Vectors whose differences point in few directions, or in all."""
    if kind == "3 of 256":
        return rng.normal(0, 1, (700, 3)) @ rng.normal(0, 1, (3, 256)) + rng.normal(0, 1, 256) * 1.2
    if kind == "4 of 768":
        return rng.normal(0, 1, (400, 4)) @ rng.normal(0, 1, (4, 768))
    if kind == "clusters":
        centre = rng.normal(0, 1, (12, 32))
        return centre[rng.integers(0, 12, 800)] + rng.normal(0, 0.16, (800, 32))
    return rng.normal(0, 1, (800, 6))


@pytest.mark.parametrize("kind", ["3 of 256", "4 of 768", "clusters", "isotropic"])
def test_no_link_is_lost_on_any_data(spark, kind):
    x = low_rank(kind, np.random.default_rng(8)).astype(np.float32)
    unit = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(axis=1, keepdims=True))
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    made = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.vec_id: r.n_links for r in made} == dict(enumerate(close.sum(axis=1).tolist()))
    want = groups(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(close))])
    assert {r.vec_id: r.component_id for r in made} == want and close.any()


@pytest.mark.parametrize("kind", ["clusters", "isotropic"])
def test_parts_meet_without_a_shuffle(spark, kind, monkeypatch):
    """Most vectors probe most lists here; nothing may be written once a probe or a pair."""
    plans, tables, write = {}, {}, vectors.stored

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(vectors, "stored", watched)
    monkeypatch.setattr(vectors, "BLOCK", 24)
    monkeypatch.setattr(vectors, "EDGES", 100)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    x = low_rank(kind, np.random.default_rng(9)).astype(np.float32)
    x[400:500] = x[0]  # a class of many rows
    x[500:560] = x[0] + np.random.default_rng(1).normal(0, 0.01, x[:60].shape)  # a list of several blocks
    unit = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(axis=1, keepdims=True))
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    made = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.vec_id: r.n_links for r in made} == dict(enumerate(close.sum(axis=1).tolist()))
    want = groups(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(close))])
    assert {r.vec_id: r.component_id for r in made} == want
    assert "CartesianProduct" in plans["vectors-links"] and "Exchange" not in plans["vectors-links"]
    parts = tables["vectors-parts"]
    held = [i for r in parts.collect() for i in np.frombuffer(r.node, "<i8")]
    assert len(held) == len(set(held)) == len(np.unique(x, axis=0))
    assert parts.select("part").distinct().count() == parts.count() > 1
    # Lists are cut, and a vector probes several.
    assert sum(len(np.unique(np.frombuffer(r.list, "<i8"))) for r in parts.collect()) > int(len(held) ** 0.5 / 2)
    assert sum(np.unpackbits(np.frombuffer(r.probes, "u1")).sum() for r in parts.collect()) > (3 if kind == "isotropic" else 1) * len(held)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch


@pytest.mark.parametrize("few", [0, 1000])
def test_equal_vectors_are_one_class(spark, few, monkeypatch):
    """However many are repeated, also with one id or none, and with both zeros."""
    monkeypatch.setattr(vectors, "SMALL_ROWS", few)
    rows = [(5, [1.0, 0.0]), (3, [1.0, -0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (None, [1.0, 0.0]), (6, [1.0]), (7, [2.0, 0.01]),
            (9, [1.0, 0.0, 0.0]), (8, [1.0, 0.0, 0.0])]
    made = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in made)
    assert got == [(0, 0, None, False), (3, 3, 3, True), (3, 3, 3, True), (4, 0, 4, True), (5, 3, 3, False), (6, 0, 6, True),
                   (7, 3, 3, False), (8, 1, 8, True), (9, 1, 8, False)]


def test_candidates_are_all_within_the_bound():
    """The products keep every pair whose distance to the code is within what the code's error allows."""
    x = low_rank("clusters", np.random.default_rng(5))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    a, b = np.divmod(np.arange(len(x) ** 2), len(x))
    cosine = np.einsum("ij,ij->i", x[a], x[b]).reshape(len(x), -1)
    for least in (0.95, 1.0):
        model = vectors.train(x, 10_000, least)
        near = cosine >= least
        lists = model.lists(x)
        for at in np.unique(lists):
            own = np.flatnonzero(lists == at)
            codes, error, _ = model.coded(x[own], at)
            sides = model.asked(x), model.told(lists[own], codes, error)
            found = {(a, own[b]) for i, j in vectors.links(*sides, x, x[own], least) for a, b in zip(i, j)}
            assert found == {(a, b) for a, b in zip(*np.nonzero(near)) if b in own}


def test_keep_one_keeps_columns_named_like_helpers(spark):
    rows = [(1, "a b c d e", 7, 8), (2, "a b c d e", 9, 10)]
    made = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, __key int, key int"))
    assert [tuple(r) for r in made.collect()] == [rows[0]]
