"""Toxic passages: the segment scan against brute force, scores against a plain version, held-out labels."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from runweave.llm import toxicity
from runweave.llm.queries import QUERIES

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def all_maximal(scores):
    """Maximal segments by definition: the best segment, then those left and right of it."""
    best = None
    for b in range(len(scores)):
        total = 0.0
        for e in range(b, len(scores)):
            total += scores[e]
            if total > 0 and (best is None or total > best[0] or (total == best[0] and e + 1 - b < best[2] - best[1])):
                best = (total, b, e + 1)
    if best is None:
        return []
    left = all_maximal(scores[: best[1]])
    right = [(s, b + best[2], e + best[2]) for s, b, e in all_maximal(scores[best[2] :])]
    return [*left, best, *right]


def test_segments_against_definition():
    rng = np.random.default_rng(1)
    for _ in range(300):
        scores = rng.normal(-0.3, 1, rng.integers(0, 40)).astype(np.float32)
        got = toxicity.maximal_segments(scores)
        want = all_maximal(scores.astype(float))
        assert [(b, e) for _, b, e in got] == [(b, e) for _, b, e in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_scan_is_linear():
    up = np.tile(np.array([1.0, -0.999], np.float32), 300_000)
    down = np.tile(np.array([0.5, -1.0], np.float32), 300_000)
    nested = np.concatenate((np.repeat(np.float32(-1), 200_000), up, down))
    assert len(toxicity.maximal_segments(down)) == 300_000
    assert toxicity.maximal_segments(up)[0][1:] == (0, 599_999)
    assert len(toxicity.maximal_segments(nested)) > 300_000


def test_law_of_chance():
    value = np.array([2.0, -1.0])
    share = np.array([0.2, 0.8])
    bins = np.zeros(toxicity.SCORE_BINS)
    at = np.rint(value / toxicity.SCORE_STEP).astype(int) + toxicity.SCORE_BINS // 2
    bins[at] = share * 1000
    rate = toxicity._chance(bins)
    assert share @ np.exp(rate * value) == pytest.approx(1, abs=1e-6) and rate > 0.1
    law = toxicity.Law(1.0, 0.5)
    assert law.level(100, []) == 0 and law.level(100, [10.0]) == pytest.approx(10 - math.log(50))
    assert law.level(100, [10.0, 9.0]) > law.level(100, [10.0]) == law.level(100, [10.0, 1.0])


def test_curve():
    bins = np.zeros((2, toxicity.LEVEL_BINS))
    rng = np.random.default_rng(4)
    for x in rng.uniform(0, 40, 20_000):
        bins[int(rng.random() < 1 / (1 + math.exp(4 - 0.3 * x))), int(x / toxicity.LEVEL_STEP)] += 1
    base, slope = toxicity._curve(bins)
    assert base == pytest.approx(-4, abs=0.25) and slope == pytest.approx(0.3, abs=0.02)


def corpus(n=400):
    rng = random.Random(2)
    plain = [f"word{i}" for i in range(60)]
    bad = ["vile", "rotten", "wretch"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 120))]
        toxic = i % 3 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(bad) for _ in range(3)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def plain_counts(docs, labels):
    """Documents by slot: all, and the learning ones by fold and class, word by word."""
    sums, whole = Counter(), Counter()
    for i, text in docs:
        has = set()
        for w in (text or "").lower().replace("_", " ").split():
            mask = 2**toxicity.BITS - 1
            has |= {zlib.crc32(("=" + w).encode()) & mask} | {
                zlib.crc32(w[:k].encode()) & mask for k in (4, 5, 6, 7) if len(w) >= k
            }
        keys = ["corpus"]
        if i in labels and zlib.crc32(str(i).encode()) % 4 != 2:
            keys.append(labels[i])
        for k in keys:
            whole[k] += 1
            for s in has:
                sums[k, s] += 1
    return sums, whole


def test_weights_against_plain_counts(spark):
    docs, labels = corpus(120)
    model = toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), ~toxicity.held_out())
    sums, whole = plain_counts(docs, dict(labels))
    weight = toxicity.PRIOR * (whole[0] + whole[1])
    for s in {s for _, s in sums}:
        prior = weight * sums["corpus", s] / whole["corpus"]
        a, b = sums[1, s] + prior, sums[0, s] + prior
        odds = math.log(a / (whole[1] + weight + 1)) - math.log(b / (whole[0] + weight + 1))
        low = max(0.0, abs(odds) - toxicity.CAUTION * math.sqrt(1 / a + 1 / b))
        assert model.weights[s] == pytest.approx(math.copysign(low, odds), abs=1e-4)
    known = toxicity._Scores(model.weights)
    # The score of a text again, by the slow definition.
    rows = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(docs, DOCS), model).collect()}
    for i, text in docs[:40]:
        seen, scores = Counter(), []
        for w in text.split():
            seen[w] += 1
            score = known[w]
            scores.append((score / seen[w] if score > 0 else score) - toxicity.DRIFT)
        segments = [s for s, _, _ in all_maximal(scores)]
        assert rows[i].score == pytest.approx(model.probability(model.law.level(len(scores), segments)), abs=1e-4)


def test_passages_and_held_out(spark):
    docs, labels = corpus()
    df, marks = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    made = {r.doc_id: r for r in toxicity.classify(df, marks).collect()}
    assert all(made[i].predicted == t for i, t in labels)
    assert {i for i in made if made[i].held_out} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    model = toxicity.fit(df, marks, ~toxicity.held_out())
    found = toxicity.passages(df, model).collect()
    texts, bad = dict(docs), {"vile", "rotten", "wretch"}
    for r in found:
        assert texts[r.doc_id][r.begin : r.end] == r.passage and set(r.passage.split()) & bad and r.e_value <= 0.05
    assert {r.doc_id for r in found} == {i for i, t in labels if t}


def test_odd_rows(spark):
    docs, labels = corpus(150)
    long = "word1 " * 400_000 + "vile rotten wretch " + "x" * 2_500_000
    odd = [(None, "vile"), (1000, None), (1001, ""), (1002, "..."), (0, docs[0][1]), (0, docs[0][1]), (1003, long), (1004, "İİ_Vile_ROTTEN wretch")]
    labels = [*labels, (0, 0), (5, None), (6, 7), (None, 1), (9999, 1)]
    df = spark.createDataFrame([*docs, *odd], DOCS)
    for extra in ("w0", "w1", "fold", "n", "score"):
        df = df.withColumn(extra, F.lit("x"))
    made = toxicity.classify(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(made) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in made)
    by = {r.doc_id: r for r in made}
    assert by[1000].score == by[1001].score == by[1002].score < 0.3 and by[1000].n_tokens == 0
    assert by[1003].n_tokens == 400_004 and by[1004].n_tokens == 4 and by[1004].n_passages == 1
    assert not by[None].held_out and len([r for r in made if r.doc_id == 0]) == 3


def test_one_class_or_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert toxicity.classify(none, spark.createDataFrame([], LABELS)).count() == 0
    df = spark.createDataFrame([(i, "a b") for i in range(8)], DOCS)
    for labels, share in (([], 0.5), ([(i, 0) for i in range(8)], None)):
        made = toxicity.classify(df, spark.createDataFrame(labels, LABELS)).collect()
        assert len({r.score for r in made}) == 1 and (share is None or made[0].score == pytest.approx(share))


def test_held_out_labels(spark):
    """Accuracy where no label was learnt from."""
    sf_dir = "/root/testdata/sf0.1"
    made = QUERIES["op12_toxicity"](spark, sf_dir).where("held_out")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = made.join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(toxic) > 0.75 and np.mean(clean) < 0.05


def test_words_are_learnt_once_a_worker_by_their_own_hash_and_that_of_their_beginnings():
    import zlib

    for word in ("a", "abc", "ABCd", "abcdefgh", "Été", "naïveté", "日本語日本語日本"):
        low = word.lower()
        keys = ["=" + low, *[low[:n] for n in (4, 5, 6, 7) if len(low) >= n]]
        want = tuple(zlib.crc32(key.encode()) % 2**18 for key in keys)
        assert toxicity.slots(word) == want and toxicity._slots()[word] == want
    assert "abc" in toxicity._slots()
