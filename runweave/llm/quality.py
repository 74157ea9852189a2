"""Document quality by a regularised quadratic discriminant.

Every whole text becomes a vector of transformed statistics: logarithms of sizes and smoothed log-odds
of shares. Each class has a normal density whose covariance is shrunk; a score is the difference of
the two log densities, worked out from Mahalanobis distances with the Cholesky factors of the model.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.llm.common import map_arrow, stored, text_batches

FEATURES = (
    "log words", "log bytes a word", "log words a line", "upper case", "beyond ASCII", "digits",
    "full stops and commas", "other marks", "words with other marks", "repeated neighbours",
    "distinct words", "most frequent word", "repeated lines", "short words",
)
SIZE = len(FEATURES)

_KINDS = np.full(256, 5)  # 0 upper, 1 lower, 2 digit, 3 full stop or comma, 4 space, 5 other, 6 beyond ASCII
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58], _KINDS[[44, 46]] = 0, 1, 2, 3
_KINDS[9:14], _KINDS[32], _KINDS[128:] = 4, 4, 6
_MARKS = frozenset("!\"#$%&*+/:;<=>?@[\\]^_`{|}~")


def _odds(part: float, whole: float) -> float:
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; null counts as empty, and all have a value."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    kind = np.bincount(_KINDS, weights=np.bincount(raw, minlength=256), minlength=7)
    upper, lower, digits, stops, _, other, beyond = kind.tolist()
    words = text.split()
    counts = Counter(words)
    n, size = len(words), max(1.0, upper + lower + digits + stops + other + beyond)
    lines = [x for x in text.splitlines() if x.strip()]
    marked = sum(c for w, c in counts.items() if not _MARKS.isdisjoint(w))
    short = sum(c for w, c in counts.items() if len(w) <= 3)
    return [
        math.log1p(n),
        math.log(size / max(1, n)),
        math.log((n + 1) / (len(lines) + 1)),
        _odds(upper, upper + lower),
        _odds(beyond, size),
        _odds(digits, size),
        _odds(stops, size),
        _odds(other, size),
        _odds(marked, n),
        _odds(sum(map(eq, words, words[1:])), n),
        _odds(len(counts), n),
        _odds(max(counts.values(), default=0), n),
        _odds(len(lines) - len(set(lines)), len(lines)),
        _odds(short, n),
    ]


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(-1, SIZE)


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, f array<double>)`` of each row of ``docs``; no other column is looked at."""

    def run(batches):
        for batch in text_batches(batches, "text", 1 << 20):
            x = matrix(batch.column("text").to_pylist())
            flat = pa.array(x.reshape(-1))
            cuts = pa.array(np.arange(0, len(flat) + 1, SIZE, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(cuts, flat)], names=["doc_id", "f"]
            )

    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    return map_arrow(docs, run, "doc_id bigint, f array<double>")


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log weights of class 0 and class 1."""

    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]
    weights: tuple[float, ...]
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row; the share of class 1 where a class was never seen."""
        if not self.means:
            return np.full(len(x), self.share)
        log = []
        for mean, factor, weight in zip(self.means, self.factors, self.weights):
            z = (x - mean) @ factor.T
            log.append(weight - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def _model(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float, floor: float) -> Model:
    n = {c: moments[c][0] if c in moments else 0.0 for c in (0, 1)}
    share = (n[1] + 1) / (n[0] + n[1] + 2)
    if not n[0] or not n[1]:
        return Model((), (), (), share)
    means = {c: moments[c][1] / n[c] for c in (0, 1)}
    scatter = {c: moments[c][2] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)}
    pooled = np.diag(np.maximum(np.diag(scatter[0] + scatter[1]) / (n[0] + n[1]), floor))
    factors, weights = [], []
    for c in (0, 1):
        # As if ``shrink * SIZE`` more rows had the pooled variances and no correlations.
        extra = shrink * SIZE
        cov = (scatter[c] + extra * pooled) / (n[c] + extra) + floor * np.eye(SIZE)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        weights.append(math.log(n[c] / (n[0] + n[1])) - float(np.log(np.diag(lower)).sum()))
    return Model((means[0], means[1]), tuple(factors), tuple(weights), share)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows of the fold that is never learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(rows: DataFrame, labels: DataFrame, shrink: float = 8.0, floor: float = 0.5) -> Model:
    """Learn from the labelled ``rows`` (of ``features``) outside the held-out fold, from all of them.

    A label other than 0 or 1 teaches nothing; an id with several labels counts for each. Moments are
    summed inside the tasks; 2 x (1 + 14 + 14 x 14) numbers come to the driver.
    """
    marks = (
        labels.where("quality in (0, 1)")
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(*[F.sum((F.col("quality") == c).cast("double")).alias(f"w{c}") for c in (0, 1)])
    )

    def run(batches):
        n, s, q = np.zeros(2), np.zeros((2, SIZE)), np.zeros((2, SIZE, SIZE))
        for batch in batches:
            x = np.array(batch.column("f").to_pylist(), float).reshape(-1, SIZE)
            for c in (0, 1):
                w = batch.column(f"w{c}").to_numpy()
                n[c] += w.sum()
                s[c] += w @ x
                q[c] += (x * w[:, None]).T @ x
        for c in (0, 1):
            flat = [np.concatenate(([n[c]], s[c], q[c].reshape(-1)))]
            yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array(flat)], names=["c", "m"])

    parts = map_arrow(rows.join(marks, "doc_id").select("f", "w0", "w1"), run, "c bigint, m array<double>")
    sums = parts.select("c", F.posexplode("m").alias("i", "v")).groupBy("c", "i").agg(F.sum("v").alias("v"))
    flat = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for c, i, v in sums.collect():
        flat[c, i] = v
    moments = {
        c: (flat[c, 0], flat[c, 1 : 1 + SIZE], flat[c, 1 + SIZE :].reshape(SIZE, SIZE)) for c in (0, 1)
    }
    return _model(moments, shrink, floor)


def score_features(model: Model, f: Column) -> Column:
    """Score of a column made by ``features``."""

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(x.tolist(), float).reshape(-1, SIZE)))

    return run(f)


def score_text(model: Model, text: Column) -> Column:
    """Score of a column of texts."""

    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(model.scores(matrix(x.tolist())))

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of each row of ``docs``, learnt from ``labels`` of these rows.

    Scores lie between 0 and 1 and are never null: a null or empty text has statistics as well. Where
    a class has no labelled row, every score is the smoothed share of class 1. Repeated rows stay, a
    null id is never held out, an empty table gives an empty one.
    """
    rows = stored(features(docs), "quality")
    model = fit(rows, labels)
    scored = rows.select("doc_id", held_out().alias("held_out"), score_features(model, F.col("f")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, all columns kept; see ``classify``."""
    model = fit(features(docs), labels)
    return docs.where(score_text(model, F.col("text")) >= threshold)
