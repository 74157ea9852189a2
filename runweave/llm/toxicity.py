"""Toxic passages by maximum-scoring segments of token log-odds.

Every token has a score: the log-odds of toxic against other documents under an informative Dirichlet prior,
whose counts are those of the whole corpus, less some standard errors. A linear scan finds all maximal
segments of a text (no part of one scores more, and none can grow). How high segments of harmless texts
score by chance is an extreme-value law; its parameters are fitted to labelled harmless texts, and turn the
segments of a text into one significance, and this, by a logistic curve, into a probability.

Words are counted by document, once each, as themselves and by their beginnings, so that inflected and
unseen forms have a score too; counts live in a hashed table of fixed size.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.llm.common import map_arrow, small, stored, text_batches

#: Counts are kept in ``2 ** BITS`` slots, whatever the vocabulary; beginnings of these lengths count.
BITS, BEGINNINGS = 18, (4, 5, 6, 7)
#: Weight of the corpus prior as a share of the labelled documents, standard errors that a score is lowered
#: by, and what each token costs a segment. Chosen on folds inside the learning rows.
PRIOR, CAUTION, DRIFT = 0.02, 3.0, 0.1
#: E-value up to which a segment counts as significant, and words that a worker remembers.
SIGNIFICANT, REMEMBERED = 0.05, 200_000
#: Characters of a text that are cut into words at a time.
PIECE = 1 << 20
_MASK, _OWN = (1 << BITS) - 1, zlib.crc32(b"=")

_WORD = re.compile(r"[^\W_]+")
_BREAK = re.compile(r"[\W_]")
#: Bins of token scores (for the law of chance) and of significances (for the curve).
SCORE_STEP, SCORE_BINS = 0.05, 400
LEVEL_STEP, LEVEL_BINS = 0.25, 400


def pieces(text: str) -> Iterator[list[str]]:
    """Words of a text as they stand, in lists of bounded size; all that is done to a word is done once a word."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = _BREAK.search(text, end)
            end = found.start() if found else len(text)
        yield _WORD.findall(text, at, end)
        at = end


def slots(word: str) -> tuple[int, ...]:
    """Slots of a word in lower case: its own, then those of its beginnings."""
    word = word.lower()
    raw, crc32, long = word.encode(), zlib.crc32, len(word)
    own = crc32(raw, _OWN) & _MASK
    if long < BEGINNINGS[0]:
        return (own,)
    if len(raw) == long:
        return (own, *[crc32(raw[:n]) & _MASK for n in BEGINNINGS if n <= long])
    return (own, *[crc32(word[:n].encode()) & _MASK for n in BEGINNINGS if n <= long])


class _Slots(dict):
    """Slots by word, up to ``REMEMBERED`` words."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = slots(word)
        return found


@lru_cache(maxsize=1)
def _slots() -> _Slots:
    """Those of a worker, from task to task."""
    return _Slots()


class _Scores(dict):
    """Score by word, up to ``REMEMBERED`` words: that of the slot with the strongest evidence."""

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        at = np.flatnonzero(weights)
        self.weights = dict(zip(at.tolist(), weights[at].tolist()))  # most slots say nothing

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        score, weight = 0.0, self.weights
        found = slots(word)
        if not weight.keys().isdisjoint(found):
            for slot in found:
                if slot in weight and abs(weight[slot]) > abs(score):
                    score = weight[slot]
        self[word] = score
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, begin, end)``, in order, by one scan from left to right.

    Segments that may still be joined lie on a stack with the sums before and after them. A positive score
    is a new segment; it joins back to the nearest one that began lower, if that one ended lower too. ``back``
    skips those that were searched already, which keeps the scan linear. Only positive scores are visited.
    """
    total = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    stack: list[tuple[float, float, int, int]] = []
    back: list[int] = []
    for at in np.flatnonzero(scores > 0).tolist():
        low, high, begin = total[at], total[at + 1], at
        k = len(stack) - 1
        while True:
            while k >= 0 and stack[k][0] >= low:
                k = back[k]
            if k < 0 or stack[k][1] >= high:
                break
            low, begin = stack[k][0], stack[k][2]
            del stack[k:], back[k:]
            k -= 1
        stack.append((low, high, begin, at + 1))
        back.append(k)
    return [(float(high - low), begin, end) for low, high, begin, end in stack]


@dataclass(frozen=True)
class Law:
    """Chance: in n tokens, segments of score s or more number n x k x exp(-rate x s) on average."""

    rate: float = 1.0
    k: float = 1.0

    def levels(self, n: int, scores: list[float]) -> list[float]:
        """Minus the logarithm of each segment's E-value, highest first."""
        room = math.log(max(1, n) * self.k) if self.k > 0 else 0.0
        return sorted((self.rate * s - room for s in scores), reverse=True)

    def level(self, n: int, scores: list[float]) -> float:
        """Significance of a text: minus the logarithm of the chance of its segments together, 0 at least.

        The r highest segments have normalised scores that sum up to t, which by chance happens with a
        probability of about exp(-t) t^(r-1) / (r! (r-1)!); the best r counts, of those that are
        significant by themselves, or the first one.
        """
        most, t = 0.0, 0.0
        for r, level in enumerate(self.levels(n, scores), 1):
            if r > 1 and level < -math.log(SIGNIFICANT):
                break
            t += level
            if t > 0:
                most = max(most, t - (r - 1) * math.log(t) + math.lgamma(r + 1) + math.lgamma(r))
        return most


@dataclass(frozen=True)
class Model:
    """Scores by slot, the law of chance, and the curve from significance to probability."""

    weights: np.ndarray
    law: Law
    base: float
    slope: float

    def probability(self, level: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.base + self.slope * level))))

    def segments(self, text: str | None, known: _Scores) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of tokens, and the maximal segments by token."""
        scores = token_scores(text, known)
        return len(scores), maximal_segments(scores)


def token_scores(text: str | None, known: _Scores) -> np.ndarray:
    """Score of each token of a whole text, less ``DRIFT``; 4 bytes a token.

    Documents were counted, not uses, so a word that comes again is weaker evidence: its k-th use in the
    text has a k-th of a positive score.
    """
    parts, used = [], Counter()
    for words in pieces(text or ""):
        scores = np.fromiter(map(known.__getitem__, words), np.float32, len(words))
        for at in np.flatnonzero(scores > 0).tolist():
            used[word := words[at].lower()] += 1
            scores[at] /= used[word]
        parts.append(scores)
    return (np.concatenate(parts) if parts else np.empty(0, np.float32)) - np.float32(DRIFT)


@lru_cache(maxsize=2)
def _scores(weights: bytes) -> _Scores:
    return _Scores(np.frombuffer(weights, np.float32))


def log_odds(toxic: np.ndarray, other: np.ndarray, corpus: np.ndarray, n: tuple[float, float], docs: float) -> np.ndarray:
    """Score of each slot from the documents that have it: toxic ones, others, and all of the corpus.

    The prior counts are the corpus' shares times ``PRIOR`` of the labelled documents. Log-odds are moved
    towards 0 by ``CAUTION`` standard errors.
    """
    weight = PRIOR * (n[0] + n[1])
    prior = np.maximum(weight * corpus / max(1.0, docs), 1e-9)
    odds = np.log((toxic + prior) / (n[1] + weight + 1)) - np.log((other + prior) / (n[0] + weight + 1))
    error = np.sqrt(1 / (toxic + prior) + 1 / (other + prior))
    return (np.sign(odds) * np.maximum(0.0, np.abs(odds) - CAUTION * error)).astype(np.float32)


def marks(labels: DataFrame, learn: Column) -> DataFrame:
    """``(doc_id, w0, w1, fold)`` of the ids that labels may be learnt from: labels by value, and one of two folds.

    A label other than 0 or 1 teaches nothing; an id with several labels counts for each.
    """
    by = F.col("doc_id").cast("bigint").alias("doc_id")
    found = labels.where("toxic in (0, 1)").where(learn).groupBy(by)
    found = found.agg(*[F.sum((F.col("toxic") == c).cast("double")).alias(f"w{c}") for c in (0, 1)])
    return found.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))


def _counts(docs: DataFrame) -> DataFrame:
    """``(slot, corpus, f0c0, f0c1, f1c0, f1c1)``: documents that have a slot; slot -1 counts them all.

    ``docs``: text, w0, w1, fold (null where nothing is learnt). Each task sums up in arrays of fixed size.
    """

    def run(batches):
        size = 1 << BITS
        sums, whole, known = np.zeros((5, size)), np.zeros(5), _slots()
        for batch in text_batches(batches, "text", 1 << 20):
            for text, w0, w1, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "w0", "w1", "fold"))):
                words = set().union(*pieces(text or ""))
                has = np.fromiter(set().union(*map(known.__getitem__, words)), np.int64)
                sums[0, has] += 1
                whole[0] += 1
                if fold is not None:
                    for c, w in ((0, w0), (1, w1)):
                        if w:
                            sums[1 + 2 * fold + c, has] += w
                            whole[1 + 2 * fold + c] += w
        if whole[0]:
            some = np.flatnonzero(sums[0])
            columns = [pa.array(np.append(some, -1))] + [pa.array(np.append(s[some], w)) for s, w in zip(sums, whole)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["slot", "corpus", "f0c0", "f0c1", "f1c0", "f1c1"]
    parts = map_arrow(docs, run, "slot bigint, " + ", ".join(f"{c} double" for c in names[1:]))
    return parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in names[1:]])


def _chance(bins: np.ndarray) -> float:
    """The rate for which scores drawn by the given bins have a mean exp(rate x score) of 1."""
    value = (np.arange(SCORE_BINS) - SCORE_BINS // 2) * SCORE_STEP
    share = bins / max(1.0, bins.sum())
    if not share[value > 0].sum() or share @ value >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while share @ np.exp(high * value) < 1 and high < 30:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if share @ np.exp(mid * value) < 1 else (low, mid)
    return high


def _curve(bins: np.ndarray) -> tuple[float, float]:
    """Base and slope of the logistic curve through counts by significance and class, slightly regularised."""
    x = np.arange(LEVEL_BINS) * LEVEL_STEP
    n, y = bins.sum(axis=0), bins[1]
    if not bins[0].sum() or not bins[1].sum():
        share = (bins[1].sum() + 1) / (bins.sum() + 2)
        return math.log(share / (1 - share)), 0.0
    design = np.stack([np.ones_like(x), x])
    beta, held = np.zeros(2), np.diag([1e-3, 1e-3])

    def loss(b: np.ndarray) -> float:
        z = b @ design
        return float(n @ np.logaddexp(0, z) - y @ z + 0.5 * b @ held @ b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -500, 500)))
        step = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + held, design @ (y - n * p) - held @ beta)
        size = 1.0
        while loss(beta + size * step) > loss(beta) and size > 1e-6:
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) where ``learn`` holds for a label.

    Counts of the prior cover all of ``docs``. Chance and curve are fitted to labelled documents scored by
    what the other fold has taught, so that a word does not vouch for the document it was learnt from.
    To the driver come one row a slot, and two histograms of fixed size.
    """
    known = stored(marks(labels, learn), "toxicity-marks")
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = _counts(named.join(small(known), "doc_id", "left").drop("doc_id")).toArrow()
    slot = found.column("slot").to_numpy()
    sums, whole = np.zeros((5, 1 << BITS)), np.zeros(5)
    for i, name in enumerate(("corpus", "f0c0", "f0c1", "f1c0", "f1c1")):
        value = found.column(name).to_numpy()
        sums[i, slot[slot >= 0]] = value[slot >= 0]
        whole[i] = value[slot < 0].sum()

    def weights(folds: tuple[int, ...]) -> np.ndarray:
        other, toxic = (sum(sums[1 + 2 * f + c] for f in folds) for c in (0, 1))
        n = tuple(float(sum(whole[1 + 2 * f + c] for f in folds)) for c in (0, 1))
        return log_odds(toxic, other, sums[0], n, whole[0])

    crossed = [weights((1,)).tobytes(), weights((0,)).tobytes()]

    def score(batches):
        bins = np.zeros(SCORE_BINS)
        columns = ["text", "w0", "w1", "fold"]
        for batch in text_batches(batches, "text", 1 << 20):
            made = []
            for text, w0, w1, fold in zip(*(batch.column(c).to_pylist() for c in columns)):
                scores = token_scores(text, _scores(crossed[fold]))
                made.append((w0, w1, len(scores), sorted((s for s, _, _ in maximal_segments(scores)), reverse=True)))
                if w0 and len(scores):
                    at = np.rint(scores / SCORE_STEP).astype(np.int64) + SCORE_BINS // 2
                    bins += w0 * np.bincount(np.clip(at, 0, SCORE_BINS - 1), minlength=SCORE_BINS)
            yield _records(made)
        yield _records([(None, None, None, bins.tolist())])

    def _records(made):
        kinds = (pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.float64()))
        arrays = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["w0", "w1", "n", "scores"])

    learnt = named.join(small(known), "doc_id").drop("doc_id")
    scored = stored(map_arrow(learnt, score, "w0 double, w1 double, n bigint, scores array<double>"), "toxicity-segments")
    by_bin = scored.where("n is null").select(F.posexplode("scores").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    bins = np.zeros(SCORE_BINS)
    for at, v in by_bin.collect():
        bins[at] = v
    rate = _chance(bins)
    # The most likely k of an extreme-value law with this rate, given each harmless text's highest segment.
    top = F.coalesce(F.get("scores", F.lit(0)), F.lit(0.0))
    texts = scored.where("n is not null")
    room = texts.agg(F.sum("w0"), F.sum(F.col("w0") * F.greatest(F.lit(1), "n") * F.exp(-rate * top))).first()
    law = Law(rate, float(room[0] / room[1]) if room[0] and room[1] else 1.0)

    def levels(batches):
        sums = np.zeros((2, LEVEL_BINS))
        for batch in batches:
            for w0, w1, n, scores in zip(*(batch.column(c).to_pylist() for c in ("w0", "w1", "n", "scores"))):
                at = min(LEVEL_BINS - 1, int(law.level(n, scores) / LEVEL_STEP))
                sums[0, at] += w0
                sums[1, at] += w1
        c, at = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(at), pa.array(sums[c, at])], names=["c", "at", "v"])

    by_level = map_arrow(texts, levels, "c bigint, at bigint, v double").groupBy("c", "at").agg(F.sum("v").alias("v"))
    counts = np.zeros((2, LEVEL_BINS))
    for c, at, v in by_level.collect():
        counts[c, at] = v
    return Model(weights((0, 1)), law, *_curve(counts))


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, begin, end, score, e_value, passage)`` of every significant toxic passage, by character.

    A row for each maximal segment that harmless texts of this length have ``SIGNIFICANT`` times or less on
    average. A text without any gives none; null texts have none; repeated rows give theirs each.
    """
    raw = model.weights.tobytes()

    def run(batches):
        known = _scores(raw)
        for batch in text_batches(batches, "text", 1 << 20):
            made = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n, found = model.segments(text, known)
                found = [(s, b, e, v) for s, b, e in found if (v := math.exp(-model.law.levels(n, [s])[0])) <= SIGNIFICANT]
                if found:
                    places = _places(text, sorted({x for _, b, e, _ in found for x in (b, e - 1)}))
                    for s, b, e, v in found:
                        begin, end = places[b][0], places[e - 1][1]
                        made.append((doc, begin, end, s, v, text[begin:end]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(zip(*made) if made else [()] * 6, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "begin", "end", "score", "e_value", "passage"])

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(named, run, "doc_id bigint, begin bigint, end bigint, score double, e_value double, passage string")


def _places(text: str, wanted: list[int]) -> dict[int, tuple[int, int]]:
    """Characters of the words with the given numbers (ascending)."""
    out, i = {}, 0
    for number, found in enumerate(_WORD.finditer(text)):
        if i == len(wanted):
            break
        if number == wanted[i]:
            out[number] = found.span()
            i += 1
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows of the fold that is never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, n_tokens, n_passages)`` of each row: the probability that it is toxic."""
    raw = model.weights.tobytes()

    def run(batches):
        known = _scores(raw)
        for batch in text_batches(batches, "text", 1 << 20):
            made = []
            for text in batch.column("text").to_pylist():
                n, found = model.segments(text, known)
                scores = [s for s, _, _ in found]
                many = sum(level >= -math.log(SIGNIFICANT) for level in model.law.levels(n, scores))
                made.append((model.probability(model.law.level(n, scores)), n, many))
            arrays = [pa.array(c, k) for c, k in zip(zip(*made), (pa.float64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], names=["doc_id", "score", "n_tokens", "n_passages"]
            )

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(named, run, "doc_id bigint, score double, n_tokens bigint, n_passages bigint")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_tokens, n_passages)`` of each row of ``docs``.

    Learnt from the labelled rows outside the held-out fold. Scores lie between 0 and 1 and are never null: an
    empty or null text has no token and the score of no evidence. Where a class has no labelled row, every
    score is the smoothed share of class 1. Repeated rows stay, a null id is never held out, and an empty
    table gives an empty one; other columns are not looked at.
    """
    model = fit(docs, labels, ~held_out())
    found = score(docs, model)
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_tokens",
        "n_passages",
    )
