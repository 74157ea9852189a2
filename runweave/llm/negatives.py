"""Hard negatives for anchors among labelled vectors, by exact maximum inner product search.

Rows lie in buckets of like length, longest first. Inside a bucket, cut into blocks of bounded size,
each coordinate has a sorted list of its values in the unit vectors. An anchor asks for scores of a known
least value, so the angle to a row is bounded, and each of the anchor's focus coordinates (its largest ones)
allows a range of values only. The ranges, found in the sorted lists, are intersected and what remains is
scored exactly. The least values come from a first meeting with one block of the longest rows, and only
buckets long enough to reach them are met at all.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runweave.llm.common import small, stored

#: Buckets by length at most, and coordinates of an anchor that are looked at.
BUCKETS, FOCUS = 16, 4
#: Numbers of one block of rows, and anchors of one block, on average; a block of 64 axes has 8,192 rows.
BLOCK_NUMBERS, ANCHORS = 1 << 19, 2048
#: Room for rounding in comparisons of cosines.
SLACK = 1e-9
#: A score must fit 64 bits; see ``mine``.
MOST_SQUARE = float(1 << 62)


class Block:
    """Rows of one bucket with the sorted list of each coordinate, made when first asked for."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, marks: np.ndarray, labels: np.ndarray) -> None:
        self.x, self.ids, self.marks, self.labels = x, ids, marks, labels
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(self.length.max(initial=0.0))
        self.unit = x / np.maximum(self.length, 1e-300)[:, None]
        # Whole numbers stay exact in doubles, whose products are fast, as long as sums are below 2**53.
        self.fast = x.astype(np.float64)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, axis: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers by their value on ``axis``, and these values."""
        if axis not in self.lists:
            order = np.argsort(self.unit[:, axis], kind="stable")
            self.lists[axis] = order, self.unit[order, axis]
        return self.lists[axis]

    def candidates(self, q: np.ndarray, least: float) -> np.ndarray | None:
        """Rows that may have a score of at least ``least`` with ``q``; None means all.

        For a positive ``least``, the angle between q and such a row is at most that of the cosine
        least / (|q| x longest row); so each coordinate of the row's unit vector lies between the cosines of
        q's own angle to the axis plus and minus that angle.
        """
        size = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        if least <= 0 or not size:
            return None
        cosine = least / (size * self.longest) if self.longest else 2.0
        if cosine > 1 + SLACK:
            return np.empty(0, np.int64)
        angle = np.arccos(min(1.0, cosine))
        axes = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
        own = np.arccos(np.clip(q[axes] / size, -1, 1))
        low = np.cos(np.minimum(np.pi, own + angle)) - SLACK
        high = np.cos(np.maximum(0.0, own - angle)) + SLACK
        cuts = []
        for axis, a, b in zip(axes.tolist(), low, high):
            order, values = self.sorted_list(axis)
            cuts.append((np.searchsorted(values, a, "left"), np.searchsorted(values, b, "right"), order))
        at = min(range(len(cuts)), key=lambda i: cuts[i][1] - cuts[i][0])
        rows = cuts[at][2][cuts[at][0] : cuts[at][1]]
        for i, axis in enumerate(axes.tolist()):
            if i != at:
                value = self.unit[rows, axis]
                rows = rows[(value >= low[i]) & (value <= high[i])]
        return rows

    def scores(self, q: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Exact inner products."""
        size = float(np.sqrt((q.astype(np.float64) ** 2).sum()))
        if size * self.longest < 2**52:
            x = self.fast if rows is None else self.fast[rows]
            return (x @ q.astype(np.float64)).astype(np.int64)
        return (self.x if rows is None else self.x[rows]) @ q


def best(block: Block, anchor: tuple, ranges: Sequence[tuple[int | None, int | None, int]], same: bool, k: int):
    """``(range, row, score)`` of up to ``k`` rows for each (low, high, floor) of an anchor.

    ``same``: rows of the anchor's label but not the anchor itself, else rows of other labels. Scores lie
    between low and high; what scores below ``floor`` is of no use. Higher first, then by id and mark.
    """
    number, mark, label, q = anchor
    least = min(floor for _, _, floor in ranges)
    rows = block.candidates(q, least)
    score = block.scores(q, rows)
    rows = np.arange(len(score)) if rows is None else rows
    fits = score >= least
    if same:
        fits &= (block.labels[rows] == label) & ((block.ids[rows] != number) | (block.marks[rows] != mark))
    else:
        fits &= block.labels[rows] != label
    rows, score = rows[fits], score[fits]
    if len(ranges) == 1 and len(rows) > 4 * k:
        # One range without an upper end: only what reaches the k-th score has to be sorted.
        if ranges[0][1] is None:
            reach = score >= -np.partition(-score, k - 1)[k - 1]
            rows, score = rows[reach], score[reach]
    order = np.lexsort((block.marks[rows], block.ids[rows], -score))
    rows, score = rows[order], score[order]
    for i, (low, high, floor) in enumerate(ranges):
        at = 0 if high is None else int(np.searchsorted(-score, -high, "left"))
        end = floor if low is None else max(low, floor)
        for j in range(at, min(at + k, len(rows))):
            if score[j] < end:
                break
            yield i, rows[j], score[j]


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // len(column))


_FOUND = "id bigint, mark bigint, slot int, row_id bigint, row_mark bigint, score bigint"


def _meet(rows: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """What every block of rows has for the anchors that meet it.

    ``rows``: part, bucket, xb, id, mark, label, v. ``anchors``: part, bucket, xb, qb, id, mark, label, v, ranges,
    one row for each block that the anchor meets. A row goes to the anchor blocks that meet its block.
    """

    def compare(x: pa.Table, asked: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(6)]
        if x.num_rows and asked.num_rows:
            x, asked = x.combine_chunks(), asked.combine_chunks()
            block = Block(
                _vectors(x.column("v").chunk(0)), *[x.column(c).to_numpy() for c in ("id", "mark", "label")]
            )
            q = _vectors(asked.column("q").chunk(0))
            who = zip(*[asked.column(c).to_pylist() for c in ("q_id", "q_mark", "q_label")], q)
            for anchor, ranges in zip(who, asked.column("ranges").to_pylist()):
                ends = [(r["low"], r["high"], r["floor"]) for r in ranges]
                for i, row, score in best(block, anchor, ends, same, k):
                    made = (anchor[0], anchor[1], i, block.ids[row], block.marks[row], score)
                    for column, value in zip(columns, made):
                        column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["id", "mark", "slot", "row_id", "row_mark", "score"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    keys = ["part", "bucket", "xb", "qb"]
    wanted = anchors.select(*keys).distinct()
    left = rows.join(wanted, ["part", "bucket", "xb"])
    asked = anchors.select(
        *[F.col(k).alias(f"q_{k}") for k in keys], F.col("id").alias("q_id"), F.col("mark").alias("q_mark"), F.col("label").alias("q_label"),
        F.col("v").alias("q"), "ranges",
    )
    met = left.groupBy(*keys).cogroup(asked.groupBy(*[f"q_{k}" for k in keys]))
    return met.applyInArrow(compare, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot; at most ``k`` rows a block go in, and Spark cuts them in the map tasks."""
    order = Window.partitionBy("id", "mark", "slot").orderBy(F.desc("score"), "row_id", "row_mark")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(rows: DataFrame, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """The first ``k`` rows of each range of each anchor, ``(id, mark, slot, row_id, row_mark, score, rank)``.

    ``rows``: part, bucket, id, mark, label, v, square; a larger bucket has longer rows. ``anchors``: part, id, mark,
    label, v, square, ranges.
    """
    numbers = F.max(F.size("v"))
    sizes = rows.groupBy("part", "bucket").agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * numbers / BLOCK_NUMBERS).cast("int")).alias("blocks"),
        F.max("square").alias("longest"),
    )
    sizes = stored(sizes, "negatives-buckets")
    spot = F.xxhash64("id", "mark")
    dealt = rows.join(small(sizes.drop("longest")), ["part", "bucket"]).withColumn(
        "xb", F.pmod(spot, "blocks").cast("int")
    )
    dealt = stored(dealt.drop("blocks", "square"), "negatives-blocks")
    cut = anchors.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("cuts"))
    asked = anchors.join(small(stored(cut, "negatives-cuts")), "part")
    asked = stored(asked.withColumn("qb", F.pmod(spot, "cuts").cast("int")).drop("cuts"), "negatives-anchors")
    # First one block of the longest rows of each part, for floors; a floor only spares work.
    top = sizes.groupBy("part").agg(F.max("bucket").alias("bucket"))
    seeds = asked.join(top, "part").withColumn("xb", F.lit(0))
    found = stored(_first(_meet(dealt, seeds, same, k), k), "negatives-first")
    # The k-th score found is the floor of a slot.
    floors = found.where(F.col("rank") == k).groupBy("id", "mark").agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floors")  # a slot a range: few
    )
    risen = F.transform(
        "ranges",
        lambda r, i: r.withField("floor", F.greatest(r["floor"], F.coalesce(F.col("floors")[i], r["floor"]))),
    )
    asked = asked.join(floors, ["id", "mark"], "left").withColumn("ranges", risen).drop("floors")
    least = F.array_min(F.transform("ranges", lambda r: r["floor"])).cast("double")
    reaches = (least <= 0) | (least <= F.sqrt("square") * F.sqrt("longest") * (1 + SLACK))
    # A row for each block to meet: buckets are few, blocks as many as the search has to look at.
    others = asked.join(sizes, "part").where(reaches)
    others = others.withColumn("xb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    others = others.join(top.withColumn("xb", F.lit(0)), ["part", "bucket", "xb"], "left_anti")
    rest = _meet(dealt, others, same, k)
    return _first(found.drop("rank").union(rest), k)


def prepared(rows: DataFrame, is_anchor: Column, scale: int = 256) -> DataFrame:
    """``(id, mark, label, v array<bigint>, square double, anchor)`` of the rows of ``(vec_id, embedding, label)`` that take part.

    ``v`` is floor(scale x component). Rows alike in all three count once; ``mark`` tells several rows
    of one id apart.
    """
    one = F.col("embedding")
    fine = F.forall(one, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & one.isNotNull() & F.coalesce(fine, F.lit(False))
    whole = F.transform(one, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    square = F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x)
    return (
        rows.where(good)
        .select(
            F.col("vec_id").cast("bigint").alias("id"),
            F.col("label").cast("bigint").alias("label"),
            whole.alias("w"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .withColumn("square", square)
        .where(F.col("square") < MOST_SQUARE)
        .select("id", "label", F.transform("w", lambda x: x.cast("bigint")).alias("v"), "square", "anchor")
        .distinct()
        .withColumn("mark", F.xxhash64("id", "label", "v"))
    )


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """Hard negatives: ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows``: vec_id, embedding, label; other columns are not looked at. ``is_anchor`` is a condition on vec_id.
    A score is the inner product of the vectors, each component scaled by 256 and rounded down. An anchor's
    positives are the first ``positives`` other rows of its label, higher scores first, then smaller ids. For
    each, the first ``negatives`` rows of other labels follow whose score lies between ``low`` and ``high``
    hundredths of the positive's. Rows with a null id, label or vector, or with a component that is null or
    not finite, take no part, nor do those whose squared length is beyond 2**62 after scaling, as
    their scores would not fit 64 bits. Vectors of different lengths do not meet; empty ones score 0. Rows
    alike in all three columns count once; an id may stand for several vectors. An anchor without
    positives, or a positive without such negatives, gives no rows; an empty table an empty one.
    """
    all_rows = stored(prepared(rows, is_anchor), "negatives-rows")
    marks = [i / BUCKETS for i in range(1, BUCKETS)]
    bounds = sorted(set(all_rows.agg(F.percentile_approx("square", marks, 1000)).first()[0] or []))
    bucket = F.lit(0)
    for bound in bounds:
        bucket = bucket + (F.col("square") > bound).cast("int")
    anchors = all_rows.where("anchor").drop("anchor")
    all_rows = all_rows.withColumn("bucket", bucket).drop("anchor")

    def span(of: Column, of_mark: Column, least: Column, most: Column, floor: Column) -> Column:
        kind = "bigint"
        named = [of.cast(kind).alias("of"), of_mark.cast(kind).alias("of_mark"), least.cast(kind).alias("low")]
        return F.struct(*named, most.cast(kind).alias("high"), floor.cast(kind).alias("floor"))

    none = F.lit(None)
    nothing = F.lit(-(2**63))
    by_label = F.concat_ws(":", F.size("v"), "label")
    found = _search(
        all_rows.withColumn("part", by_label),
        anchors.withColumn("part", by_label).withColumn("ranges", F.array(span(none, none, none, none, nothing))),
        True,
        positives,
    )
    found = stored(found.select("id", "mark", "row_id", "row_mark", "score", "rank"), "negatives-positives")
    # Whole numbers s with low x p <= 100 x s <= high x p.
    least = F.ceil(F.col("score").cast("decimal(20,0)") * low / 100)
    most = F.floor(F.col("score").cast("decimal(20,0)") * high / 100)
    ranges = found.groupBy("id", "mark").agg(
        F.sort_array(
            F.collect_list(F.struct("rank", span(F.col("row_id"), F.col("row_mark"), least, most, least).alias("r"), "score"))
        ).alias("p")
    )  # fmt: skip  # at most ``positives`` entries
    by_size = F.size("v").cast("string")
    asked = anchors.join(ranges, ["id", "mark"])
    wide = stored(
        asked.withColumn("part", by_size).withColumn("ranges", F.transform("p", lambda p: p["r"])), "negatives-ranges"
    )
    hard = _search(all_rows.withColumn("part", by_size), wide.drop("p"), False, negatives)
    named = wide.select("id", "mark", F.posexplode("p").alias("slot", "p"))
    return hard.join(named, ["id", "mark", "slot"]).select(
        F.col("id").alias("anchor_id"),
        F.col("p.r.of").alias("positive_id"),
        "rank",
        F.col("row_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
