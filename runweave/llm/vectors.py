"""Near duplicates among embeddings by product quantisation.

Coarse centroids deal the vectors to inverted lists; what is left of a vector after its centroid is
coded by the nearest of some codewords in each subspace. A vector probes every list that a vector close
enough may lie in, gets distances to the codes from its lookup table, and settles what may be close
enough by the exact cosine. Quantisation alone loses nothing: the table's distance is allowed to miss
by the stored error of each code.

Where vectors point in many directions a vector probes a good part of the lists, so nothing is sent once a
probe: lists are cut into blocks and these dealt to parts, a row each, and pairs of parts are read from the shared
folder as they meet.
"""

from __future__ import annotations

import hashlib
import math
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.llm.common import SMALL_ROWS, map_arrow, stored
from runweave.llm.components import components

#: Rows to fit centroids and codewords on, the least by a hash of the id; every row is indexed.
SAMPLE = 16_384
#: Bounds of the number of lists, and words a subspace; with them the model stays below some MB.
MOST_LISTS, WORDS = 1024, 256
#: Rows of one list that one block holds at most, on average.
BLOCK = 2048
#: Bytes of a part and of a file of parts, numbers taken for doubles; of either there are ``LEAST`` at least if there are
#: as many blocks, and of files ``MOST_FILES`` at most, as tasks are pairs of these.
PART_BYTES, FILE_BYTES, LEAST, MOST_FILES = 4 << 20, 16 << 20, 48, 256
#: Edges of a task that are held before they are thinned to a spanning forest.
EDGES = 1 << 20


def _kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        order = np.argsort(at, kind="stable")
        full = np.flatnonzero(n)
        starts = np.concatenate(([0], np.cumsum(n)))[full]
        c[full] = np.add.reduceat(x[order], starts, axis=0) / n[full, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = 0.5 * (c * c).sum(axis=1)
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = (x[i : i + 4096] @ c.T - half).argmax(axis=1)
    return out


@dataclass(frozen=True)
class Model:
    """Centroids, codewords by subspace, and how far apart two vectors may be."""

    centroids: np.ndarray
    words: np.ndarray  # subspace, word, axis
    radius: float

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each unit vector."""
        return _nearest(x, self.centroids)

    def coded(self, x: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes and coding errors of unit vectors of list ``at``, and whether each has to probe each list.

        A vector within ``radius`` of x lies in another list only if the border between the two lists, a
        plane, is within ``radius`` of x. All such lists are probed, so no link is lost, whatever the data.
        """
        m, _, axes = self.words.shape
        rest = np.pad(x - self.centroids[at], ((0, 0), (0, m * axes - x.shape[1])))
        codes = np.empty((len(x), m), np.uint8)
        for s in range(m):
            part = rest[:, s * axes : (s + 1) * axes]
            codes[:, s] = _nearest(part, self.words[s])
            part -= self.words[s][codes[:, s]]
        error = np.sqrt((rest * rest).sum(axis=1))
        c = self.centroids
        square = (c * c).sum(axis=1)
        away = square - 2 * (x @ c.T)
        between = np.sqrt(np.maximum(0, square[at] + square - 2 * (c @ c[at])))
        return codes, error, (away - away[:, at : at + 1]) / 2 <= self.radius * between + 1e-9

    def asked(self, q: np.ndarray) -> np.ndarray:
        """The side of unit vectors that ask, for ``links``."""
        m, _, axes = self.words.shape
        q = np.pad(q, ((0, 0), (0, m * axes - q.shape[1])))
        return np.column_stack((q, np.ones(len(q)), -(q * q).sum(axis=1) / 2)).astype(np.float32)

    def told(self, lists: np.ndarray, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """The side of list members that are known by their codes, for ``links``.

        A code is looked up in the words of all subspaces. The distance to it is within the radius and the stored
        error where the product of the two sides is not below zero: 2 q.x - q.q - x.x + most >= 0.
        """
        m, _, axes = self.words.shape
        x = np.concatenate([self.words[s][codes[:, s]] for s in range(m)], axis=1)
        x[:, : self.centroids.shape[1]] += self.centroids[lists]
        square = (x * x).sum(axis=1)
        # As much more as single precision may miss.
        room = 2.0**-23 * (m * axes + 2) * (2 + np.sqrt(square)) ** 2
        most = (self.radius + error + 1e-4) ** 2 + room
        return np.column_stack((x, (most - square) / 2, np.ones(len(x)))).astype(np.float32)


def links(asked: np.ndarray, told: np.ndarray, q: np.ndarray, x: np.ndarray, least: float):
    """Row and column numbers of the pairs of ``q`` and ``x`` with cosine >= ``least``, by their sides and exactly."""
    told = np.ascontiguousarray(told.T)
    for i in range(0, len(q) if len(x) else 0, 256):
        a, b = np.divmod(np.flatnonzero(asked[i : i + 256] @ told >= 0), len(x))
        for j in range(0, len(a), 1 << 14):
            aa, bb = a[j : j + (1 << 14)] + i, b[j : j + (1 << 14)]
            close = np.einsum("ij,ij->i", q[aa], x[bb]) >= least
            yield aa[close], bb[close]


def train(sample: np.ndarray, n: int, least: float) -> Model:
    """A model for about ``n`` vectors from a sample of unit vectors."""
    lists = int(min(MOST_LISTS, max(1, math.sqrt(n) / 2)))
    centroids = _kmeans(sample, lists, 8)
    rest = sample - centroids[_nearest(sample, centroids)]
    m = max(1, math.ceil(sample.shape[1] / 4))
    rest = np.pad(rest, ((0, 0), (0, 4 * m - rest.shape[1])))[:8192]
    words = np.stack([_kmeans(rest[:, 4 * s : 4 * s + 4], WORDS, 5) for s in range(m)])
    return Model(centroids, words, math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)  # so that squares of very large or small numbers stay finite
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _numbers(column: pa.Array) -> np.ndarray:
    """All numbers of a column of vectors: floats as they are, others as doubles."""
    x = column.flatten().to_numpy(zero_copy_only=False)
    return x if x.dtype == np.float32 else x.astype(np.float64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of ``dim`` numbers each."""
    return _numbers(column).reshape(-1, dim)


def _spanning(rows: np.ndarray, columns: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same nodes as all links do, one a node at most: each hangs on its least."""
    label = names.copy()
    at, inverse = np.unique(names, return_inverse=True)
    least = at[inverse].copy()
    while True:
        before = label.copy()
        np.minimum.at(label, rows, before[columns])
        np.minimum.at(label, columns, before[rows])
        # A name may stand on both sides: its rows share the least label, and a label's own label counts.
        by_name = np.full(len(at), np.iinfo(np.int64).max)
        np.minimum.at(by_name, inverse, label)
        where = np.searchsorted(at, by_name)
        by_name = np.minimum(by_name, by_name[where])
        label = by_name[inverse]
        if (label == before).all():
            break
    move = label != least
    return names[move], label[move]


def _thinned(edges: list[np.ndarray]) -> np.ndarray:
    """Edges ``(2, n)`` that join the same nodes as all of ``edges``, one a node at most."""
    both = np.concatenate([np.empty((2, 0), np.int64), *edges], axis=1)
    if not both.size:
        return both
    names, at = np.unique(both, return_inverse=True)
    at = at.reshape(both.shape)
    return np.stack(_spanning(at[0], at[1], names))


@contextmanager
def _rows_of_a_batch(spark: SparkSession, n: int):
    """What is written meanwhile goes to Python in Arrow batches of ``n`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, n)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class _Part(NamedTuple):
    """Vectors in the order of their lists, and for each the lists that it has to probe, a bit a list."""

    part: int
    node: np.ndarray
    size: np.ndarray
    list: np.ndarray
    error: np.ndarray
    code: np.ndarray
    probes: np.ndarray
    v: np.ndarray

    COLUMNS = ("node", "size", "list", "error", "code", "probes", "v")
    SCHEMA = f"part bigint, {' binary, '.join(COLUMNS)} binary, kind string"

    @classmethod
    def read(cls, row: dict, side: str) -> _Part:
        kinds = ("<i8", "<i8", "<i8", "<f8", "u1", "u1", row[f"{side}kind"])
        *plain, code, probes, v = (np.frombuffer(row[side + c], k) for c, k in zip(cls.COLUMNS, kinds))
        return cls(row[f"{side}part"], *plain, *(x.reshape(len(plain[0]), -1) for x in (code, probes, v)))

    def lists(self) -> list[tuple[int, np.ndarray]]:
        """Each list with the numbers of its vectors."""
        cuts = np.flatnonzero(np.diff(self.list)) + 1
        return [(int(self.list[rows[0]]), rows) for rows in np.split(np.arange(len(self.list)), cuts)]

    def asking(self, rows: np.ndarray, at: int) -> np.ndarray:
        """Those of ``rows`` that have to probe list ``at``."""
        return rows[(self.probes[rows, at >> 3] >> (7 - (at & 7)) & 1).astype(bool)]


def _packed(rows: pa.Table, lists: np.ndarray, model: Model, dim: int) -> pa.Table:
    """The rows of one part, whose lists are ``lists``, as one row."""
    order = np.lexsort((rows.column("node").to_numpy(), lists))
    rows, lists = rows.take(order), lists[order]
    v = _matrix(rows.column("v").combine_chunks(), dim)
    codes, errors, probes = [], [], []
    for own in np.split(np.arange(len(v)), np.flatnonzero(np.diff(lists)) + 1):
        code, error, probe = model.coded(_unit(v[own]), int(lists[own[0]]))
        codes.append(code)
        errors.append(error)
        probes.append(np.packbits(probe, axis=1))
    columns = [rows.column("node").to_numpy(), rows.column("size").to_numpy(), lists]
    columns += [*map(np.concatenate, (errors, codes, probes)), v]
    one = {c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(_Part.COLUMNS, columns)}
    return pa.table({"part": rows.column("part")[:1]} | one | {"kind": pa.array([v.dtype.str])})


def _parts(classes: DataFrame, model: Model, dim: int) -> DataFrame:
    """A row for each part; each class is in one. A list with many classes is in several."""
    lists = len(model.centroids)

    def each(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                yield part, model.lists(_unit(_matrix(part.column("v"), dim)))

    def count(batches):
        held = np.zeros(lists, np.int64)
        for _, at in each(batches):
            held += np.bincount(at, minlength=lists)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(lists)), pa.array(held)], names=["list", "n"])

    # One row a list, so MOST_LISTS at most.
    held = map_arrow(classes.select("v"), count, "list bigint, n bigint").groupBy("list").agg(F.sum("n").alias("n"))
    n = np.zeros(lists, np.int64)
    for at, rows in held.collect():
        n[at] = rows
    cut = np.maximum(1, -(-n // BLOCK))
    first = np.concatenate(([0], np.cumsum(cut)))
    whole = int(n.sum()) * (8 * dim + 2 * lists // 8 + 32)
    parts = min(int(first[-1]), max(LEAST, whole // PART_BYTES))
    files = min(parts, MOST_FILES, max(LEAST, whole // FILE_BYTES))

    def deal(batches):
        for part, at in each(batches):
            spot = part.column("node").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            spot = (spot >> np.uint64(33)).astype(np.int64)
            block = first[at] + spot % cut[at]
            part = part.append_column("list", pa.array(at, pa.int32()))
            yield part.append_column("part", pa.array(block % parts))

    def pack(rows: pa.Table) -> pa.Table:
        return _packed(rows, rows.column("list").to_numpy().astype(np.int64), model, dim)

    schema = f"node bigint, size bigint, v {classes.schema['v'].dataType.simpleString()}, list int, part bigint"
    dealt = map_arrow(classes.select("node", "size", "v"), deal, schema)
    made = dealt.repartition(files, "part").groupBy("part").applyInArrow(pack, _Part.SCHEMA)
    return stored(made, "vectors-parts")


def _near(classes: DataFrame, n: int, dim: int, least: float) -> DataFrame:
    """``(a, b, n)`` for the ``n`` classes of one dimension: n linked rows of a (b null), or an edge (n 0).

    Each pair of parts meets in one row; of two lists in them only vectors that probe the other's list are
    compared. No row is shuffled for it: a task reads some parts, and sends a number a vector and a forest.
    """
    spark = classes.sparkSession
    sample = classes.select("v").orderBy(F.xxhash64("node"), "node").limit(SAMPLE).toArrow()
    sample = _unit(_matrix(sample.column("v").combine_chunks(), dim))
    model = train(sample, n, least)
    parts = _parts(classes, model, dim)

    def compare(batches):
        held, edges, n_edges, most_edges, last = {}, [], 0, EDGES, None
        for row in (row for batch in batches for row in batch.to_pylist()):
            a, b = _Part.read(row, "a_"), _Part.read(row, "b_")
            if a.part != last:  # many rows one after the other have it on the left
                last, q = a.part, _unit(a.v)
                asked = model.asked(q)
            x = q if a.part == b.part else _unit(b.v)
            told = model.told(b.list, b.code, b.error)
            count_a, count_b = (held.setdefault(s.part, (s.node, np.zeros(len(s.node), np.int64)))[1] for s in (a, b))
            for (from_list, from_rows), (to_list, to_rows) in product(a.lists(), b.lists()):
                if a.part == b.part and from_list > to_list:
                    continue
                ours, theirs = a.asking(from_rows, to_list), b.asking(to_rows, from_list)
                for i, j in links(asked[ours], told[theirs], q[ours], x[theirs], least):
                    i, j = ours[i], theirs[j]
                    if a.part == b.part:
                        once = i < j
                        i, j = i[once], j[once]
                    np.add.at(count_a, i, b.size[j])
                    np.add.at(count_b, j, a.size[i])
                    edges.append(np.stack((a.node[i], b.node[j])))
                    n_edges += len(i)
                    if n_edges > most_edges:
                        edges = [_thinned(edges)]
                        n_edges = edges[0].shape[1]
                        most_edges = max(EDGES, 2 * n_edges)
        frm, to = _thinned(edges)
        counted = [(node[n > 0], n[n > 0]) for node, n in held.values()]
        nodes, numbers = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*counted) if counted else ((), ())))
        columns = [
            pa.array(np.concatenate((nodes, frm))),
            pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(to)]),
            pa.array(np.concatenate((numbers, np.zeros(len(frm), np.int64)))),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n"])

    a, b = (parts.select(*[F.col(c).alias(f"{side}_{c}") for c in parts.columns]) for side in "ab")
    # Of two parts now the one and now the other is on the left, so that tasks have alike much to do.
    even = (F.col("a_part") + F.col("b_part")) % 2 == 0
    meet = (F.col("a_part") == F.col("b_part")) | ((F.col("a_part") < F.col("b_part")) == even)
    pairs = a.join(b.hint("shuffle_replicate_nl"), meet)
    with _rows_of_a_batch(spark, 1):
        return stored(map_arrow(pairs, compare, "a bigint, b bigint, n bigint"), "vectors-links")


def _vector_key(v: Column) -> Column:
    """128 bits that stand for a vector; both zeros are one number."""

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        x = _numbers(column)
        raw = memoryview((x + x.dtype.type(0)).tobytes())
        ends = np.cumsum(column.value_lengths().to_numpy()) * x.itemsize
        return pa.array([hashlib.md5(raw[i:j]).digest() for i, j in zip([0, *ends], ends)], pa.binary())

    return run(v)


def _classes(usable: DataFrame) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """Classes ``(node, size, v)`` of equal vectors, the class ``(vec_id, node, size)`` of each row, and the
    number of classes by the length of their vectors.

    Rows and classes find each other by a short key. Unless many vectors are repeated, no vector is
    shuffled or written for that: one row of each class is told from the others when rows are read.
    """
    key = _vector_key(F.col("v")).alias("key")
    keyed = stored(usable.select("vec_id", F.size("v").alias("dim"), key), "vectors-keys")
    size = F.count(F.lit(1)).alias("size")
    found = keyed.groupBy("key").agg(F.min("vec_id").alias("node"), size, F.first("dim").alias("dim"))
    found = stored(found, "vectors-found")
    member = stored(keyed.join(found, "key").select("vec_id", "node", "size"), "vectors-member")
    dims = {dim: n for dim, n in found.groupBy("dim").agg(F.count(F.lit(1))).orderBy("dim").collect()}
    repeated = stored(found.where("size > 1").select("key", "node", "size"), "vectors-repeated")
    n = repeated.limit(SMALL_ROWS + 1).count()
    if n > SMALL_ROWS:
        classes = stored(usable.groupBy("v").agg(F.min("vec_id").alias("node"), size), "vectors-classes")
        return classes.select("node", "size", "v"), member, dims
    rows = usable.select("vec_id", "v")
    if n:
        rows = rows.select("vec_id", "v", key).join(F.broadcast(repeated), "key", "left")
        first = rows.where("vec_id = node").groupBy("key").agg(*[F.first(c).alias(c) for c in ("node", "size", "v")])
        rows = rows.where("size is null")
    classes = rows.select(F.col("vec_id").alias("node"), F.lit(1).cast("bigint").alias("size"), "v")
    return classes.union(first.select("node", "size", "v")) if n else classes, member, dims


def near_duplicates(rows: DataFrame, least: float = 0.95) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row of ``(vec_id, embedding)``.

    Equal vectors form a class, whose rows are linked with one another; classes are linked at a cosine of
    ``least`` or more in double precision. A vector that is null, zero or empty, or holds a null or
    a number that is not finite, links with nothing, nor do vectors of different lengths; a row without
    an id neither, and has a null component. Repeated rows count as vectors of their own; an id with
    several vectors is one node. An empty table gives an empty one.
    """
    one = F.col("embedding")
    good = one.isNotNull() & (F.size(one) > 0) & F.col("vec_id").isNotNull()
    good = good & F.forall(one, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = good & F.exists(one, lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.withColumn("v", F.when(F.coalesce(good, F.lit(False)), one)).drop("embedding")
    usable = rows.where("v is not null")
    classes, member, dims = _classes(usable)
    found = None
    for dim, n in dims.items():
        part = _near(classes.where(F.size("v") == dim), n, dim, least)
        found = part if found is None else found.union(part)
    apart = rows.where("v is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if found is None:
        return apart.withColumn("kept", F.col("vec_id").isNotNull())
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    linked = (
        member.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "vec_id",
            (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
    )
    return linked.union(apart).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
