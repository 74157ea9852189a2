"""Near duplicates by SimHash, found in the space of per-segment bit counts.

A 64-bit fingerprint is cut into segments, and maps to the vector of bit counts of its segments.
Two fingerprints that differ in d bits have vectors at Manhattan distance d or less, so all links
lie within ``max_bits`` in that space. The join is a range join on a grid over it: the axes fall
into ``max_bits + 3`` groups, a distance of ``max_bits`` can touch ``max_bits`` groups at most, and so
two linked fingerprints have the very same counts in three groups. Each choice of three groups with
its counts is one grid cell; fingerprints that meet in a cell are tested by Manhattan distance, and
what passes by the exact number of differing bits. No link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.llm.common import content_key, fresh, map_arrow, stored, text_batches
from runweave.llm.components import components
from runweave.llm.xxh64 import slices_hash

SEED = 42
SEGMENTS = 32
_BLOCK = 1 << 15


def fingerprints_of(texts: list[str | None], words: int, seed: int = SEED) -> np.ndarray:
    """SimHash of each text; see ``fingerprints``."""
    plain = [b" ".join((t or "").encode().lower().split()) for t in texts]
    buffer = b"\n".join(plain)
    out = np.zeros(len(texts), np.uint64)
    if not buffer.strip(b"\n"):
        return out
    raw = np.frombuffer(buffer, np.uint8)
    cut = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.concatenate(([0], cut + 1))
    ends = np.concatenate((cut, [len(raw)]))
    doc = np.concatenate(([0], np.cumsum(raw[cut] == 10)))
    full = ends > starts  # an empty text leaves one empty word
    starts, ends, doc = starts[full], ends[full], doc[full]
    n_words = np.bincount(doc, minlength=len(texts))
    last = np.minimum(np.cumsum(n_words)[doc] - 1, np.arange(len(doc)) + words - 1)
    # A shingle starts at each word that has enough words after it, or at the first word.
    first = np.concatenate(([True], doc[1:] != doc[:-1]))
    use = (last - np.arange(len(doc)) == words - 1) | first
    s, e, owner = starts[use], ends[last[use]], doc[use]
    ones = np.zeros((len(texts), 64), np.int64)
    for i in range(0, len(s), _BLOCK):
        h = slices_hash(buffer, s[i : i + _BLOCK], e[i : i + _BLOCK], seed)
        own = owner[i : i + _BLOCK]
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
        ones[own[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    n = np.bincount(owner, minlength=len(texts))
    major = (2 * ones > n[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``(doc_id, key, fp bigint)`` of each row: the SimHash of its whole text; ``key`` stands for the text.

    A-Z become a-z; words lie between white space of ASCII; shingles are ``words`` words joined by one
    space, repeats counted, or the whole sequence where a text has fewer words. A bit is set if it
    is set in over half of the shingles' XXH64. A text without words, null too, has fingerprint zero.
    """

    def run(batches):
        for batch in text_batches(batches, "text", 1 << 20):
            fps = fingerprints_of(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(fps.view(np.int64))],
                names=["doc_id", "key", "fp"],
            )

    docs = docs.select(F.col("doc_id").cast("bigint"), content_key().alias("key"), "text")
    return map_arrow(docs, run, "doc_id bigint, key binary, fp bigint")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def segment_counts(fp: Column) -> Column:
    """The embedding: the bit counts (0 to 2) of all 32 two-bit segments, in unary (00, 01, 11) in one long.

    Equal places are equal counts, and the number of differing bits of two such longs is the sum of
    the absolute differences of their counts.
    """
    low = F.lit(0x5555555555555555).cast("bigint")
    high = F.lit(-0x5555555555555556).cast("bigint")
    some = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(low)
    both = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(high)
    return some.bitwiseOR(both)


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings, never above the Hamming distance of the fingerprints."""
    return F.bit_count(a.bitwiseXOR(b))


def group_masks(max_bits: int) -> list[int]:
    """Masks over the embedding: each keeps three of the ``max_bits + 3`` groups of axes."""
    groups = max_bits + 3
    own = [0] * groups
    for axis in range(SEGMENTS):
        own[axis * groups // SEGMENTS] |= 3 << (2 * axis)
    masks = [sum(own[g] for g in pick) for pick in combinations(range(groups), 3)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of distinct ``fps.fp`` within ``max_bits`` bits; each pair once.

    A pair that meets in several cells is kept in the first of them. The join is a shuffled one: Spark
    takes the size of the cells from that of the fingerprints and does not see that each gets a row a mask,
    so it would send a table of many times its limit through the driver.
    """
    masks = group_masks(max_bits)
    held = F.array(*[F.lit(m).cast("bigint") for m in masks])
    cells = (
        fps.select("fp", segment_counts(F.col("fp")).alias("v"))
        .select("fp", "v", F.posexplode(held).alias("g", "mask"))
        .select("fp", "v", "g", F.col("v").bitwiseAND(F.col("mask")).alias("cell"))
    )
    left = cells.select("g", "cell", F.col("fp").alias("a"), F.col("v").alias("va"))
    right = cells.select("g", "cell", F.col("fp").alias("b"), F.col("v").alias("vb"))
    near = (F.col("a") < F.col("b")) & (manhattan(F.col("va"), F.col("vb")) <= max_bits)
    near = near & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    first = F.lit(len(masks))
    for g in range(len(masks) - 1, -1, -1):
        same = (F.col("va").bitwiseXOR(F.col("vb"))).bitwiseAND(F.lit(masks[g]).cast("bigint")) == 0
        first = F.when(same, F.lit(g)).otherwise(first)
    return left.join(right.hint("merge"), ["g", "cell"]).where(near).where(F.col("g") == first).select("a", "b")


def _classes(docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with fingerprints, classes of equal ones, and the components that links make of these."""
    rows = stored(fingerprints(docs, words), "simhash")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    pairs = stored(links(classes.select("fp"), max_bits), "simhash-links")
    return rows, classes, components(pairs)


def simhash_components(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    Rows of one fingerprint form a class; links join classes, and ``component_id`` is the smallest
    doc_id in all classes that links reach. Rows with a null doc_id count as copies but never give
    the name; a component of such rows only has a null name. Repeated rows all come back, an empty
    table gives an empty one, further columns of ``docs`` are not looked at.
    """
    rows, classes, found = _classes(docs, words, max_bits)
    # Classes without links are components of their own.
    linked = found.join(classes.withColumnRenamed("fp", "node"), "node")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    alone = classes.join(found.select(F.col("node").alias("fp")), "fp", "left_anti")
    named = named.union(alone.select("fp", F.col("first").alias("component_id")))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, all columns kept: that with the smallest doc_id.

    A null id comes after all others, equal ids with different texts are told apart by the texts'
    digests, and of rows that agree in both one stays.
    """
    rows, _, found = _classes(docs, words, max_bits)
    each = rows.groupBy("fp", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    each = each.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key", "n")
    first = each.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(order).alias("first"))
    first = stored(first.select("first.*"), "simhash-first")
    own = fresh("key", docs.columns)
    mine = docs.withColumn(own, content_key())

    def of(firsts: DataFrame) -> DataFrame:
        same = mine["doc_id"].cast("bigint").eqNullSafe(firsts["doc_id"]) & (mine[own] == firsts["key"])
        return mine.join(firsts, same, "left_semi")

    repeated = of(first.where("n > 1")).dropDuplicates(["doc_id", own])
    return of(first.where("n = 1")).union(repeated).drop(own)
