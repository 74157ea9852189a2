"""Connected components of a graph given by its edges, as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm.common import stored

#: Rounds of min-hooking double the reach of a label, so this many would do for 2**60 nodes in line.
MOST_ROUNDS = 200


def _towards_least(edges: DataFrame, up: bool) -> DataFrame:
    """One star step: each node's larger (``up``) or smaller neighbours hang on its least one.

    Nothing is gathered by node: the least neighbour is a partial aggregate, and a join, whose
    large side adaptive execution can split, brings it to the edges. An edge is ``(b, a)``, ``b > a``.
    """
    if up:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).union(
            edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        )
    else:
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(least, "u")
    if up:
        out = joined.where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        out = joined.select(F.col("v").alias("b"), F.col("m").alias("a")).union(
            least.select(F.col("u").alias("b"), F.col("m").alias("a"))
        )
    return out.where("a < b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes in ``pairs``; ``root`` is the least node of the component.

    ``pairs`` are ``(a, b)`` of ``bigint`` nodes, in any order. Rounds of star
    contraction (each edge is drawn to the least node seen) until no edge changes; every round is
    written to the shared folder, so lineage stays short and lost executors cost nothing. Only
    two sums of a round come to the driver.
    """
    edges = pairs.where("a <> b").select(
        F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")
    )
    edges = stored(edges.distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        # The digest of the edge set tells whether a round changed anything.
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stored(_towards_least(_towards_least(edges, True), False), "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(roots)
