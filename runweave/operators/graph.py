"""Operator graphs: nodes with their edges, named trees, argument contracts, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.operators.ordered import spread_join
from runweave.session import reliable_checkpoint

# --- fixed values: patterns -------------------------------------------------------
SELF_PREFIX = r"^self\."
PRERELEASE = r"(?i)(a|b|c|rc|alpha|beta|pre|preview|dev)[-_.]?\d*"
# -----------------------------------------------------------------------------------


def node_source_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per node and edge that targets it (``edge_id`` null when none does).

    Long form on purpose: a node may be the target of any number of edges, and an array of them
    would have to fit into one row.
    """
    named = nodes.withColumn("name", F.regexp_replace("name", SELF_PREFIX, ""))
    targeted = edges.select(F.col("id").alias("edge_id"), F.col("target").alias("id"))
    hits = spread_join(targeted, named, ["id"], ["edge_id"], "inner")
    lonely = named.join(targeted.select("id").distinct(), "id", "left_anti")
    return hits.unionByName(lonely.withColumn("edge_id", F.lit(None).cast("string")))


def tree_paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Dotted path of every node below the roots, each node once, at its first visit in
    pre-order.

    ``edges``: parent, ord, name, child; ``roots``: node. The root's path is empty. ``ordinals`` sorts the
    nodes in pre-order. A forest, where no node has two parents, is opened by pointer doubling: as many
    rounds as the depth has binary digits. Other graphs go level by level, as the first of several
    paths to a node, and where a path would close a cycle, is known only once it is walked.
    """
    inner = edges.where(F.col("child").isNotNull() & F.col("parent").isNotNull())
    entered = inner.join(roots.select(F.col("node").alias("child")), "child", "left_semi")
    twice = inner.groupBy("child").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = roots.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if twice.isEmpty() and repeated.isEmpty() and entered.isEmpty():
        return _forest_paths(inner, roots)
    return _graph_paths(edges, roots)


def _forest_paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Paths where every node has one parent at most and no root has any.

    A row holds the names on the way to a node from its ancestor ``up``, up to 2^k levels above. A round joins
    it to the row of that ancestor, which doubles the way; a row whose ancestor has no parent stays as it
    is. Rounds end when no row has moved, or when the way is longer than there are rows: then those
    that move run in circles. What does not end at a root is left out.
    """
    known = reliable_checkpoint(
        edges.select(
            F.col("child").alias("node"),
            F.col("parent").alias("up"),
            F.array("name").alias("names"),
            F.array(F.col("ord").cast("bigint")).alias("ordinals"),
            F.lit(True).alias("moved"),
        )
    )
    rows, reach = known.count(), 1
    while reach <= rows:
        above = known.select(
            F.col("node").alias("up"),
            F.col("up").alias("higher"),
            F.col("names").alias("before"),
            F.col("ordinals").alias("first"),
        )
        moved = F.col("higher").isNotNull()
        known = reliable_checkpoint(
            known.drop("moved")
            .join(above, "up", "left")
            .select(
                "node",
                F.coalesce("higher", "up").alias("up"),
                F.when(moved, F.concat("before", "names")).otherwise(F.col("names")).alias("names"),
                F.when(moved, F.concat("first", "ordinals")).otherwise(F.col("ordinals")).alias("ordinals"),
                moved.alias("moved"),
            )
        )
        reach *= 2
        if known.where("moved").isEmpty():
            break
    path = F.aggregate(
        "names", F.lit(""), lambda at, name: F.when(at == "", name).otherwise(F.concat_ws(".", at, name))
    )
    below = known.join(roots.select(F.col("node").alias("up")), "up", "left_semi")
    start = roots.select("node", F.lit("").alias("path"), F.array().cast("array<bigint>").alias("ordinals"))
    return start.unionByName(below.select("node", path.alias("path"), "ordinals"))


def _graph_paths(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Paths in any graph, level by level.

    The nodes of a level meet the edges by key, and a level is written to the shared folder before the
    next, so plans stay short. The first visit is the path with the smallest ordinals. There is no limit
    of depth: a node is never visited below itself, so the levels come to an end.
    """
    level = roots.select(
        "node",
        F.lit("").alias("path"),
        F.array().cast("array<bigint>").alias("ordinals"),
        F.array("node").alias("trail"),
    )
    found = [level]
    while True:
        below = (
            edges.join(level.withColumnRenamed("node", "parent"), "parent")
            .where(~F.array_contains("trail", F.col("child")))
            .select(
                F.col("child").alias("node"),
                F.when(F.col("path") == "", F.col("name"))
                .otherwise(F.concat_ws(".", "path", "name"))
                .alias("path"),
                F.concat("ordinals", F.array(F.col("ord").cast("bigint"))).alias("ordinals"),
                F.concat("trail", F.array("child")).alias("trail"),
            )
        )
        level = reliable_checkpoint(_first_visit(below))
        if level.isEmpty():
            break
        found.append(level)
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return _first_visit(every).drop("trail")


def _first_visit(paths: DataFrame) -> DataFrame:
    return (
        paths.groupBy("node")
        .agg(F.min_by(F.struct("path", "ordinals", "trail"), F.struct("ordinals", "path")).alias("p"))
        .select("node", "p.*")
    )


def arg_contract(
    runs: DataFrame, args: str = "args", defaults: str = "defaults", passed: str = "passed",
    var_kwargs: str = "var_kwargs",
) -> DataFrame:
    """Names each run must pass but did not (``missing``), and passed but may not (``extra``)."""
    required = F.array_except(args, defaults)
    extra = F.array_sort(F.array_except(passed, args))
    return (
        runs.withColumn("missing", F.array_sort(F.array_except(required, passed)))
        .withColumn("extra", F.when(F.col(var_kwargs), F.array().cast("array<string>")).otherwise(extra))
        .withColumn("ok", (F.size("missing") == 0) & (F.size("extra") == 0))
    )


def version_numbers(version: str | Column) -> Column:
    """Release part of a version as whole numbers, trailing zeros aside (1.0 equals 1)."""
    version = F.col(version) if isinstance(version, str) else version
    release = F.regexp_extract(version, r"^v?(?:\d+!)?(\d+(?:\.\d+)*)", 1)
    release = F.regexp_replace(release, r"(\.0+)+\z", "")
    return F.transform(F.split(release, r"\."), lambda n: n.try_cast("bigint"))


def latest_stable_version(versions: DataFrame) -> DataFrame:
    """Newest version of each package that is no prerelease; ``0`` when there is none."""
    stable = ~F.col("version").rlike(r"^[^+]*?" + PRERELEASE)
    epoch = F.regexp_extract("version", r"^v?(\d+)!", 1).try_cast("int")
    post = F.regexp_extract("version", r"(?i)(?:post|rev|r)[-_.]?(\d+)", 1).try_cast("int")
    order = F.when(
        stable,
        F.struct(
            F.coalesce(epoch, F.lit(0)),
            version_numbers("version"),
            F.coalesce(post, F.lit(-1)),
            F.col("version"),
        ),
    )
    return versions.groupBy("package").agg(
        F.coalesce(F.max_by("version", order), F.lit("0")).alias("latest")
    )
