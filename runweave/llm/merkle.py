"""A Merkle manifest of a dataset: a digest for every row, group and the whole, and a proof for every row.

Rows become leaves; the leaves of a group, in order, become a tree of fixed fanout, and so do the groups'
roots. A level is a slot pivot: conditional aggregates spread the children of a parent into ``FANOUT``
columns. All columns concatenated make the parent's digest; all but a child's own make its siblings.
Positions come from one range partitioning, so a group of any size is spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runweave.llm.common import small, stored

FANOUT = 16
#: ``monotonically_increasing_id`` has the partition above this bit and the row's place in it below.
PLACE_BITS = 33


def field(value: Column) -> Column:
    """One value inside a leaf: ``-`` for null, else its bytes' number, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: lowercase hex SHA-256 of its values' fields, one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def fold(path: Column, digest: Column) -> Column:
    """The root that ``digest`` leads to by the siblings in ``path``."""
    return F.aggregate(path, digest, lambda at, x: F.sha2(F.concat(x["before"], at, x["after"]), 256))


def proof(path: Column) -> Column:
    """Digest of all siblings in ``path``, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def _ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (stored) with ``idx``, the position inside ``key``, and ``n``, the rows of ``key``.

    One range partitioning by (key, order), which rows that are all alike may be cut by as well; a row of
    counts for each key and partition that meet, partitions and keys in number at most, gives the offsets.
    """
    by = ["key", *order, "tie"]
    sorted_ = (
        nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    )
    placed = stored(sorted_.drop("tie").withColumn("place", F.monotonically_increasing_id()), "merkle-places")
    part = F.shiftright("place", PLACE_BITS)
    runs = placed.groupBy("key", part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")
    )
    inside = Window.partitionBy("key")
    before = F.sum("rows").over(inside.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        "key", "part", (F.col("first") - F.coalesce(before, F.lit(0))).alias("zero"), F.sum("rows").over(inside).alias("n")
    )
    runs = small(stored(runs, "merkle-runs"))
    return (
        placed.withColumn("part", part)
        .join(runs, ["key", "part"])
        .withColumn("idx", F.col("place") - F.col("zero"))
        .drop("place", "zero", "part")
    )


def _levels(nodes: DataFrame, payload: Sequence[str]) -> list[DataFrame]:
    """Parents of ``nodes`` (key, idx, n, payload with ``digest``), their parents, and so on.

    A parent has ``key``, ``idx``, ``n`` (nodes of its level in the key), its children in ``c0`` to
    ``c15`` and its ``digest``. Keys with a single node have no parents. Each level is stored.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    out: list[DataFrame] = []
    while most > 1:
        child = F.struct(*payload)
        slots = [F.max(F.when(F.col("idx") % FANOUT == i, child)).alias(f"c{i}") for i in range(FANOUT)]
        up = (
            nodes.where("n > 1")
            .groupBy("key", F.floor(F.col("idx") / FANOUT).alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"))
            .agg(*slots)
        )
        whole = F.concat(*[F.coalesce(F.col(f"c{i}.digest"), F.lit("")) for i in range(FANOUT)])
        up = stored(up.withColumn("digest", F.sha2(whole, 256)), "merkle-level")
        out.append(up)
        nodes, payload, most = up, ["digest"], -(-most // FANOUT)
    return out


def _children(parents: DataFrame, above: DataFrame) -> DataFrame:
    """The children of ``parents``, with what ``above`` has for these and a longer ``path``.

    ``above`` has ``key``, ``idx``, ``path`` and columns that are carried down.
    """
    slots = [F.coalesce(F.col(f"c{i}.digest"), F.lit("")) for i in range(FANOUT)]
    nothing = F.lit("")
    each = F.array(
        *[
            F.struct(
                F.lit(i).alias("slot"),
                F.col(f"c{i}").alias("child"),
                F.concat(nothing, *slots[:i]).alias("before"),
                F.concat(nothing, *slots[i + 1 :]).alias("after"),
            )
            for i in range(FANOUT)
        ]
    )
    met = parents.drop("n", "digest").join(above, ["key", "idx"])
    carried = [c for c in above.columns if c not in ("idx", "path")]
    one = F.col("one")
    return met.select(
        *carried, "idx", "path", F.explode(F.filter(each, lambda x: x["child"].isNotNull())).alias("one")
    ).select(
        *carried,
        (F.col("idx") * FANOUT + one["slot"]).alias("idx"),
        F.concat(F.array(F.struct(one["before"].alias("before"), one["after"].alias("after"))), "path").alias("path"),
        one["child"].alias("child"),
    )


def proofs(rows: DataFrame) -> DataFrame:
    """``(row, leaf, subroot, root, path)`` for each row of ``rows`` (group string, position, leaf, row).

    ``group`` may be null, which makes a group that comes first; others come bytewise. Inside a group, rows
    ascend by ``position`` (null first), then by ``leaf``; rows alike in both take places of their own.
    ``row`` is carried along: anything that can be ordered, such as an id and the digest of a changed
    version. ``path`` has the siblings on either side (``before`` and ``after``), level by level from the
    leaf to the root. The tree of a single leaf is that leaf. An empty table gives an empty one.
    """
    key = F.concat(F.when(F.col("group").isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce("group", F.lit("")))
    rows = stored(rows.select(key.alias("key"), "position", F.col("leaf").alias("digest"), "row"), "merkle-leaves")
    leaves = _ranked(rows, ["position", "digest"]).select("key", "idx", "n", "digest", "row")
    leaves = stored(leaves, "merkle-ranked")  # read by the first level, and for lone leaves
    levels = _levels(leaves, ["digest", "row"])
    lone = leaves.where("n = 1").select("key", "digest", F.lit(0).alias("height"))
    for height, level in enumerate(levels, 1):
        lone = lone.union(level.where("n = 1").select("key", "digest", F.lit(height).alias("height")))
    groups = stored(lone.select(F.lit("").alias("key"), F.col("key").alias("group"), "digest", "height"), "merkle-groups")
    groups = stored(_ranked(groups, ["group"]), "merkle-ranked-groups")
    top = _levels(groups, ["digest", "group", "height"])
    # From the root down to the groups.
    empty = F.expr("cast(array() as array<struct<before: string, after: string>>)")
    if top:
        above = top[-1].select("key", "idx", empty.alias("path"), F.col("digest").alias("root"))
        for level in reversed(top[1:]):
            above = _children(level, above).drop("child")
        found = _children(top[0], above)
        group = found.select("child.group", "child.digest", "child.height", "path", "root")
    else:
        group = groups.select("group", "digest", "height", empty.alias("path"), F.col("digest").alias("root"))
    group = stored(
        group.select(F.col("group").alias("key"), F.lit(0).cast("bigint").alias("idx"), "path", F.col("digest").alias("subroot"), "root", "height"),
        "merkle-roots",
    )
    # From the groups down to the leaves.
    columns = ["key", "idx", "path", "subroot", "root"]
    above = None
    for height in range(len(levels), 0, -1):
        own = group.where(F.col("height") == height).select(*columns)
        above = own if above is None else own.union(_children(levels[height], above).select(*columns))
    result = ["row", "leaf", "subroot", "root", "path"]
    single = leaves.where("n = 1").join(group.where("height = 0"), "key")
    out = single.select("row", F.col("digest").alias("leaf"), "subroot", "root", "path")
    if above is not None:
        below = _children(levels[0], above)
        out = out.union(
            below.select(F.col("child.row").alias("row"), F.col("child.digest").alias("leaf"), "subroot", "root", "path")
        )
    return out.select(*result)


def ascii_lower(text: Column) -> Column:
    """``text`` with A to Z in lower case and all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def manifest(docs: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of each row of ``docs``.

    The leaf covers doc_id, source, lang, n_chars and text; other columns are not looked at. Where
    ``tampered`` is true, ``folded_root`` starts from the leaf with the text ``changed``; null counts as
    false. A null source is a group of its own, a null id comes first in its group. Rows with one id, even
    rows all alike, are leaves of their own. Empty texts differ from null ones. An empty table gives an
    empty one.
    """
    docs = docs.select("doc_id", "source", "lang", "n_chars", "text", tampered.alias("t"), changed.alias("c"))
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    own = leaf([*head, F.col("text")])
    other = F.when(F.col("t"), leaf([*head, F.col("c")]))
    rows = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("position"),
        own.alias("leaf"),
        F.struct(F.col("doc_id").alias("doc_id"), other.alias("other")).alias("row"),
    )
    found = proofs(rows)
    folded = fold(F.col("path"), F.coalesce("row.other", "leaf"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth(doc_id: str = "doc_id") -> Column:
    """Rows whose id as text has a crc32 that 5 divides."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _oracle(levels: int = 6, top: int = 4) -> str:
    """DuckDB SQL for ``op11_merkle``, for up to ``16 ** levels`` rows a source and ``16 ** top`` sources."""

    def text(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"

    def rise(name: str, count: int) -> str:
        out = []
        for k in range(count):
            out.append(f"""{name}{k + 1} AS (SELECT g, idx // 16 AS idx, (n + 15) // 16 AS n,
              CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY idx)) END AS d
              FROM {name}{k} GROUP BY g, idx // 16, n)""")
            out.append(f"""{name}s{k} AS (SELECT g, idx, n, coalesce(string_agg(d, '') OVER (PARTITION BY g, idx // 16
              ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, coalesce(string_agg(d, '') OVER
              (PARTITION BY g, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})""")
        return ",\n".join(out)

    def folded(name: str, count: int, start: str) -> str:
        for k in range(count):
            s = f"{name}s{k}"
            start = f"CASE WHEN {s}.n = 1 THEN {start} ELSE sha256({s}.b || {start} || {s}.a) END"
        return start

    head = " || ".join(text(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bit = "CASE WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), range(8)), lambda h, k: {bit})"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295)"
    mid = " JOIN ".join(["l0"] + [f"ls{k} ON ls{k}.g = l0.g AND ls{k}.idx = l0.idx // {16**k}" for k in range(levels)])
    up = " JOIN ".join(["t0"] + [f"ts{k} ON ts{k}.g = t0.g AND ts{k}.idx = t0.idx // {16**k}" for k in range(top)])
    sib = " || ".join([f"ls{k}.b || ls{k}.a" for k in range(levels)])
    sib_top = " || ".join([f"ts{k}.b || ts{k}.a" for k in range(top)])
    steps = ["mid.f"]
    for k in range(top):
        steps.append(f"CASE WHEN h.n{k} = 1 THEN {steps[-1]} ELSE sha256(h.b{k} || {steps[-1]} || h.a{k}) END")
    carried = ", ".join(f"ts{k}.n AS n{k}, ts{k}.b AS b{k}, ts{k}.a AS a{k}" for k in range(top))
    return f"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g,
    sha256({head} || {text("text")}) AS d,
    CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {text(lower)}) ELSE sha256({head} || {text("text")}) END AS other
  FROM documents),
l0 AS (SELECT doc_id, g, d, other, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n FROM d),
{rise("l", levels)},
t0 AS (SELECT '' AS g, g AS source, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n, d FROM l{levels}),
{rise("t", top)},
h AS (SELECT t0.source AS g, t0.d AS subroot, {sib_top} AS s, {carried} FROM {up}),
mid AS (SELECT l0.doc_id, l0.g, l0.d AS leaf, {sib} AS s, {folded("l", levels, "l0.other")} AS f FROM {mid})
SELECT mid.doc_id, mid.leaf, h.subroot, t{top}.d AS root, sha256(mid.s || h.s) AS proof_sha256,
  {steps[-1]} AS folded_root, folded_root = root AS verified
FROM mid JOIN h ON h.g = mid.g JOIN t{top} ON true
"""


ORACLE_SQL = _oracle()
