"""Rules as a table, matched by counting: thousands of rules in one plan that does not grow with them.

Each rule is cut into atoms, conditions on one field, with all negations moved into the atoms. Equalities
are found by a hash join on the value. Ranges are found by buckets: the borders of a field's ranges
cut its values into runs, a range is a few aligned blocks of whole runs and at most two border runs, whose
values are compared; so a value meets a range in one row at most. A rule is looked at where one of its access
atoms is met, those of which every hit has one, equalities where there are some: records and rules of one
access atom are joined in blocks, and of each pair the met atoms are counted up the rule's tree.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from runweave.operators.rules import PLAIN
from runweave.session import reliable_checkpoint

#: Borders of one field that cut it into runs, about; of more borders a share by hash is taken.
RUNS = 1024
#: A block of level ``i`` has ``FAN ** i`` runs.
FAN, LEVELS = 8, 4
#: Bytes of the index that may be sent to all executors; a larger one is joined by a shuffle.
SMALL_BYTES = 32 << 20
#: Records of a block, at most; fewer where all atoms number more than this for each of ``BLOCK`` records.
BLOCK, BLOCK_ATOMS = 256, 1 << 15
#: Leaves of the rules of a block, about, and rows of an Arrow batch of hits.
BLOCK_LEAVES, ROWS_OUT = 4096, 1 << 16
_EQUAL, _BORDER = -2, -1

_NEGATED = {"==": "!=", "!=": "==", "<": ">=", ">=": "<", ">": "<=", "<=": ">", "and": "or", "or": "and"}
_SWAPPED = {"==": "==", "!=": "!=", "<": ">", ">": "<", "<=": ">=", ">=": "<="}

_PIECE = pa.struct(
    [
        ("x_lo", pa.float64()),
        ("x_hi", pa.float64()),
        ("s_lo", pa.string()),
        ("s_hi", pa.string()),
        ("lo_in", pa.bool_()),
        ("hi_in", pa.bool_()),
    ]
)
_LEAF = pa.struct(
    [
        ("path", pa.list_(pa.int32())),
        ("needs", pa.list_(pa.int32())),
        ("kind", pa.string()),
        ("name", pa.string()),
        ("pieces", pa.list_(_PIECE)),
        ("op", pa.string()),
        ("other", pa.string()),
        ("access", pa.bool_()),
    ]
)
_PIECE_DDL = "struct<x_lo:double,x_hi:double,s_lo:string,s_hi:string,lo_in:boolean,hi_in:boolean>"
_LEAVES_DDL = (
    f"array<struct<path:array<int>,needs:array<int>,kind:string,name:string,pieces:array<{_PIECE_DDL}>,"
    "op:string,other:string,access:boolean>>"
)


def _var(node: Any) -> str | None:
    if isinstance(node, dict):
        if set(node) != {"var"} or not isinstance(node["var"], str):
            raise ValueError(f"operand must be a literal or a var, got {node!r}")
        return node["var"]
    return None


def _kind(name: str, literal: Any) -> str:
    """``t`` for texts, ``n`` for numbers; what a literal is decides, for plain columns their type."""
    if isinstance(literal, bool) or not isinstance(literal, (int, float, str)):
        raise ValueError(f"invalid literal {literal!r}")
    text = isinstance(literal, str)
    if name in PLAIN and not text:
        raise ValueError(f"{name} is not compared with a number")
    return "ts" if name == "ts" else "t" if text else "n"


def _range(kind: str, lo: Any = None, hi: Any = None, lo_in: bool = False, hi_in: bool = False) -> dict:
    """From ``lo`` to ``hi``; null is open. Numbers are compared as float32, in which they are stored."""
    out = {"x_lo": None, "x_hi": None, "s_lo": None, "s_hi": None, "lo_in": lo_in, "hi_in": hi_in}
    for end, value in (("lo", lo), ("hi", hi)):
        if value is not None:
            # Zero has one sign, or else its two texts would be two values of the index.
            out[f"x_{end}" if kind == "n" else f"s_{end}"] = float(np.float32(value)) + 0.0 if kind == "n" else value
    return out


def _pieces(op: str, kind: str, value: Any) -> list[dict]:
    below, above = _range(kind, hi=value), _range(kind, lo=value)
    point = _range(kind, value, value, True, True)
    return {
        "==": [point],
        "!=": [below, above],
        "<": [below],
        "<=": [below | {"hi_in": True}],
        ">": [above],
        ">=": [above | {"lo_in": True}],
    }[op]


def _atom(op: str, left: Any, right: Any) -> dict:
    a, b = _var(left), _var(right)
    if a is None and b is None:
        raise ValueError("a rule compares two literals")
    if a is None:
        return _atom(_SWAPPED[op], right, left)
    if b is None:
        kind = _kind(a, right)
        return {"kind": kind, "name": a, "pieces": _pieces(op, kind, right), "op": None, "other": None}
    sorts = {"ts" if v == "ts" else "t" if v in PLAIN else "n" for v in (a, b)}
    if len(sorts) > 1:
        raise ValueError(f"{a} and {b} have different types")
    return {"kind": sorts.pop(), "name": a, "pieces": [], "op": op, "other": b}


def _flat(op: str, parts: list) -> tuple:
    """A node; parts of its own sort become its own."""
    out = []
    for part in parts:
        out.extend(part[1] if part[0] == op else [part])
    return out[0] if len(out) == 1 else (op, out)


def _tree(logic: Any, negated: bool) -> tuple:
    """``("and" | "or", parts)`` or ``("atom", atom)``, without negations."""
    if not isinstance(logic, dict) or len(logic) != 1:
        raise ValueError(f"a rule is a one-key object, got {logic!r}")
    ((op, args),) = logic.items()
    if op == "!":
        return _tree(args[0] if isinstance(args, list) else args, not negated)
    if op in ("and", "or"):
        if not isinstance(args, list) or not args:
            raise ValueError(f"{op!r} needs at least one part")
        return _flat(_NEGATED[op] if negated else op, [_tree(a, negated) for a in args])
    if op in _SWAPPED:
        if not isinstance(args, list) or len(args) != 2:
            raise ValueError(f"{op!r} compares two operands")
        return ("atom", _atom(_NEGATED[op] if negated else op, *args))
    if op == "in":
        if not isinstance(args, list) or len(args) != 2 or not isinstance(args[1], list) or not args[1]:
            raise ValueError("'in' needs a list of literals")
        return _listed(*args, negated)
    raise ValueError(f"unknown operator {op!r}")


def _listed(item: Any, options: list, negated: bool) -> tuple:
    """``in``: a value of a list, or, negated, one of the gaps between its values."""
    name = _var(item)
    if name is None or any(isinstance(o, dict) for o in options):
        raise ValueError("'in' looks for a var in a list of literals")
    kinds = {_kind(name, o) for o in options}
    if len(kinds) > 1:
        raise ValueError("'in' mixes numbers and texts")
    kind = kinds.pop()
    if kind == "ts" and negated:
        # Equal instants may be written differently, so their order is known only once they are parsed.
        return _flat("and", [("atom", _atom("!=", item, o)) for o in options])
    points = [_range(kind, o, o, True, True) for o in options]
    end = "x" if kind == "n" else "s"
    if kind == "n":
        found = {p["x_lo"]: p for p in points}
        order = sorted(found, key=lambda x: (x != x, x))
    else:
        found = {p["s_lo"]: p for p in points}
        order = sorted(found, key=lambda s: s.encode("utf-8", "surrogatepass"))
    pieces = [found[v] for v in order]
    if negated:
        bounds = [None, *order, None]
        pieces = [{**_range(kind), f"{end}_lo": lo, f"{end}_hi": hi} for lo, hi in zip(bounds, bounds[1:])]
    return ("atom", {"kind": kind, "name": name, "pieces": pieces, "op": None, "other": None})


def _access(tree: tuple) -> list[dict]:
    """Atoms of which every hit has one: of all parts of an ``or``, of the most selective part of an ``and``."""
    op, held = tree
    if op == "atom":
        return [held]
    parts = [_access(part) for part in held]
    if op == "or":
        return [atom for part in parts for atom in part]
    wide = [sum(not _is_equal(atom) for atom in part) for part in parts]
    return min(zip(wide, map(len, parts), range(len(parts)), parts))[3]


def _is_equal(atom: dict) -> bool:
    return bool(atom["pieces"]) and all(p["lo_in"] and p["hi_in"] for p in atom["pieces"])


def leaves_of(text: str | None) -> list[dict]:
    """The atoms of one rule, each with its path in the rule's tree and how many parts each node on it needs."""
    try:
        tree = _tree(json.loads(text or ""), False)
        if tree[0] == "atom":
            tree = ("and", [tree])
        access = {id(atom) for atom in _access(tree)}
        out: list[dict] = []
        stack = [(tree, [], [])]
        while stack:
            (op, held), path, needs = stack.pop()
            if op == "atom":
                out.append({"path": path, "needs": needs, "access": id(held) in access, **held})
            else:
                need = len(held) if op == "and" else 1
                stack.extend((part, [*path, i], [*needs, need]) for i, part in enumerate(held))
        return out
    except RecursionError:
        raise ValueError("the rule is nested too deeply") from None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaves, problems = [], []
        for text in batch.column("logic").to_pylist():
            try:
                leaves.append(leaves_of(text))
                problems.append(None)
            except ValueError as e:
                leaves.append(None)
                problems.append(str(e)[:500])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(leaves, pa.list_(_LEAF)), pa.array(problems, pa.string())],
            names=[*batch.schema.names, "leaves", "problem"],
        )


def _parsed(rules: DataFrame) -> DataFrame:
    """``(rule_id, logic, leaves, problem)`` of each distinct rule."""
    rows = rules.select(F.col("rule_id").cast("string").alias("rule_id"), F.col("logic").cast("string").alias("logic"))
    ddl = f"rule_id string, logic string, leaves {_LEAVES_DDL}, problem string"
    return rows.distinct().mapInArrow(_parse, ddl)


def rule_problems(rules: DataFrame) -> DataFrame:
    """``(rule_id, logic, problem)`` of the rules that ``match_rules`` cannot read and leaves out."""
    return _parsed(rules).where(F.col("problem").isNotNull()).select("rule_id", "logic", "problem")


def _hinted(df: DataFrame, size: Column) -> DataFrame:
    """A checkpointed table with a broadcast hint if the bytes of its rows add up to little."""
    whole = df.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if whole <= SMALL_BYTES else df


def _run_of(cuts: Column, value: Column) -> Column:
    """How many of the sorted ``cuts`` are not above ``value``, by bisection."""
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def half(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        up = F.get(cuts, mid) <= value
        open_ = at["lo"] < at["hi"]
        return F.struct(
            F.when(open_ & up, mid + 1).otherwise(at["lo"]).alias("lo"),
            F.when(open_ & ~up, mid).otherwise(at["hi"]).alias("hi"),
        )

    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + F.lit(1))).cast("int") + 1)
    return F.aggregate(rounds, start, half, lambda at: at["lo"])


def _blocks(first: Column, last: Column) -> Column:
    """The runs ``first`` to ``last`` as the fewest aligned blocks: an array of ``(level, cell)``."""

    def inside(level: int) -> tuple[Column, Column]:
        z = FAN**level
        return F.ceil(first / F.lit(z)).cast("int"), F.floor((last + 1) / F.lit(z)).cast("int") - 1

    out = []
    for level in range(LEVELS):
        a, b = inside(level)
        cells = F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
        if level + 1 < LEVELS:
            up, down = inside(level + 1)
            cells = F.filter(cells, lambda c: ~F.floor(c / F.lit(FAN)).cast("int").between(up, down))  # noqa: B023
        out.append(F.transform(cells, lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell"))))  # noqa: B023
    return F.concat(*out)


def _index(atoms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``fields`` (kind, name, cuts of either type) and ``entries`` (kind, name, level, cell, point, atom, range)."""
    pieces = atoms.select("atom", "kind", "name", F.explode("pieces").alias("p")).select("atom", "kind", "name", "p.*")
    point = F.coalesce(F.col("x_lo") == F.col("x_hi"), F.lit(False)) | F.coalesce(F.col("s_lo") == F.col("s_hi"), F.lit(False))
    pieces = reliable_checkpoint(pieces.withColumn("equal", point))
    ends = pieces.where("not equal").select(
        "kind", "name", F.explode(F.array(F.struct(F.col("x_lo").alias("x"), F.col("s_lo").alias("s")), F.struct(F.col("x_hi").alias("x"), F.col("s_hi").alias("s")))).alias("e")
    )
    ends = ends.select("kind", "name", "e.*").where("x is not null or s is not null").distinct()
    share = ends.groupBy("kind", "name").agg(F.ceil(F.count(F.lit(1)) / F.lit(RUNS)).alias("share"))
    kept = ends.join(share, ["kind", "name"]).where("pmod(xxhash64(x, s), share) = 0")
    cuts = kept.groupBy("kind", "name").agg(
        F.array_sort(F.collect_list("x")).alias("xs"), F.array_sort(F.collect_list("s")).alias("ss")
    )
    fields = pieces.select("kind", "name").distinct().join(cuts, ["kind", "name"], "left")
    none = F.array().cast("array<string>")
    fields = reliable_checkpoint(
        fields.select("kind", "name", F.coalesce("xs", none.cast("array<double>")).alias("xs"), F.coalesce("ss", none).alias("ss"))
    )

    def run(end: str, otherwise: Column) -> Column:
        x, s = F.col(f"x_{end}"), F.col(f"s_{end}")
        return F.when(x.isNotNull(), _run_of(F.col("xs"), x)).when(s.isNotNull(), _run_of(F.col("ss"), s)).otherwise(otherwise)

    last = F.size("xs") + F.size("ss")
    ranges = pieces.where("not equal").join(fields, ["kind", "name"])
    ranges = ranges.withColumn("a", run("lo", F.lit(-1))).withColumn("b", run("hi", last + 1))
    borders = F.filter(F.array_distinct(F.array("a", "b")), lambda c: (c >= 0) & (c <= last))
    spots = F.concat(
        _blocks(F.col("a") + 1, F.col("b") - 1),
        F.transform(borders, lambda c: F.struct(F.lit(_BORDER).alias("level"), c.alias("cell"))),
    )
    bounds = ["x_lo", "x_hi", "s_lo", "s_hi", "lo_in", "hi_in"]
    spread = ranges.select("kind", "name", F.explode(spots).alias("spot"), "atom", *bounds)
    spread = spread.select("kind", "name", "spot.level", "spot.cell", F.lit("").alias("point"), "atom", *bounds)
    equal = pieces.where("equal").select(
        "kind", "name", F.lit(_EQUAL).alias("level"), F.lit(0).alias("cell"),
        F.coalesce("s_lo", F.col("x_lo").cast("string")).alias("point"), "atom", *bounds,
    )
    border = F.col("level") == _BORDER
    entries = spread.union(equal).groupBy("kind", "name", "level", "cell", "point").agg(
        F.collect_list(F.when(~border, F.col("atom"))).alias("sure"),
        F.collect_list(F.when(border, F.struct("atom", *bounds))).alias("maybe"),
    )
    return fields, reliable_checkpoint(entries)


def _met(records: DataFrame, fields: DataFrame, entries: DataFrame, both: DataFrame | None, only_access: bool) -> DataFrame:
    """The rows of ``records`` with ``atoms``, those met by one value of ``whole``, a row for each value that meets some.

    ``both`` has the atoms that compare two fields. ``only_access``: only the atoms with even numbers.
    """
    carried = [F.col(c) for c in records.columns]
    if only_access:
        entries = entries.withColumn("sure", F.filter("sure", lambda a: a % 2 == 0))
        entries = entries.withColumn("maybe", F.filter("maybe", lambda e: e["atom"] % 2 == 0))
        entries = entries.where((F.size("sure") > 0) | (F.size("maybe") > 0))
    # Only the sorts of probes that a field has entries for are made.
    fields = fields.join(entries.groupBy("kind", "name").agg(F.collect_set("level").alias("levels")), ["kind", "name"])
    strings = F.aggregate("ss", F.lit(0), lambda n, s: n + F.octet_length(s))
    values = records.select(*carried, F.explode("whole").alias("e")).select(*carried, "e.*")
    values = values.join(_hinted(fields, 8 * F.size("xs") + strings + 64), ["kind", "name"])
    at = F.when(F.col("x").isNotNull(), _run_of(F.col("xs"), F.col("x"))).otherwise(_run_of(F.col("ss"), F.col("s")))
    at = F.when(F.array_max("levels") > _EQUAL, at).otherwise(0)
    values = values.select(*carried, "kind", "name", "x", "s", "levels", at.alias("at"))

    def probe(level: int, cell: Column, point: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), cell.cast("int").alias("cell"), point.alias("point"))

    empty = F.lit("")
    probes = [probe(i, F.floor(F.col("at") / F.lit(FAN**i)), empty) for i in range(LEVELS)]
    probes += [probe(_BORDER, F.col("at"), empty), probe(_EQUAL, F.lit(0), F.coalesce("s", F.col("x").cast("string")))]
    wanted = F.filter(F.array(*probes), lambda p: F.array_contains("levels", p["level"]))
    values = values.select(*carried, "kind", "name", "x", "s", F.explode(wanted).alias("p"))
    values = values.select(*carried, "kind", "name", "x", "s", "p.*")
    text = F.aggregate("maybe", F.lit(0), lambda n, e: n + F.coalesce(F.octet_length(e["s_lo"]), F.lit(0)) + F.coalesce(F.octet_length(e["s_hi"]), F.lit(0)) + 80)
    size = F.octet_length("point") + 8 * F.size("sure") + text + 128
    met = values.join(_hinted(entries, size), ["kind", "name", "level", "cell", "point"])

    def holds(entry: Column, end: str, beyond) -> Column:
        x, s, closed = entry[f"x_{end}"], entry[f"s_{end}"], entry[f"{end}_in"]

        def side(value: Column, bound: Column) -> Column:
            return F.coalesce(beyond(value, bound) | (closed & (value == bound)), F.lit(False))

        return (x.isNull() & s.isNull()) | side(F.col("x"), x) | side(F.col("s"), s)

    inside = F.filter("maybe", lambda e: holds(e, "lo", lambda v, b: v > b) & holds(e, "hi", lambda v, b: v < b))
    atoms = F.when(F.col("level") == _BORDER, F.transform(inside, lambda e: e["atom"])).otherwise(F.col("sure"))
    met = met.select(*carried, atoms.alias("atoms")).where(F.size("atoms") > 0)
    if both is None:
        return met
    if only_access:
        both = both.where("atom % 2 = 0")
    pair = records.select(*carried, F.explode("whole").alias("e")).select(*carried, "e.*")
    pair = pair.join(both.select("atom", "kind", "name", "op", "other"), ["kind", "name"])
    # What a rule names by ``other`` has the kind of what it is compared with.
    other = F.get(F.filter("whole", lambda e: (e["kind"] == F.col("kind")) & (e["name"] == F.col("other"))), F.lit(0))
    same = F.when(F.col("kind") == "n", _compared(F.col("op"), F.col("x"), other["x"]))
    same = same.otherwise(_compared(F.col("op"), F.col("s"), other["s"]))
    return met.union(pair.where(same).select(*carried, F.array("atom").alias("atoms")))


def _ways(rules: DataFrame, leaves: DataFrame, numbers: DataFrame, depth: int) -> DataFrame:
    """``(atom, rule_id, logic, leaves, access)``: each rule at each of its access atoms, its leaves in the tree's order."""
    numbered = leaves.select("logic", "what", "path", "needs", "access").join(_hinted(numbers, F.lit(64)), "what")
    trees = numbered.groupBy("logic").agg(
        F.array_sort(F.collect_list(F.struct("path", "atom", "needs"))).alias("leaves"),
        F.array_sort(F.collect_set(F.when(F.col("access"), F.col("atom")))).alias("access"),
    )
    size = F.size("leaves") * (16 + 8 * depth + 48) + 16 * F.size("access") + 96
    trees = reliable_checkpoint(trees)
    whole = rules.join(_hinted(trees, size), "logic")
    return reliable_checkpoint(whole.select(F.explode("access").alias("atom"), "rule_id", "logic", "leaves", "access"))


def _items(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The items of all lists, and the number of the list that each is in."""
    return lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))


def _padded(lists: pa.ListArray, depth: int, fill: int) -> np.ndarray:
    items, row = _items(lists)
    out = np.full((len(lists), depth), fill, np.int32)
    if len(items):
        first = np.concatenate(([True], row[1:] != row[:-1])).nonzero()[0]
        at = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        out[row, at] = items.to_numpy(zero_copy_only=False)
    return out


def _block_hits(way: int, rules: pa.StructArray, records: pa.StructArray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rules and of the records that meet each other, of one block each, at the access atom ``way``.

    What holds is a table of nodes by records. Leaves go up the trees level by level: a node holds where as many
    of its parts hold as it needs. A rule with several access atoms met is left to the first one.
    """
    leaves, rule = _items(rules.field("leaves"))
    atom = leaves.field("atom").to_numpy()
    path, needs = _padded(leaves.field("path"), depth, -1), _padded(leaves.field("needs"), depth, 1)
    access, access_rule = _items(rules.field("access"))
    access = access.to_numpy()
    known, place = np.unique(atom, return_inverse=True)
    has, record = _items(records.field("atoms"))
    has = has.to_numpy()
    spot = np.minimum(np.searchsorted(known, has), len(known) - 1)
    right = known[spot] == has
    table = np.zeros((len(known), len(records)), np.bool_)
    table[spot[right], record[right]] = True
    held = table[place]
    for level in range(depth, 0, -1):
        deep = path[:, level - 1] >= 0
        need = np.where(deep, needs[:, level - 1], 1)
        path[:, level - 1] = -1
        new = (rule[1:] != rule[:-1]) | (path[1:] != path[:-1]).any(axis=1)
        first = np.concatenate(([True], new)).nonzero()[0]
        held = np.add.reduceat(held, first, axis=0, dtype=np.int32) >= np.maximum.reduceat(need, first)[:, None]
        path, needs, rule = path[first], needs[first], rule[first]
    earlier = access < way
    if earlier.any():
        spot, of = np.searchsorted(known, access[earlier]), access_rule[earlier]
        first = np.concatenate(([True], of[1:] != of[:-1])).nonzero()[0]
        held[of[first]] &= ~np.logical_or.reduceat(table[spot], first, axis=0)
    return np.nonzero(held)


def _hits(depth: int):
    """Compare the blocks of each row; a hit is a row for each copy of its record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rules, records = (batch.column(c).slice(i, 1).flatten() for c in ("rules", "records"))
                way = batch.column("atom")[i].as_py()
                rule, record = _block_hits(way, rules, records, depth)
                rule_ids, log_ids = rules.field("rule_id"), records.field("log_id")
                ends = np.cumsum(records.field("copies").to_numpy()[record])
                for start in range(0, int(ends[-1]) if len(ends) else 0, ROWS_OUT):
                    hit = np.searchsorted(ends, np.arange(start, min(start + ROWS_OUT, int(ends[-1]))), side="right")
                    columns = [rule_ids.take(pa.array(rule[hit])), log_ids.take(pa.array(record[hit]))]
                    yield pa.RecordBatch.from_arrays(columns, names=["rule_id", "log_id"])

    return run


def _with_instants(leaves: DataFrame) -> DataFrame:
    """Times written as texts become microseconds, as those of the records."""
    def micros(s: Column) -> Column:
        return F.unix_micros(s.cast("timestamp")).cast("double")

    def piece(p: Column) -> Column:
        return F.struct(
            micros(p["s_lo"]).alias("x_lo"), micros(p["s_hi"]).alias("x_hi"),
            F.lit(None).cast("string").alias("s_lo"), F.lit(None).cast("string").alias("s_hi"),
            p["lo_in"].alias("lo_in"), p["hi_in"].alias("hi_in"),
        )

    timed = F.col("kind") == "ts"
    leaves = leaves.withColumn("pieces", F.when(timed, F.transform("pieces", piece)).otherwise(F.col("pieces")))
    return leaves.withColumn("kind", F.when(timed, "n").otherwise(F.col("kind")))


def _compared(op: Column, a: Column, b: Column) -> Column:
    return (
        F.when(op == "==", a == b).when(op == "!=", a != b).when(op == "<", a < b)
        .when(op == "<=", a <= b).when(op == ">", a > b).otherwise(a >= b)
    )


def match_rules(logs: DataFrame, rules: DataFrame) -> DataFrame:
    """``(rule_id, log_id)``: the rules of ``(rule_id, logic)``, JSON texts, that each record of ``logs`` meets.

    A rule is what ``rule_column`` reads, and hits the same records: a missing or null field makes a
    comparison null, which is no hit, negated or not. The plan depends on how deep rules are nested, never on
    their number. Equal rules with one id count once; two rules with one id count each for itself; equal
    records give a row each. What cannot be read, and comparisons of two literals or of different types,
    is left out and listed by ``rule_problems``. Either table may be empty; other columns are not looked at.
    """
    rows = rules.select(F.col("rule_id").cast("string").alias("rule_id"), F.col("logic").cast("string").alias("logic"))
    logic = F.unhex(F.md5(F.col("logic").cast("binary"))).alias("logic")
    # Rules of one text are read once.
    leaves = _parsed(rows.select(F.lit("").alias("rule_id"), "logic")).select(logic, F.explode("leaves").alias("leaf"))
    leaves = _with_instants(leaves.select("logic", "leaf.*"))
    what = F.to_json(F.struct("kind", "name", "pieces", "op", "other"))
    leaves = reliable_checkpoint(leaves.withColumn("what", F.unhex(F.md5(what.cast("binary")))))
    depth = leaves.agg(F.max(F.size("path"))).first()[0]
    if depth is None:
        return logs.select(F.lit(None).cast("string").alias("rule_id"), "log_id").limit(0)
    # Atoms are numbered, and even numbers are those of access atoms of some rule.
    atoms = leaves.select("what", "kind", "name", "pieces", "op", "other").dropDuplicates(["what"])
    atoms = atoms.join(leaves.groupBy("what").agg(F.max("access").alias("access")), "what")
    number = 2 * F.monotonically_increasing_id() + F.when(F.col("access"), 0).otherwise(1)
    atoms = reliable_checkpoint(atoms.select(number.alias("atom"), "*"))
    both = atoms.where("op is not null")
    has_both = bool(both.limit(1).count())

    ways = _ways(rows.distinct().select("rule_id", logic), leaves, atoms.select("what", "atom"), depth)
    entry_list = _index(atoms.where("op is null"))

    def met(records: DataFrame, only_access: bool) -> DataFrame:
        return _met(records, *entry_list, both if has_both else None, only_access)

    def entry(kind: str, name: Column, x: Column | None, s: Column | None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), name.alias("name"),
            (F.lit(None).cast("double") if x is None else x).alias("x"), (F.lit(None).cast("string") if s is None else s).alias("s"),
        )

    def listed(name: str, make) -> Column:
        own = F.filter(F.map_entries(name), lambda e: e["value"].isNotNull() & ~e["key"].isin(*PLAIN))
        return F.coalesce(F.transform(own, make), F.array().cast("array<struct<kind:string,name:string,x:double,s:string>>"))

    # Zero has one sign here too.
    instants = F.unix_micros(F.col("ts").cast("timestamp")).cast("double")
    plain = [entry("t", F.lit(name), None, F.col(name).cast("string")) for name in PLAIN if name != "ts"]
    plain = F.filter(F.array(*plain, entry("n", F.lit("ts"), instants, None)), lambda e: e["x"].isNotNull() | e["s"].isNotNull())
    numbers = listed("number", lambda e: entry("n", e["key"], e["value"].cast("double") + F.lit(0.0), None))
    texts = listed("text", lambda e: entry("t", e["key"], None, e["value"]))
    records = logs.select("log_id", F.concat(numbers, texts, plain).alias("whole"))

    # Records that meet no access atom are left here; equal ones become one. A record meets an atom once at most.
    by = ["log_id", "key"]
    found = met(records, True).withColumn("key", F.unhex(F.md5(F.to_json("whole").cast("binary")))).groupBy(*by)
    found = found.agg(F.flatten(F.collect_list("atoms")).alias("ways"), F.first("whole").alias("whole"))
    distinct = F.array_distinct("ways")
    copies = F.call_function("div", F.size("ways"), F.size(distinct)).alias("copies")
    found = reliable_checkpoint(found.select(*by, distinct.alias("ways"), copies, "whole"))
    many = found.select(F.explode("ways").alias("atom")).groupBy("atom").agg(F.count(F.lit(1)).alias("n"))
    found = met(found, False).groupBy(*by).agg(
        F.flatten(F.collect_list("atoms")).alias("atoms"), F.first("ways").alias("ways"), F.first("copies").alias("copies")
    )

    # Records and rules of an access atom, in blocks; a task compares a block with a block.
    many = reliable_checkpoint(many)
    most = max(16, min(BLOCK, BLOCK * BLOCK_ATOMS // max(1, atoms.count())))
    own = found.select("log_id", "key", "copies", "atoms", F.explode("ways").alias("atom")).join(_hinted(many, F.lit(64)), "atom")
    block = F.pmod(F.xxhash64("log_id", "key"), F.ceil(F.col("n") / F.lit(most)))
    own = own.withColumn("block", block).groupBy("atom", "block").agg(F.collect_list(F.struct("log_id", "copies", "atoms")).alias("records"))
    weights = reliable_checkpoint(ways.groupBy("atom").agg(F.sum(F.size("leaves")).alias("n")))
    rule_bytes = F.size("leaves") * (16 + 8 * depth + 48) + 16 * F.size("access") + F.coalesce(F.octet_length("rule_id"), F.lit(0)) + 96
    few = (ways.agg(F.sum(rule_bytes.cast("bigint"))).first()[0] or 0) <= SMALL_BYTES
    block = F.pmod(F.xxhash64("rule_id", "logic"), F.ceil(F.col("n") / F.lit(BLOCK_LEAVES)))
    held = ways.join(_hinted(weights, F.lit(64)), "atom").withColumn("block", block).groupBy("atom", "block")
    held = held.agg(F.collect_list(F.struct("rule_id", "leaves", "access")).alias("rules")).drop("block")
    pairs = own.drop("block").join(F.broadcast(held) if few else held, "atom")
    log_id = logs.select("log_id").schema["log_id"]
    return pairs.mapInArrow(_hits(depth), StructType([StructField("rule_id", StringType()), log_id]))
