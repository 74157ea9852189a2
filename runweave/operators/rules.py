"""Rules: a small JSON-logic subset compiled to columns over log records."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.operators.paging import page_no

COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}
PLAIN = ("project_id", "tracker_id", "log_id", "ts")


def active_rules(rules: DataFrame, project_id: str | None = None) -> DataFrame:
    """Rules in force, of one project or of all."""
    out = rules.where(~F.col("is_deactivated"))
    return out if project_id is None else out.where(F.col("project_id") == project_id)


def list_rules(
    rules: DataFrame, project_id: str | None = None, page: int = 0, page_size: int = 0
) -> DataFrame:
    """All rules, deactivated ones too, of one project or of all; a page in the order of names."""
    out = rules if project_id is None else rules.where(F.col("project_id") == project_id)
    return page_no(out, ["rule_name", "id"], page, page_size) if page_size else out


def _operand(node: Any, numeric: bool) -> Column:
    if isinstance(node, dict):
        if set(node) != {"var"}:
            raise ValueError(f"operand must be a literal or a var, got {node!r}")
        name = node["var"]
        if name in PLAIN:
            return F.col(name)
        return F.col("number")[name] if numeric else F.col("text")[name]
    if isinstance(node, bool) or not isinstance(node, (int, float, str)):
        raise ValueError(f"invalid literal {node!r}")
    # Numbers are stored as float32, so the literal is compared as one.
    return F.lit(node).cast("float") if isinstance(node, (int, float)) else F.lit(node)


def _is_text(*nodes: Any) -> bool:
    return any(isinstance(n, str) for n in nodes)


def rule_column(logic: dict[str, Any]) -> Column:
    """Compile one rule: ``var``, comparisons, ``and``, ``or``, ``!`` and ``in`` (a list).

    A missing key makes a comparison null, which counts as no hit.
    """
    if not isinstance(logic, dict) or len(logic) != 1:
        raise ValueError(f"a rule is a one-key object, got {logic!r}")
    ((op, args),) = logic.items()
    if op in COMPARE:
        left, right = args
        numeric = not _is_text(left, right)
        return COMPARE[op](_operand(left, numeric), _operand(right, numeric))
    if op in ("and", "or"):
        if not args:
            raise ValueError(f"{op!r} needs at least one part")
        parts = [rule_column(a) for a in args]
        out = parts[0]
        for part in parts[1:]:
            out = out & part if op == "and" else out | part
        return out
    if op == "!":
        return ~rule_column(args[0] if isinstance(args, list) else args)
    if op == "in":
        item, options = args
        if not isinstance(options, list) or not options:
            raise ValueError("'in' needs a list of literals")
        numeric = not _is_text(*options)
        return _operand(item, numeric).isin([_operand(o, numeric) for o in options])
    raise ValueError(f"unknown operator {op!r}")


def rule_eval(logs: DataFrame, rules: Sequence[tuple[str, dict[str, Any]]]) -> DataFrame:
    """Hits of every rule: (rule_id, log_id), in one pass over the records."""
    hits = F.array(*[F.when(rule_column(logic), F.lit(rid)) for rid, logic in rules])
    return logs.select(F.explode(F.array_compact(hits)).alias("rule_id"), "log_id")
