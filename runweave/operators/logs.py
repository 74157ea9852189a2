"""Metric records: flatten, validate, split, query and shape into series and tables."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from datetime import datetime
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.operators.ordered import TASK_ROWS, micros, with_ordinal
from runweave.operators.paging import page_offset
from runweave.schemas import KEY_PATTERN, KEY_SEPARATOR, NUMBER, STRING

# First letters of BIGINT, DOUBLE, DECIMAL, FLOAT, INT, SMALLINT and TINYINT.
NUMERIC_VARIANTS = ["BIG", "DOU", "DEC", "FLO", "INT", "SMA", "TIN"]
CHILDREN = "map<string,variant>"


class Split(NamedTuple):
    """Rows that passed and rows set aside with the reason in ``problems``."""

    accepted: DataFrame
    quarantine: DataFrame


def halves(checked: DataFrame) -> Split:
    """Two views of a table with ``problems``; each of them reads the table.

    To store both, write the one table: :func:`write_checked`.
    """
    clean = F.size("problems") == 0
    return Split(checked.where(clean).drop("problems"), checked.where(~clean))


def write_checked(checked: DataFrame, path: str) -> None:
    """Append accepted and rejected rows to their own folders below ``path``, in one pass."""
    state = F.when(F.size("problems") == 0, "accepted").otherwise("rejected")
    checked.withColumn("state", state).write.mode("append").partitionBy("state").parquet(path)


# --- nested records to flat keys ------------------------------------------------


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that they are computed once.

    A filter or a second use above a plain projection would be pushed into it and repeat the
    work; a generator's output is a column like any other.
    """
    one = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(one))


def _entry(key: Column, raw_key: Column, value: Column, dotted: Column) -> Column:
    return F.struct(
        key.alias("key"),
        value.alias("value"),
        F.schema_of_variant(value).alias("type"),
        (dotted | raw_key.contains(KEY_SEPARATOR)).alias("dotted"),
    )


def _root_entries(node: Column) -> Column:
    children = F.map_entries(F.try_variant_get(node, "$", CHILDREN))
    return F.transform(children, lambda c: _entry(c["key"], c["key"], c["value"], F.lit(False)))


def _open_objects(entries: Column) -> Column:
    def child(parent: Column, c: Column) -> Column:
        key = F.concat(parent["key"], F.lit(KEY_SEPARATOR), c["key"])
        return _entry(key, c["key"], c["value"], parent["dotted"])

    def opened(e: Column) -> Column:
        children = F.map_entries(F.try_variant_get(e["value"], "$", CHILDREN))
        return F.when(
            e["type"].startswith("OBJECT"), F.transform(children, lambda c: child(e, c))
        ).otherwise(F.array(e))

    return F.flatten(F.transform(entries, opened))


# Levels that expressions open; deeper records, which are rare, take a batch function without a limit.
SHALLOW = 3
LEAVES = T.ArrayType(
    T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("number", T.FloatType()),
            T.StructField("text", T.StringType()),
            T.StructField("problem", T.StringType()),
        ]
    )
)


def flat_entries(payload: str | Column) -> Column:
    """Leaves of the JSON object in ``payload``, as
    ``array<struct<key, number, text, problem>>``; null when the text is no JSON object.

    Keys are joined with dots; lists are leaves; empty objects vanish. A leaf has a number
    (float32) or a text, or a ``problem``: the separator in a key's own name, a character that
    keys may not have, or a value that is neither. Records are opened to some thousand levels, and deeper
    ones become a single leaf with the problem ``TOO_DEEP`` and an empty key. A record has
    no more levels than its text has braces, so few braces go through expressions, and only the
    texts with more are sent to Python, in Arrow batches.
    """
    text = F.col(payload) if isinstance(payload, str) else payload
    braces = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    entries = _root_entries(F.try_parse_json(text))
    flat = braces <= 1
    chosen = F.when(flat, F.transform(entries, _leaf))
    for _ in range(1, SHALLOW):
        entries = _open_objects(entries)
    chosen = chosen.when(braces <= SHALLOW, F.transform(entries, _leaf))
    return chosen.otherwise(_deep_entries(F.when(braces > SHALLOW, text)))


#: The problem of a record that cannot be opened for its depth.
TOO_DEEP = "nested too deeply"


def _unique(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a key occurs twice")
    return out


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def leaves_of(text: str | None) -> list[dict[str, Any]] | None:
    """Leaves of one JSON object, in the order and form of :func:`flat_entries`.

    A text nested more deeply than the interpreter can read is one leaf with a problem, so it is not lost.
    """
    if text is None:
        return None
    try:
        root = json.loads(text, object_pairs_hook=_unique, parse_constant=_no_constant)
    except RecursionError:
        return [{"key": "", "number": None, "text": None, "problem": TOO_DEEP}]
    except ValueError:
        return None
    if not isinstance(root, dict):
        return None
    out, left = [], [("", "", root, False)]
    while left:
        key, own, value, dotted = left.pop()
        if isinstance(value, dict):
            dotted = dotted or KEY_SEPARATOR in own
            prefix = f"{key}{KEY_SEPARATOR}" if key or own else ""
            left.extend((prefix + k, k, value[k], dotted) for k in sorted(value, reverse=True))
            continue
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        problem = None
        if dotted or KEY_SEPARATOR in own:
            problem = f"separator in key: {key}"
        elif not re.match(KEY_PATTERN, key):
            problem = f"invalid key: {key}"
        elif not number and not isinstance(value, str):
            problem = f"invalid type: {key}"
        try:
            as_number = float(value) if number else None
        except OverflowError:
            as_number = float("inf") if value > 0 else float("-inf")
        text = value if isinstance(value, str) else None
        out.append({"key": key, "number": as_number, "text": text, "problem": problem})
    return out


@F.pandas_udf(LEAVES)
def _deep_entries(texts: pd.Series) -> pd.Series:
    return texts.map(leaves_of, na_action="ignore")


def _leaf(e: Column) -> Column:
    number = F.substring(e["type"], 1, 3).isin(NUMERIC_VARIANTS)
    text = e["type"] == "STRING"
    problem = (
        F.when(e["dotted"], F.concat(F.lit("separator in key: "), e["key"]))
        .when(~valid_key(e["key"]), F.concat(F.lit("invalid key: "), e["key"]))
        .when(~(number | text), F.concat(F.lit("invalid type: "), e["key"]))
    )
    return F.struct(
        e["key"].alias("key"),
        F.when(number, F.try_variant_get(e["value"], "$", "double").cast("float")).alias("number"),
        F.when(text, F.try_variant_get(e["value"], "$", "string")).alias("text"),
        problem.alias("problem"),
    )


def valid_key(key: Column) -> Column:
    """True for keys of letters, digits, ``_``, ``-`` and ``.``; one final line feed passes."""
    return key.rlike("(?d)" + KEY_PATTERN)


def flatten_log(df: DataFrame, payload: str, keep: Sequence[str]) -> DataFrame:
    """One row per leaf of the JSON text in ``payload``: ``keep``, key, number, text, problem."""
    opened = df.withColumn("__entries", flat_entries(payload))
    return opened.select(*keep, F.inline("__entries"))


def flatten_columns(schema: T.StructType, sep: str = KEY_SEPARATOR) -> list[tuple[str, Column]]:
    """Static form of the flattening: dotted name and column of every leaf of a struct schema.

    A name that holds the separator is an error, as is a leaf that is neither number nor text.
    """
    out: list[tuple[str, Column]] = []

    def walk(fields: Iterable[T.StructField], path: tuple[str, ...]) -> None:
        for field in fields:
            if sep in field.name:
                raise ValueError(f"key {field.name!r} contains the separator {sep!r}")
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, here)
            elif isinstance(field.dataType, (T.NumericType, T.StringType)):
                out.append((sep.join(here), F.col(".".join(f"`{p}`" for p in here))))
            else:
                raise ValueError(f"invalid type {field.dataType} for key {sep.join(here)!r}")

    walk(schema.fields, ())
    return out


def validate_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """All rows with ``problems``: empty for a loggable key. One pass; see :func:`halves`."""
    ok = F.coalesce(valid_key(F.col(key)), F.lit(False))
    problem = F.concat(F.lit("invalid key: "), F.coalesce(key, F.lit("null")))
    return df.withColumn("problems", F.array_compact(F.array(F.when(~ok, problem))))


def split_by_type(entries: str | Column) -> tuple[Column, Column]:
    """The number map and the text map of flat entries."""

    def pairs(field: str) -> Column:
        some = F.filter(entries, lambda e: e[field].isNotNull())
        return F.map_from_entries(F.transform(some, lambda e: F.struct(e["key"], e[field])))

    return pairs("number"), pairs("text")


def append_logs(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Turn JSON payloads into LOGS rows; whole records with any bad key or value have ``problems``.

    Needs ``project_id``, ``tracker_id``, ``ts`` and ``payload``; a missing or empty ``log_id``
    is replaced by a new one. A record with problems keeps its payload and has null maps; the
    payload of an accepted one is null. Narrow and one pass: no shuffle, one scan.
    """
    if "log_id" not in df.columns:
        df = df.withColumn("log_id", F.lit(None).cast("string"))
    checked = once(
        df.withColumn("entries", flat_entries(payload)),
        problems=F.coalesce(
            F.array_compact(F.transform("entries", lambda e: e["problem"])),
            F.array(F.lit("not a JSON object")),
        ),
    )
    clean = F.size("problems") == 0
    number, text = split_by_type("entries")
    carried = [c for c in df.columns if c not in (payload, "log_id")]
    return checked.select(
        *carried,
        F.coalesce(F.nullif("log_id", F.lit("")), F.uuid()).alias("log_id"),
        F.when(clean, number).alias("number"),
        F.when(clean, text).alias("text"),
        F.when(~clean, F.col(payload)).alias(payload),
        "problems",
    )


def append_struct_logs(df: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """LOGS rows from typed columns: names are checked once on the driver, rows never.

    A null leaf is an absent key.
    """
    leaves = flatten_columns(df.select(*value_columns).schema)
    for name, _ in leaves:
        if not re.match(KEY_PATTERN, name):
            raise ValueError(f"invalid key {name!r}")
    types = {n: df.select(c).schema[0].dataType for n, c in leaves}
    numbers = [(n, c.cast("float")) for n, c in leaves if isinstance(types[n], T.NumericType)]
    texts = [(n, c) for n, c in leaves if isinstance(types[n], T.StringType)]
    rest = [c for c in df.columns if c not in value_columns]
    return df.select(
        *rest,
        _dense_map(numbers, "float").alias("number"),
        _dense_map(texts, "string").alias("text"),
    )


def _dense_map(pairs: Sequence[tuple[str, Column]], value_type: str) -> Column:
    if not pairs:
        return F.create_map().cast(f"map<string,{value_type}>")
    full = F.map_from_arrays(
        F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[c for _, c in pairs])
    )
    return F.map_filter(full, lambda _, v: v.isNotNull())


def write_logs(logs: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Append to a LOGS table, a folder per project.

    The rebalance brings the rows of small projects together, so that files do not number tasks times
    projects, and splits a hot project over as many tasks as its size asks for.
    """
    (
        logs.hint("rebalance", F.col("project_id"))
        .write.mode("append")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("project_id")
        .parquet(path)
    )


# --- reading ---------------------------------------------------------------------


def check_window(after: datetime | None, before: datetime | None, limit: int) -> None:
    if after is not None and before is not None and after > before:
        raise ValueError(f"the time window is empty: it opens at {after} and closes at {before}")
    if limit < 0:
        raise ValueError(f"a limit of {limit} records makes no sense; 0 stands for all")


def log_query(
    logs: DataFrame,
    project_id: str | None = None,
    tracker_id: str | None = None,
    keys: Sequence[str] = (),
    after: datetime | None = None,
    before: datetime | None = None,
    limit: int = 0,
    log_ids: Sequence[str] | DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Filtered log records.

    ``after`` and ``before`` are exclusive; no keys or ``[""]`` means every key; a record with
    none of the asked keys is left out. ``log_ids`` is a short list or a DataFrame with ``log_id``,
    joined. A ``limit`` takes the oldest records by (ts, log_id); 0 means all, which are sorted
    only when ``ordered``, since a sort of everything is a shuffle of everything.
    """
    check_window(after, before, limit)
    out = logs
    if project_id:
        out = out.where(F.col("project_id") == project_id)
    if tracker_id:
        out = out.where(F.col("tracker_id") == tracker_id)
    if after is not None:
        out = out.where(F.col("ts") > F.lit(after))
    if before is not None:
        out = out.where(F.col("ts") < F.lit(before))
    if isinstance(log_ids, DataFrame):
        out = out.join(log_ids.select("log_id").distinct(), "log_id", "left_semi")
    elif log_ids is not None:
        out = out.where(F.col("log_id").isin(list(log_ids)))
    wanted = [k for k in keys if k]
    if wanted:
        out = (
            out.withColumn("number", F.map_filter("number", lambda k, _: k.isin(wanted)))
            .withColumn("text", F.map_filter("text", lambda k, _: k.isin(wanted)))
            .where((F.size("number") > 0) | (F.size("text") > 0))
        )
    return page_offset(out, ["ts", "log_id"], limit=limit) if limit or ordered else out


def log_series(logs: DataFrame) -> DataFrame:
    """SERIES: one row per (record, key), from both maps in one pass."""
    numbers = F.transform(
        F.map_entries("number"),
        lambda e: F.struct(
            e["key"].alias("key"),
            F.lit(NUMBER).alias("value_type"),
            e["value"].alias("number"),
            F.lit(None).cast("string").alias("text"),
        ),
    )
    texts = F.transform(
        F.map_entries("text"),
        lambda e: F.struct(
            e["key"].alias("key"),
            F.lit(STRING).alias("value_type"),
            F.lit(None).cast("float").alias("number"),
            e["value"].alias("text"),
        ),
    )
    both = F.concat(
        F.coalesce(numbers, F.array().cast(_ENTRY)), F.coalesce(texts, F.array().cast(_ENTRY))
    )
    return logs.select(
        "project_id", "tracker_id", "ts", "log_id", F.explode(both).alias("e")
    ).select("project_id", "tracker_id", "e.*", "ts", "log_id")


_ENTRY = "array<struct<key:string,value_type:int,number:float,text:string>>"


def series_x(series: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """Add ``x``, the 0-based position of each item of a (tracker, key) series."""
    return with_ordinal(
        series, ["tracker_id", "key"], ["ts", "log_id"], micros("ts"), rows=rows
    )


def log_columns(series: DataFrame, chunk_rows: int = 1000) -> DataFrame:
    """Record columns: per (tracker, key) the items in order, in chunks of ``chunk_rows``.

    ``series`` carries ``x``. Chunk ``n`` holds items ``n * chunk_rows`` and on, so a series of
    any length stays whole while no group grows past ``chunk_rows``.
    """
    item = F.struct("x", "ts", "number", "text", "log_id")
    return (
        series.withColumn("chunk", F.floor(F.col("x") / chunk_rows))
        .groupBy("tracker_id", "key", "value_type", "chunk")
        .agg(F.sort_array(F.collect_list(item)).alias("rows"))
    )


# --- one row per tracker -----------------------------------------------------------


def latest_values(logs: DataFrame) -> DataFrame:
    """Newest value per (tracker, key), long form, for any number of keys."""
    newest = F.struct("ts", "log_id")
    return (
        log_series(logs)
        .groupBy("project_id", "tracker_id", "key", "value_type")
        .agg(
            F.max_by("number", newest).alias("number"),
            F.max_by("text", newest).alias("text"),
            F.max("ts").alias("ts"),
        )
    )


def tracker_table(
    logs: DataFrame,
    number_keys: Sequence[str] = (),
    text_keys: Sequence[str] = (),
    trackers: DataFrame | None = None,
) -> DataFrame:
    """One row per tracker with the newest value of each named key.

    ``trackers`` (one page of ids) restricts the rows first. One aggregation straight over the
    maps: nothing is exploded, and partial results are combined before the shuffle.
    """
    if trackers is not None:
        logs = logs.join(
            trackers.select(F.col("id").alias("tracker_id")), "tracker_id", "left_semi"
        )
    columns = []
    for source, keys in (("number", number_keys), ("text", text_keys)):
        for key in keys:
            order = F.when(F.map_contains_key(source, key), F.struct("ts", "log_id"))
            columns.append(F.max_by(F.col(source)[key], order).alias(key))
    return logs.groupBy("project_id", "tracker_id").agg(*columns)


def logged_elements(logs: DataFrame) -> DataFrame:
    """Accepted records per tracker."""
    return logs.groupBy("tracker_id").agg(F.count(F.lit(1)).alias("total_logged_elements"))


def reject_after_completed(logs: DataFrame, ends: DataFrame) -> DataFrame:
    """All records with ``problems``: not empty for one later than its tracker's ``end_ts``.

    ``ends`` (tracker_id, end_ts) has one row per tracker, so one left join will do: Spark broadcasts
    ends that it has measured to be small, and splits a hot tracker's records otherwise.
    """
    late = F.coalesce(F.col("ts") > F.col("end_ts"), F.lit(False))
    problem = F.when(late, F.lit("tracker is completed"))
    joined = logs.join(ends.select("tracker_id", "end_ts"), "tracker_id", "left")
    return joined.withColumn("problems", F.array_compact(F.array(problem))).drop("end_ts")
