"""Artifact catalog: listings, existence, deletion, ignore rules and the activity log."""

from __future__ import annotations

import fnmatch
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.functions.paths import content_type, strip_path, strip_slashes
from runweave.operators.paging import page_no
from runweave.schemas import FILE, FOLDER


def catalog_files(
    files: DataFrame, username: str, mime_types: Mapping[str, str], path: str = "path"
) -> DataFrame:
    """Catalog rows for files (path, length, modified): cleaned name, size of at least one byte,
    times in epoch seconds, content type."""
    name = strip_path(path)
    return files.select(
        name.alias("name"),
        F.lit(username).alias("username"),
        F.greatest(F.lit(1).cast("bigint"), "length").alias("size"),
        F.unix_seconds("modified").alias("created_on"),
        F.unix_seconds("modified").alias("last_modified"),
        F.lit(FILE).alias("type"),
        content_type(name, mime_types).alias("content_type"),
    )


def put_tree(
    files: DataFrame,
    remote_path: str,
    username: str,
    mime_types: Mapping[str, str],
    relic_name: str,
    prefix: str = "",
) -> DataFrame:
    """Catalog rows for every file of a folder under a remote path of a store.

    ``files`` holds paths relative to the folder; ``prefix`` is that of the store's handle.
    """
    rows = catalog_files(files, username, mime_types)
    name = strip_path(F.concat_ws("/", F.lit(remote_path.rstrip("/")), "name"))
    if prefix:
        name = F.concat(F.lit(prefix + "/"), name)
    return rows.withColumn("name", name).withColumn("relic_name", F.lit(relic_name))


def list_relics(
    relics: DataFrame,
    relic_name: str | None = None,
    relic_id: str | None = None,
    page: int = 0,
    page_size: int = 0,
) -> DataFrame:
    """Stores, all or by name or id, with ``total_relics`` that the request finds on every row.

    A page is cut from the order of names; ``page_size`` 0 gives all, unsorted. The total is a count of
    its own, so that a page stays a top-k.
    """
    out = relics
    if relic_name:
        out = out.where(F.col("name") == relic_name)
    if relic_id:
        out = out.where(F.col("id") == relic_id)
    return _paged(out, ["name", "id"], page, page_size, "total_relics")


def _paged(df: DataFrame, order_by: Sequence[str], page: int, page_size: int, total: str) -> DataFrame:
    count = df.agg(F.count(F.lit(1))).scalar()
    shown = page_no(df, order_by, page, page_size) if page_size else df
    return shown.withColumn(total, count)


def page_of_files(
    files: DataFrame,
    path: str = "",
    recurse: bool = False,
    relic_id: str | None = None,
    file_name: str | None = None,
    page: int = 0,
    page_size: int = 100,
) -> DataFrame:
    """One page of :func:`list_files` in the order of store, name and size, with ``total_files`` on every row."""
    found = list_files(files, path, recurse, relic_id, file_name)
    return _paged(found, ["relic_id", "name", "size"], page, page_size, "total_files")


def list_files(
    files: DataFrame,
    path: str = "",
    recurse: bool = False,
    relic_id: str | None = None,
    file_name: str | None = None,
) -> DataFrame:
    """Files whose key starts with ``path``; without ``recurse`` only those with no further slash.

    ``file_name`` keeps the files whose last part it is. Over flat keys the whole recursion is one prefix
    filter.
    """
    out = files if relic_id is None else files.where(F.col("relic_id") == relic_id)
    if file_name:
        out = out.where(F.element_at(F.split("name", "/"), -1) == file_name)
    if path:
        out = out.where(F.col("name").startswith(path))
    if not recurse:
        rest = F.substr("name", F.lit(len(path) + 1))
        out = out.where(~F.rtrim(rest, F.lit("/")).contains("/"))
    return out


def list_dir(files: DataFrame, prefix: str = "") -> DataFrame:
    """Immediate children of a folder in each store: a FILE, or a FOLDER when keys lie deeper."""
    base = prefix.strip("/")
    base = f"{base}/" if base else ""
    inside = files.where(F.col("name").startswith(base)) if base else files
    rest = F.substr("name", F.lit(len(base) + 1))
    deeper = rest.contains("/")
    return (
        inside.select(
            "relic_id", F.split(rest, "/", 2)[0].alias("child"), deeper.alias("deeper"), "size"
        )
        .groupBy("relic_id", "child")
        .agg(
            F.when(F.bool_or("deeper"), FOLDER).otherwise(FILE).alias("type"),
            F.count(F.lit(1)).alias("files"),
            F.sum("size").alias("size"),
        )
        .withColumn("name", F.concat(F.lit(base), "child"))
        .drop("child")
    )


def has_file(files: DataFrame, path: str) -> DataFrame:
    """One row: does a file of this name exist, slashes at the ends aside?"""
    wanted = path.strip("/")
    return files.agg(
        F.coalesce(F.bool_or(strip_slashes("name") == wanted), F.lit(False)).alias("exists")
    )


def has_files(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Bulk form of :func:`has_file`: ``refs`` (relic_id, path) with ``exists``."""
    keys = files.select(
        "relic_id", strip_slashes("name").alias("__key"), F.lit(True).alias("exists")
    ).distinct()
    keyed = refs.withColumn("__key", strip_slashes("path"))
    return (
        keyed.join(keys, ["relic_id", "__key"], "left")
        .withColumn("exists", F.coalesce("exists", F.lit(False)))
        .drop("__key")
    )


def delete_files(files: DataFrame, doomed: DataFrame) -> DataFrame:
    """The catalog without the listed keys (relic_id, name)."""
    keys = ["relic_id", "name"]
    return files.join(doomed.select(*keys).distinct(), keys, "left_anti")


def ignore_pattern_column(pattern: str, path: str | Column) -> Column:
    """Does one ignore pattern match? A final ``/``: regex anywhere; a ``*``: glob over the whole
    path; else the path's end."""
    path = F.col(path) if isinstance(path, str) else path
    if pattern.endswith("/"):
        return path.rlike(pattern)
    if "*" in pattern:
        # Python closes its translation with \Z, which Java would let pass before a line feed.
        body = fnmatch.translate(pattern).removesuffix(r"\Z").removesuffix(r"\z")
        return path.rlike(f"^{body}\\z")
    return path.endswith(pattern)


def ignore_files(
    files: DataFrame, patterns: Sequence[str], path: str = "name"
) -> DataFrame:
    """Files that no ignore pattern matches.

    The patterns of an ignore file are few, so they become one predicate: no join at all.
    """
    if not patterns:
        return files
    hit = reduce(lambda a, b: a | b, [ignore_pattern_column(p, path) for p in patterns])
    return files.where(~hit)


def ignore_union(
    defaults: DataFrame, user: DataFrame, included: DataFrame, from_file: DataFrame
) -> DataFrame:
    """Default and user patterns less the forced includes, then those of the ignore file; each
    once, sorted."""
    base = defaults.select("pattern").union(user.select("pattern"))
    kept = base.join(included.select("pattern"), "pattern", "left_anti")
    return kept.union(from_file.select("pattern")).distinct().orderBy("pattern")


def activity_log(
    activity: DataFrame,
    relic_id: str | None = None,
    username: str | None = None,
    relic_name: str | None = None,
    from_timestamp_ns: int = 0,
    to_timestamp_ns: int = 0,
    page: int = 0,
    page_size: int = 0,
) -> DataFrame:
    """Operations of a time range, both ends inclusive, 0 is open.

    A page is cut from the time order; ``page_size`` 0 gives all, unsorted.
    """
    out = activity
    if relic_id:
        out = out.where(F.col("relic_id") == relic_id)
    if username:
        out = out.where(F.col("username") == username)
    if relic_name:
        out = out.where(F.col("relic_name") == relic_name)
    if from_timestamp_ns:
        out = out.where(F.col("timestamp_ns") >= from_timestamp_ns)
    if to_timestamp_ns:
        out = out.where(F.col("timestamp_ns") <= to_timestamp_ns)
    return page_no(out, ["timestamp_ns", "object_name"], page, page_size) if page_size else out
