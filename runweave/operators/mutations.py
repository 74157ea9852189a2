"""Row changes as DataFrame operations: patch, compare, register, delete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def masked_update(
    base: DataFrame, patch: DataFrame, key: str = "id", columns: Sequence[str] | None = None
) -> DataFrame:
    """Overwrite only the columns that a patch row lists in ``update_keys``.

    ``patch`` has at most one row per key. ``columns`` are those that may change at all.
    """
    names = [c for c in (columns or patch.columns) if c not in (key, "update_keys")]
    for name in names:
        if name not in base.columns:
            raise ValueError(f"no column {name!r} to update")
    renamed = patch.select(
        key, "update_keys", *[F.col(c).alias(f"__new_{c}") for c in names]
    )
    joined = base.join(renamed, key, "left")

    def value(c: str) -> Column:
        if c not in names:
            return F.col(c)
        listed = F.coalesce(F.array_contains("update_keys", c), F.lit(False))
        return F.when(listed, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in base.columns])


def field_mask(original: Column, modified: Column, schema: T.StructType) -> Column:
    """Dotted paths of the fields that differ, as an array.

    Nested structs are followed; one that became empty reports its own path. A null side counts
    as empty. Both sides share ``schema``.
    """

    def walk(a: Column, b: Column, struct: T.StructType, prefix: str) -> list[Column]:
        out = []
        for field in struct.fields:
            path = prefix + field.name.rstrip("_")
            old, new = a[field.name], b[field.name]
            if isinstance(field.dataType, T.StructType):
                gone = _all_null(new, field.dataType) & ~_all_null(old, field.dataType)
                inner = walk(old, new, field.dataType, path + ".")
                out.append(F.when(gone, F.lit(path)))
                out.extend(F.when(~gone, c) for c in inner)
            else:
                out.append(F.when(~old.eqNullSafe(new), F.lit(path)))
        return out

    return F.array_compact(F.array(*walk(original, modified, schema, "")))


def _all_null(col: Column, struct: T.StructType) -> Column:
    empty = col.isNull()
    inside = None
    for field in struct.fields:
        part = (
            _all_null(col[field.name], field.dataType)
            if isinstance(field.dataType, T.StructType)
            else col[field.name].isNull()
        )
        inside = part if inside is None else inside & part
    return empty if inside is None else empty | inside


def register_rows(
    rows: DataFrame, now: datetime, defaults: Mapping[str, Any], id_column: str = "id"
) -> DataFrame:
    """New rows with fresh ids, creation times and defaults for absent or null columns."""
    out = rows.withColumn(id_column, F.uuid())
    for name in ("created_at", "updated_at"):
        out = out.withColumn(name, F.lit(now).cast("timestamp"))
    for name, value in defaults.items():
        column = F.coalesce(name, F.lit(value)) if name in rows.columns else F.lit(value)
        out = out.withColumn(name, column)
    return out


def delete_rows(base: DataFrame, doomed: DataFrame, key: str = "id") -> DataFrame:
    """The table without the listed ids. Write it to a new path; a source is never overwritten."""
    return base.join(doomed.select(key).distinct(), key, "left_anti")
