"""Dotted access to struct fields."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NO_DEFAULT = object()


def _type_at(schema: T.StructType, parts: list[str]) -> T.DataType | None:
    here: T.DataType = schema
    for part in parts:
        if not isinstance(here, T.StructType) or part not in here.names:
            return None
        here = here[part].dataType
    return here


def get_field(df: DataFrame, path: str, default: Any = _NO_DEFAULT) -> Column:
    """Field at a dotted path. A path the schema lacks is the default, or a ``KeyError``."""
    if _type_at(df.schema, path.split(".")) is None:
        if default is _NO_DEFAULT:
            raise KeyError(path)
        return F.lit(default)
    column = F.col(path)
    return column if default in (_NO_DEFAULT, None) else F.coalesce(column, F.lit(default))


def get_json_field(json_or_variant: Column, path: str, kind: str, default: Any = None) -> Column:
    """Field at a dotted path of a variant, as type ``kind``."""
    value = F.try_variant_get(json_or_variant, f"$.{path}", kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def set_field(df: DataFrame, path: str, value: Any) -> DataFrame:
    """Set the field at a dotted path; parents that do not exist are created."""
    value = value if isinstance(value, Column) else F.lit(value)
    head, *rest = path.split(".")
    if not rest:
        return df.withColumn(head, value)
    here = _type_at(df.schema, [head])
    return df.withColumn(head, _set_in(F.col(head), here, rest, value))


def _set_in(parent: Column, kind: T.DataType | None, parts: list[str], value: Column) -> Column:
    head, *rest = parts
    if not isinstance(kind, T.StructType):
        for name in reversed(parts):
            value = F.struct(value.alias(name))
        return value
    child = kind[head].dataType if head in kind.names else None
    new = value if not rest else _set_in(parent[head], child, rest, value)
    # A null parent becomes a struct with only this field set.
    fields = [new.alias(n) if n == head else parent[n].alias(n) for n in kind.names]
    if head not in kind.names:
        fields.append(new.alias(head))
    return F.struct(*fields)


def is_falsy(column: Column, kind: T.DataType) -> Column:
    """Null, zero, false, empty text or empty collection."""
    empty = column.isNull()
    if isinstance(kind, T.NumericType):
        return empty | (column == 0)
    if isinstance(kind, T.BooleanType):
        return empty | ~column
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return empty | (F.length(column) == 0)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return empty | (F.size(column) == 0)
    return empty


def set_default(df: DataFrame, path: str, value: Any) -> DataFrame:
    """Set the field where it is falsy or absent."""
    kind = _type_at(df.schema, path.split("."))
    value = value if isinstance(value, Column) else F.lit(value)
    if kind is None:
        return set_field(df, path, value)
    column = F.col(path)
    return set_field(df, path, F.when(is_falsy(column, kind), value).otherwise(column))
