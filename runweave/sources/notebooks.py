"""Notebooks: code of the code cells and the modules they import."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.operators.ordered import with_ordinal

NOTEBOOK = "cells array<struct<cell_type:string,source:variant>>"


def read_notebooks(spark: SparkSession, path: str) -> DataFrame:
    """One row per cell of every notebook file: nb, cell, cell_type, source.

    The format has a source as one text or as a list of lines; both give the text.
    """
    files = spark.read.schema(NOTEBOOK).option("multiLine", "true").json(path)
    files = files.select(
        F.col("_metadata.file_path").alias("nb"),
        F.posexplode("cells").alias("cell", "c"),
    )
    lines = F.array_join(F.try_variant_get("c.source", "$", "array<string>"), "")
    listed = F.schema_of_variant("c.source").startswith("ARRAY")
    source = F.when(listed, lines).otherwise(F.try_variant_get("c.source", "$", "string"))
    return files.select("nb", "cell", "c.cell_type", source.alias("source"))


def cell_code(source: str | Column = "source") -> Column:
    """Source of a code cell as script text: magic lines become comments, one final newline."""
    source = F.col(source) if isinstance(source, str) else source
    return F.concat(F.regexp_replace(source, "(?m)(?d)^%", "# %"), F.lit("\n"))


def notebook_code(cells: DataFrame, chunk_cells: int = 1000) -> DataFrame:
    """Script of each notebook: its code cells in order.

    ``cells``: nb, cell (number), cell_type, source. The text comes in parts of ``chunk_cells``
    code cells; almost every notebook is one part, and one of any size never becomes one row.
    """
    code = cells.where(F.col("cell_type") == "code")
    numbered = with_ordinal(code, ["nb"], ["cell"], F.col("cell"), "n")
    item = F.struct("n", cell_code().alias("code"))
    return (
        numbered.withColumn("part", F.floor(F.col("n") / chunk_cells))
        .groupBy("nb", "part")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select("nb", "part", F.array_join("items.code", "").alias("code"))
    )


def top_modules(code: str) -> list[str] | None:
    """Modules a piece of code imports; None when it does not parse."""
    try:
        tree = ast.parse(code)
    except (SyntaxError, ValueError, RecursionError, MemoryError):  # the last two: nested too deeply
        return None
    found = set()
    for node in ast.walk(tree):
        if isinstance(node, ast.Import):
            found.update(alias.name.partition(".")[0] for alias in node.names)
        elif isinstance(node, ast.ImportFrom) and node.module:
            found.add(node.module)
    return sorted(found)


@F.pandas_udf(T.ArrayType(T.StringType()))
def modules_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for codes in batches:
        yield codes.map(top_modules, na_action="ignore")


def import_inventory(code: DataFrame, column: str = "code") -> DataFrame:
    """Imported modules with the number of code rows that import each.

    Code that does not parse is counted under a null module.
    """
    unparsed = F.array(F.lit(None).cast("string"))
    modules = code.select(F.coalesce(modules_of(column), unparsed).alias("modules"))
    return (
        modules.select(F.explode("modules").alias("module"))
        .groupBy("module")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
