"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.plans.views import duckdb_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Emit instants as UTC wall-clock times, as the test tables hold them."""
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp_ntz"))
    return df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the DuckDB twin with ``{view}`` names."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _plain_times(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = duckdb_sql(sql)
        return fn

    return add
