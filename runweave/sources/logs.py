"""Sources and sinks for metric records, log lines and traces."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.functions.text import round_sig4_float
from runweave.operators.logs import log_columns, log_query, log_series, once, series_x
from runweave.operators.rules import rule_column
from runweave.schemas import LOG_LINE, LOGS, STRING, TRACE_NODE, VALUE_TYPE, WIRE_LOGS


#: Times in JSON keep their microseconds; the writer's own form ends at milliseconds.
TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def logs_from_wire(wire: DataFrame) -> DataFrame:
    """Wire records (parallel key and value arrays) as LOGS."""
    return wire.select(
        "workspace_id",
        "project_id",
        "tracker_id",
        "log_id",
        F.col("timestamp").alias("ts"),
        F.map_from_arrays("number_keys", "number_values").alias("number"),
        F.map_from_arrays("text_keys", "text_values").alias("text"),
    )


def read_logs(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A stored LOGS table. Ids and time are plain columns, so filters on them reach the files."""
    return spark.read.schema(LOGS).format(format).load(path)


def read_wire_logs(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """Stored wire records as LOGS."""
    return logs_from_wire(spark.read.schema(WIRE_LOGS).format(format).load(path))


def select_dataset(
    logs: DataFrame,
    *,
    log_request: dict[str, Any] | None = None,
    query: dict[str, Any] | None = None,
    log_ids: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Records for a dataset; exactly one selector: a log request, a rule, or log ids."""
    given = [s for s in (log_request, query, log_ids) if s is not None]
    if len(given) != 1:
        raise ValueError("give exactly one of log_request, query and log_ids")
    if log_request is not None:
        return log_query(logs, **log_request)
    if query is not None:
        return logs.where(F.coalesce(rule_column(query), F.lit(False)))
    return log_query(logs, log_ids=log_ids)


def export_dataset(logs: DataFrame, path: str, **selector: Any) -> None:
    """Write a dataset as JSON lines. Spark leaves ``_SUCCESS`` in ``path`` when it is complete."""
    picked = select_dataset(logs, **selector).write.mode("errorifexists")
    picked.option("timestampFormat", TIMESTAMP).json(path)


def dataset_completed(spark: SparkSession, path: str) -> bool:
    """True once every part of the dataset at ``path`` is written."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = marker.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.exists(marker)


def log_columns_json(logs: DataFrame, chunk_rows: int = 1000) -> DataFrame:
    """Record columns as JSON text: keys sorted, defaults left out, enums as names, numbers to
    four significant digits. One row per column chunk."""
    series = log_series(logs).withColumn("number", round_sig4_float("number"))
    columns = log_columns(series_x(series), chunk_rows)
    names = F.create_map(*[F.lit(x) for pair in VALUE_TYPE.items() for x in pair])
    is_text = F.col("value_type") == STRING

    def item(r):
        number = r["number"]
        return F.struct(
            F.nullif(r["log_id"], F.lit("")).alias("log_id"),
            F.when(number != 0, number).alias("number"),
            F.when(is_text & (r["text"] != ""), r["text"]).alias("text"),
            F.date_format(r["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.nullif(r["x"], F.lit(0).cast("bigint")).alias("x"),
        )

    body = F.struct(
        "key",
        F.transform("rows", item).alias("rows"),
        names[F.col("value_type")].alias("value_type"),
    )
    return columns.select(
        "tracker_id", "key", "chunk", F.to_json(body, {"ignoreNullFields": "true"}).alias("json")
    )


def export_log_columns_json(logs: DataFrame, path: str, **request: Any) -> None:
    """Write the answer of a log query as one JSON text per chunk of a record column.

    Every record that the request asks for: a limit is the caller's own. Chunks lie in no order
    across files, since a sort would move all the text once more.
    """
    log_columns_json(log_query(logs, **request)).select("json").write.text(path)


def parse_json_log_lines(lines: DataFrame, logtype: str | None = None) -> DataFrame:
    """JSON log lines (column ``value``) as columns; broken lines stay in ``_corrupt_record``.

    ``logtype`` keeps one log format only.
    """
    record = F.from_json(
        "value",
        LOG_LINE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    parsed = once(lines, record=record).select("record.*")
    parsed = parsed.withColumn("timestamp", F.try_to_timestamp("timestamp"))
    if logtype is not None:
        parsed = parsed.where(
            (F.col("logtype") == logtype) | F.col("_corrupt_record").isNotNull()
        )
    return parsed


def read_json_log_lines(spark: SparkSession, path: str, logtype: str | None = None) -> DataFrame:
    """Parse files of JSON log lines."""
    return parse_json_log_lines(spark.read.text(path), logtype)


def read_trace_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Node updates of runs: one JSON node per line, the run id is the file's name.

    ``seq`` orders the lines of a file, for last-write-wins: the block first, since a large file
    is read by several tasks, then the position inside the block.
    """
    raw = spark.read.option("pathGlobFilter", "*.jsonl").text(path)
    return parse_trace_lines(
        raw.select(
            F.regexp_replace("_metadata.file_name", r"\.jsonl$", "").alias("run_id"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("seq"),
            "value",
        )
    )


def parse_trace_lines(lines: DataFrame) -> DataFrame:
    """Lines (run_id, seq, value) as node updates; the text stays in ``json``."""
    return once(lines, node=F.from_json("value", TRACE_NODE)).select(
        "run_id", "seq", "node.*", F.col("value").alias("json")
    )
