"""Queries over metric records."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.operators import logs as L
from runweave.plans import views as V
from runweave.plans.registry import query
from runweave.session import scratch_path
from runweave.sources import logs as S

SERIES_SQL = """
    select project_id, tracker_id, log_id, ts, 'value' as key, 1 as value_type,
           cast(value as double) as number, cast(null as varchar) as text from {logs}
    union all
    select project_id, tracker_id, log_id, ts, 'props.k', 1, cast(props_k as double), null
    from {logs}
    union all
    select project_id, tracker_id, log_id, ts, 'event_type', 2, null, event_type from {logs}"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON records; each event type but one breaks one rule of the log format."""
    return V.table(spark, sf_dir, "events").select(
        F.concat(F.lit("p"), F.col("user_id") % 5).alias("project_id"),
        F.concat(F.lit("t"), F.col("user_id")).alias("tracker_id"),
        F.concat(F.lit("l"), F.col("event_id")).alias("log_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_json(
            F.struct(
                F.struct(
                    F.col("value"), F.from_json("props", "k bigint").alias("props")
                ).alias("m"),
                F.when(F.col("event_type") != "signup", F.col("event_type")).alias("kind"),
                F.when(F.col("event_type") == "error", True).alias("failed"),
                F.when(F.col("event_type") == "purchase", F.lit("x")).alias("a b"),
                F.when(F.col("event_type") == "signup", F.lit("x")).alias("a.b"),
                F.when(F.col("event_type") == "click", F.array(F.lit(1))).alias("list"),
            )
        ).alias("payload"),
    )


@query(
    "read_logs",
    """select project_id, tracker_id, log_id, ts, cast(value as double) as value,
              cast(props_k as double) as props_k, event_type from {logs}""",
)
def read_logs(spark, sf_dir):
    """Wire records (parallel arrays) read from files into maps, stored as LOGS and read again."""
    flat = V.view(spark, sf_dir, "logs")
    wire = flat.select(
        F.lit("w").alias("workspace_id"),
        "project_id",
        "tracker_id",
        "log_id",
        F.col("ts").alias("timestamp"),
        F.array(F.lit("value"), F.lit("props.k")).alias("number_keys"),
        F.array("value", "props_k").alias("number_values"),
        F.array(F.lit("event_type")).alias("text_keys"),
        F.array("event_type").alias("text_values"),
    )
    path = scratch_path(spark, "wire")
    wire.write.option("timestampFormat", S.TIMESTAMP).json(f"{path}/wire")
    L.write_logs(S.read_wire_logs(spark, f"{path}/wire"), f"{path}/logs")
    out = S.read_logs(spark, f"{path}/logs")
    return out.select(
        "project_id",
        "tracker_id",
        "log_id",
        "ts",
        F.col("number")["value"].cast("double").alias("value"),
        F.col("number")["props.k"].cast("double").alias("props_k"),
        F.col("text")["event_type"].alias("event_type"),
    )


@query(
    "append_logs",
    """select log_id, tracker_id, case event_type when 'view' then 'accepted'
                else 'quarantine' end as state,
              case event_type when 'view' then cast(value as double) end as value,
              case event_type when 'view' then cast(props_k as double) end as props_k,
              case event_type when 'view' then event_type end as kind,
              case event_type when 'error' then 'invalid type: failed'
                   when 'purchase' then 'invalid key: a b'
                   when 'signup' then 'separator in key: a.b'
                   when 'click' then 'invalid type: list' end as problem
       from {logs}""",
)
def append_logs(spark, sf_dir):
    """Nested JSON records split into accepted LOGS rows and a quarantine."""
    path = scratch_path(spark, "append-logs")
    L.write_checked(L.append_logs(payloads(spark, sf_dir)), path)
    rejected = F.size("problems") > 0
    return spark.read.parquet(path).select(
        "log_id",
        "tracker_id",
        F.when(rejected, "quarantine").otherwise(F.col("state")).alias("state"),
        F.col("number")["m.value"].cast("double").alias("value"),
        F.col("number")["m.props.k"].cast("double").alias("props_k"),
        F.col("text")["kind"].alias("kind"),
        F.when(rejected, F.array_join("problems", "; ")).alias("problem"),
    )


@query(
    "flatten_log",
    """select log_id, 'm.value' as key, cast(value as double) as number,
              cast(null as varchar) as text from {logs}
       union all select log_id, 'm.props.k', cast(props_k as double), null from {logs}
       union all select log_id, 'kind', null, event_type from {logs}
                 where event_type <> 'signup'
       union all select log_id, 'failed', null, null from {logs} where event_type = 'error'
       union all select log_id, 'a b', null, 'x' from {logs} where event_type = 'purchase'
       union all select log_id, 'a.b', null, 'x' from {logs} where event_type = 'signup'
       union all select log_id, 'list', null, null from {logs}
                 where event_type = 'click'""",
)
def flatten_log(spark, sf_dir):
    """Every leaf of the nested records under its dotted key."""
    flat = L.flatten_log(payloads(spark, sf_dir), "payload", ["log_id"])
    return flat.select("log_id", "key", F.col("number").cast("double").alias("number"), "text")


@query(
    "validate_keys",
    """select doc_id, key, regexp_full_match(key, '[a-zA-Z0-9_.-]+\\n?') as valid
       from (select doc_id, concat(lang, '.', source) as key from documents
             union all select doc_id, text from documents) t""",
)
def validate_keys(spark, sf_dir):
    """Keys drawn from document sources and from their prose."""
    docs = V.table(spark, sf_dir, "documents")
    keys = docs.select("doc_id", F.concat_ws(".", "lang", "source").alias("key")).unionAll(
        docs.select("doc_id", F.col("text").alias("key"))
    )
    checked = L.validate_keys(keys)
    return checked.select("doc_id", "key", (F.size("problems") == 0).alias("valid"))


@query(
    "split_by_type",
    """select log_id, 2 as numbers, case event_type when 'view' then 1 when 'error' then 1
                 when 'purchase' then 2 when 'signup' then 1 else 1 end as texts,
              cast(value as double) as value, cast(props_k as double) as props_k,
              case when event_type <> 'signup' then event_type end as kind
       from {logs}""",
)
def split_by_type(spark, sf_dir):
    """Flat entries split into a number map and a text map."""
    entries = payloads(spark, sf_dir).withColumn("entries", L.flat_entries("payload"))
    number, text = L.split_by_type("entries")
    maps = entries.select("log_id", number.alias("number"), text.alias("text"))
    return maps.select(
        "log_id",
        F.size("number").alias("numbers"),
        F.size("text").alias("texts"),
        F.col("number")["m.value"].cast("double").alias("value"),
        F.col("number")["m.props.k"].cast("double").alias("props_k"),
        F.col("text")["kind"].alias("kind"),
    )


@query(
    "log_query",
    """select tracker_id, log_id, ts, cast(value as double) as value from {logs}
       where project_id = 'p1' and ts > timestamp '2024-01-05 00:00:00'
         and ts < timestamp '2024-01-25 00:00:00'""",
)
def log_query(spark, sf_dir):
    """One key of one project inside an open time window."""
    found = L.log_query(
        V.logs(spark, sf_dir),
        project_id="p1",
        keys=["value"],
        after=datetime(2024, 1, 5),
        before=datetime(2024, 1, 25),
    )
    return found.select(
        "tracker_id", "log_id", "ts", F.col("number")["value"].cast("double").alias("value")
    )


@query(
    "log_query_ids",
    """select tracker_id, log_id, ts, event_type from {logs}
       where log_id in (select concat('l', cast(l_partkey as varchar)) from lineitem)""",
)
def log_query_ids(spark, sf_dir):
    """Records picked by a table of ids, every key."""
    ids = V.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("l"), F.col("l_partkey")).alias("log_id")
    )
    found = L.log_query(V.logs(spark, sf_dir), keys=[""], log_ids=ids)
    return found.select(
        "tracker_id", "log_id", "ts", F.col("text")["event_type"].alias("event_type")
    )


@query(
    "series_x",
    f"""select tracker_id, key, value_type, number, text, log_id, ts,
               row_number() over (partition by tracker_id, key order by ts, log_id) - 1 as x
        from ({SERIES_SQL}) s""",
)
def series_x(spark, sf_dir):
    """Every series item with its position."""
    series = L.series_x(L.log_series(V.logs(spark, sf_dir)))
    return series.select(
        "tracker_id",
        "key",
        "value_type",
        F.col("number").cast("double").alias("number"),
        "text",
        "log_id",
        "ts",
        "x",
    )


@query(
    "log_columns",
    f"""select tracker_id, key, value_type, cast(floor(x / 50) as bigint) as chunk, x,
               number, text, log_id, ts
        from (select *, row_number() over
                  (partition by tracker_id, key order by ts, log_id) - 1 as x
              from ({SERIES_SQL}) s) t""",
)
def log_columns(spark, sf_dir):
    """Record columns in chunks, opened again to compare item by item."""
    series = L.series_x(L.log_series(V.logs(spark, sf_dir)))
    columns = L.log_columns(series, chunk_rows=50)
    return columns.select(
        "tracker_id", "key", "value_type", "chunk", F.inline("rows")
    ).withColumn("number", F.col("number").cast("double"))


@query(
    "tracker_table",
    """select project_id, tracker_id,
              cast(arg_max(value, struct_pack(ts := ts, log_id := log_id)) as double) as value,
              cast(arg_max(props_k, struct_pack(ts := ts, log_id := log_id)) as double)
                  as props_k,
              arg_max(event_type, struct_pack(ts := ts, log_id := log_id)) as event_type
       from {logs} group by project_id, tracker_id""",
)
def tracker_table(spark, sf_dir):
    """Newest value of each key, one row per tracker."""
    wide = L.tracker_table(V.logs(spark, sf_dir), ["value", "props.k"], ["event_type"])
    return wide.select(
        "project_id",
        "tracker_id",
        F.col("value").cast("double").alias("value"),
        F.col("`props.k`").cast("double").alias("props_k"),
        "event_type",
    )


@query(
    "latest_values",
    f"""select tracker_id, key, value_type,
               arg_max(number, struct_pack(ts := ts, log_id := log_id)) as number,
               arg_max(text, struct_pack(ts := ts, log_id := log_id)) as text, max(ts) as ts
        from ({SERIES_SQL}) s group by tracker_id, key, value_type""",
)
def latest_values(spark, sf_dir):
    """Newest value per tracker and key, long form."""
    long = L.latest_values(V.logs(spark, sf_dir))
    return long.drop("project_id").withColumn("number", F.col("number").cast("double"))


@query(
    "logged_elements",
    """select tracker_id, count(*) as total_logged_elements from {logs} group by tracker_id""",
)
def logged_elements(spark, sf_dir):
    """Records per tracker."""
    return L.logged_elements(V.logs(spark, sf_dir))


@query(
    "reject_after_completed",
    """with e as (select tracker_id, max(ts) as end_ts from {logs}
                  where event_type = 'purchase' group by tracker_id)
       select log_id, coalesce(ts > end_ts, false) as rejected
       from {logs} l left join e on l.tracker_id = e.tracker_id""",
)
def reject_after_completed(spark, sf_dir):
    """Records after their tracker ended (at its last purchase) are set aside."""
    logs = V.logs(spark, sf_dir)
    ends = (
        logs.where(F.col("text")["event_type"] == "purchase")
        .groupBy("tracker_id")
        .agg(F.max("ts").alias("end_ts"))
    )
    checked = L.reject_after_completed(logs.select("tracker_id", "log_id", "ts"), ends)
    return checked.select("log_id", (F.size("problems") > 0).alias("rejected"))


@query(
    "export_dataset",
    """select log_id, tracker_id, ts, cast(value as double) as value, event_type
       from {logs} where project_id = 'p2' and ts > timestamp '2024-01-10 00:00:00'""",
)
def export_dataset(spark, sf_dir):
    """Records picked by a log request, exported as JSON lines and read back."""
    path = scratch_path(spark, "dataset")
    logs = V.logs(spark, sf_dir)
    S.export_dataset(logs, path, log_request={"project_id": "p2", "after": datetime(2024, 1, 10)})
    picked = spark.read.schema(logs.schema).json(path)
    return picked.select(
        "log_id",
        "tracker_id",
        "ts",
        F.col("number")["value"].cast("double").alias("value"),
        F.col("text")["event_type"].alias("event_type"),
    )
