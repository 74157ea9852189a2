"""Streams over the test tables, run until their input is used up, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.plans import views as V
from runweave.plans.registry import query
from runweave.plans.telemetry_queries import BEAT_TIMEOUT, DUCK_ROUTE, TEMPLATES
from runweave.session import scratch_path
from runweave.streaming import live as S
from runweave.streaming.guard import guard_stream, guarded
from runweave.streaming.nodes import closing_nodes_stream as closing_nodes


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = V.table(spark, sf_dir, "events").schema
    return S.stream_logs(spark, sf_dir, schema, glob="events.parquet").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.concat(F.lit("t"), "user_id").alias("tracker_id"),
        F.concat(F.lit("l"), "event_id").alias("log_id"),
        "ts",
        F.col("value").cast("float").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("bigint").alias("props_k"),
        "event_type",
    )


def _appended(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    S.append_stream(df, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/table")


def _updated(spark: SparkSession, df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    path = scratch_path(spark, name)
    S.update_stream(df, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return S.current_rows(spark, f"{path}/table", keys)


@query(
    "stream_logs",
    f"""select id, path, {DUCK_ROUTE} as route, latency_ns, ts from {{requests}}
        where path not in ('/', '/metadata')""",
)
def stream_logs(spark, sf_dir):
    """Live request records as they stream in."""
    k = F.get_json_object("props", "$.k")
    path = (
        F.when(F.col("event_type") == "view", "/")
        .when(F.col("event_type") == "signup", "/metadata")
        .when(F.col("event_type") == "purchase", F.concat(F.lit("/item/"), k, F.lit("/buy")))
        .otherwise(F.concat(F.lit("/item/"), k))
    )
    requests = _events(spark, sf_dir).select(
        F.concat(F.lit("l"), "event_id").alias("id"),
        F.lit("http").alias("type"),
        path.alias("path"),
        F.round(F.col("value") * 1000000).cast("bigint").alias("latency_ns"),
        "ts",
    )
    return _appended(spark, S.live_request_logs(requests, TEMPLATES), "requests")


@query(
    "dedupe_retries_stream",
    "select tracker_id, log_id, ts, cast(value as double) as value from {logs}",
)
def dedupe_retries_stream(spark, sf_dir):
    """Records sent twice are kept once."""
    logs = _stream(spark, sf_dir).select("tracker_id", "log_id", "ts", "value")
    twice = logs.withColumn(
        "copy", F.explode(F.when(F.col("log_id").endswith("0"), F.array(F.lit(1), F.lit(2)))
                          .otherwise(F.array(F.lit(1))))
    ).drop("copy")
    return _appended(spark, S.dedupe_retries_stream(twice), "dedupe")


@query(
    "downsample_stream",
    """select tracker_id, time_bucket(interval 1 hour, ts) as slot, max(ts) as ts,
              cast(arg_max(value, ts) as double) as value
       from {logs} group by tracker_id, time_bucket(interval 1 hour, ts)
       having time_bucket(interval 1 hour, max(ts)) + interval 1 hour
              <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)""",
)
def downsample_stream(spark, sf_dir):
    """Newest record per tracker and hour, for the hours the watermark has closed."""
    logs = _stream(spark, sf_dir).select("tracker_id", "log_id", "ts", "value")
    kept = S.downsample_stream(logs, 3600, ["tracker_id"], ["value"], "log_id")
    return _appended(spark, kept, "downsample")


@query(
    "heartbeat_sessions_stream",
    f"""with g as (select tracker_id, ts, case when epoch_us(ts) - epoch_us(lag(ts) over w)
                       < {BEAT_TIMEOUT * 1_000_000} then 0 else 1 end as opened
                   from {{logs}} window w as (partition by tracker_id order by ts)),
             s as (select *, sum(opened) over (partition by tracker_id order by ts
                       rows unbounded preceding) as n from g)
        select tracker_id, min(ts) as session_start,
               max(ts) + interval {BEAT_TIMEOUT} second as session_end, count(*) as beats
        from s group by tracker_id, n
        having max(ts) + interval {BEAT_TIMEOUT} second
               <= (select date_trunc('millisecond', max(ts)) - interval 1 hour from events)""",
)
def heartbeat_sessions_stream(spark, sf_dir):
    """Closed spans of liveness of each tracker."""
    beats = _stream(spark, sf_dir).select("tracker_id", "ts")
    return _appended(spark, S.heartbeat_sessions_stream(beats, BEAT_TIMEOUT), "sessions")


@query(
    "node_state_stream",
    """select tracker_id as run_id, 'n' || cast(props_k as bigint) % 7 as id, max(ts) as ts,
              arg_max(event_type, ts) as status
       from {logs} group by all""",
)
def node_state_stream(spark, sf_dir):
    """Last state of every node of every run, kept live."""
    updates = _stream(spark, sf_dir).select(
        F.col("tracker_id").alias("run_id"),
        F.concat(F.lit("n"), F.col("props_k") % 7).alias("id"),
        "ts",
        F.col("log_id").alias("seq"),
        F.col("event_type").alias("status"),
    )
    return _updated(spark, S.node_state_stream(updates, ["status"]), "nodes", ["run_id", "id"])


@query(
    "closing_nodes_stream",
    """with n as (select 'p' || cast(substr(tracker_id, 2) as bigint) % 5 as run_id,
                         'n' || cast(props_k as bigint) as id, max(ts) as ts, arg_max(event_type, ts) as status
                  from {logs} group by all)
       select *, epoch_ms(ts) + 21600000 <= (select epoch_ms(max(ts)) - 3600000 from events) as closed from n""",
)
def closing_nodes_stream(spark, sf_dir):
    """Last state of every node of every project, closed after six hours of silence."""
    updates = _stream(spark, sf_dir).select(
        F.concat(F.lit("p"), F.substring("tracker_id", 2, 20).cast("bigint") % 5).alias("run_id"),
        F.concat(F.lit("n"), "props_k").alias("id"),
        "ts",
        F.col("log_id").alias("seq"),
        F.col("event_type").alias("status"),
    )
    return _updated(spark, closing_nodes(updates, ["status"], 21600), "closing", ["run_id", "id"])


@query(
    "tracker_status_stream",
    """select tracker_id, max(case when event_type = 'error' and props_k < 5 then 3
                  when event_type = 'purchase' then 2 else 1 end) as status
       from {logs} group by tracker_id""",
)
def tracker_status_stream(spark, sf_dir):
    """Status of each tracker, kept live."""
    kind = (
        F.when((F.col("event_type") == "error") & (F.col("props_k") < 5), "failed")
        .when(F.col("event_type") == "purchase", "end")
        .otherwise("log")
    )
    events = _stream(spark, sf_dir).select("tracker_id", kind.alias("kind"))
    return _updated(spark, S.tracker_status_stream(events), "status", ["tracker_id"])


@query(
    "guard_completed",
    """with e as (select tracker_id, min(ts) as end_ts from {logs}
                  where event_type = 'purchase' group by tracker_id)
       select l.tracker_id, log_id, coalesce(ts > end_ts, false) as rejected
       from {logs} l left join e on l.tracker_id = e.tracker_id
       where event_type <> 'purchase'""",
)
def guard_completed(spark, sf_dir):
    """Live records after their tracker's first purchase are set aside."""
    kind = F.when(F.col("event_type") == "purchase", "end").otherwise("log")
    events = _stream(spark, sf_dir).select("tracker_id", "log_id", "ts", kind.alias("kind"))
    path = scratch_path(spark, "guard")
    S.guard_completed(events, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    rows = S.guarded_rows(spark, f"{path}/table")
    return rows.select("tracker_id", "log_id", (F.size("problems") > 0).alias("rejected"))


@query(
    "guard_stream",
    """with e as (select tracker_id, min(ts) as end_ts from {logs}
                  where event_type = 'purchase' group by tracker_id),
            w as (select least(max(ts) filter (where event_type = 'purchase'),
                               max(ts) filter (where event_type <> 'purchase')) - interval 1 hour as mark from {logs})
       select l.tracker_id, log_id, coalesce(ts > end_ts, false) as late
       from {logs} l left join e on l.tracker_id = e.tracker_id cross join w
       where event_type <> 'purchase' and (coalesce(ts > end_ts, false) or ts <= date_trunc('millisecond', mark))""",
)
def late_records_stream(spark, sf_dir):
    """Records after their tracker's first purchase are told as they come, others once the watermark has passed."""
    events = _stream(spark, sf_dir)
    logs = events.where("event_type <> 'purchase'").select("tracker_id", "log_id", "ts")
    ends = events.where("event_type = 'purchase'").select("tracker_id", F.col("ts").alias("end_ts"))
    path = scratch_path(spark, "late")
    guard_stream(logs, ends, f"{path}/table", f"{path}/checkpoint", horizon="3650 days").awaitTermination()
    return guarded(spark, f"{path}/table").select("tracker_id", "log_id", "late")


@query(
    "tail_logs",
    """select '{"id":' || event_id || ',"kind":"' || event_type || '"}' as line from events""",
)
def tail_logs(spark, sf_dir):
    """Log lines written from the events, tailed to another folder: the first half, then the rest."""
    lines = V.table(spark, sf_dir, "events").select(
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("value"),
        (F.col("event_id") % 2).alias("half"),
    )
    path = scratch_path(spark, "tail")
    for half in (0, 1):  # the second run goes on from the checkpoint of the first
        lines.where(F.col("half") == half).select("value").write.mode("append").text(f"{path}/in")
        S.tail_logs(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint")
    return spark.read.text(f"{path}/out").withColumnRenamed("value", "line")
