"""Queries over requests, regions, heartbeats, samples and log lines."""

from pyspark.sql import functions as F

from runweave.operators import telemetry as T
from runweave.plans import views as V
from runweave.plans.registry import query
from runweave.session import scratch_path
from runweave.sources import logs as S

# The first template that fits wins: the third never does.
TEMPLATES = ["/item/{k}/buy", "/item/{k}", "/item/{other}", "/"]
BEAT_TIMEOUT = 6 * 3600

DUCK_ROUTE = """case when regexp_full_match(path, '/item/\\w+/buy') then '/item/{k}/buy'
                     when regexp_full_match(path, '/item/\\w+') then '/item/{k}'
                     when path = '/' then '/' end"""


@query(
    "request_filter",
    """select id, path, latency_ns, failed from {requests}
       where type = 'http' and path not in ('/', '/metadata')""",
)
def request_filter(spark, sf_dir):
    """Requests worth logging."""
    kept = T.request_filter(V.view(spark, sf_dir, "requests"))
    return kept.select("id", "path", "latency_ns", "failed")


@query("route_match", f"select id, path, {DUCK_ROUTE} as route from {{requests}}")
def route_match(spark, sf_dir):
    """Path template of every request, null when none fits."""
    matched = T.route_match(V.view(spark, sf_dir, "requests"), TEMPLATES)
    return matched.select("id", "path", "route")


@query(
    "route_latency",
    f"""select route, count(*) as requests, count(*) filter (where failed) as exceptions,
               avg(latency_ns) as mean_ns, max(latency_ns) as max_ns
        from (select *, {DUCK_ROUTE} as route from {{requests}}
              where type = 'http' and path not in ('/', '/metadata')) r
        group by route""",
)
def route_latency(spark, sf_dir):
    """Requests, failures and latency per route."""
    return T.route_latency(V.view(spark, sf_dir, "requests"), TEMPLATES)


@query(
    "region_latency",
    """with d as (select *, sum(case kind when 'ENTER' then 1 else -1 end)
                      over (partition by thread order by ts, region rows unbounded preceding) as n
                  from {spans}),
            l as (select *, case kind when 'ENTER' then n - 1 else n end as level from d),
            p as (select *, lag(ts) over w as enter_ts, lag(region) over w as enter_region
                  from l window w as (partition by thread, level order by ts, region))
       select thread, enter_region as region, cast(level as bigint) as level, enter_ts,
              ts as leave_ts, (epoch_us(ts) - epoch_us(enter_ts)) / 1e6 as elapsed
       from p where kind = 'LEAVE'""",
)
def region_latency(spark, sf_dir):
    """Elapsed time of every nested region."""
    return T.region_latency(V.view(spark, sf_dir, "spans"))


@query(
    "heartbeat_gaps",
    """select * from (
           select tracker_id, lag(ts) over w as previous, ts,
                  (epoch_us(ts) - epoch_us(lag(ts) over w)) / 1e6 as gap_seconds
           from {logs} window w as (partition by tracker_id order by ts)) g
       where gap_seconds > 3600""",
)
def heartbeat_gaps(spark, sf_dir):
    """Silences of more than an hour: sixty beats missed."""
    beats = V.view(spark, sf_dir, "logs").select("tracker_id", "ts")
    return T.heartbeat_gaps(beats, factor=60)


@query(
    "heartbeat_sessions",
    f"""with g as (select tracker_id, ts, case when epoch_us(ts) - epoch_us(lag(ts) over w)
                       < {BEAT_TIMEOUT * 1_000_000} then 0 else 1 end as opened
                   from {{logs}} window w as (partition by tracker_id order by ts)),
             s as (select *, sum(opened) over (partition by tracker_id order by ts
                       rows unbounded preceding) as n from g)
        select tracker_id, min(ts) as session_start,
               max(ts) + interval {BEAT_TIMEOUT} second as session_end, count(*) as beats
        from s group by tracker_id, n""",
)
def heartbeat_sessions(spark, sf_dir):
    """Spans in which each tracker kept beating."""
    beats = V.view(spark, sf_dir, "logs").select("tracker_id", "ts")
    return T.heartbeat_sessions(beats, BEAT_TIMEOUT)


@query(
    "system_metrics",
    """select l_suppkey as host, l_shipdate as ts, avg(l_quantity) as cpu_usage,
              max(l_partkey * 1048576 + 5) // 1048576 as memory_usage_mb,
              max(case when l_linenumber % 2 = 0 then l_discount end) as "gpu-0_usage",
              max(case when l_linenumber % 2 = 1 then l_discount end) as "gpu-1_usage"
       from lineitem group by l_suppkey, l_shipdate""",
)
def system_metrics(spark, sf_dir):
    """System samples rolled up per host and time."""
    samples = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("host"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_quantity").alias("cpu_usage"),
        (F.col("l_partkey") * 1048576 + 5).alias("memory_bytes"),
        (F.col("l_linenumber") % 2).alias("gpu"),
        F.col("l_discount").alias("gpu_usage"),
    )
    return T.system_metrics(samples, [0, 1])


@query(
    "downsample",
    """select tracker_id, time_bucket(interval 1 hour, ts) as slot, max(ts) as ts,
              cast(arg_max(value, ts) as double) as value
       from {logs} group by tracker_id, time_bucket(interval 1 hour, ts)""",
)
def downsample(spark, sf_dir):
    """At most one record per tracker and hour, the newest."""
    logs = V.view(spark, sf_dir, "logs").select("tracker_id", "log_id", "ts", "value")
    kept = T.downsample(logs, 3600, ["tracker_id"], ["value"], "log_id")
    return kept.withColumn("value", F.col("value").cast("double"))


@query(
    "dedupe_retries",
    "select log_id, ts, tracker_id, cast(value as double) as value from {logs}",
)
def dedupe_retries(spark, sf_dir):
    """Every tenth record was sent twice; each is kept once."""
    logs = V.logs(spark, sf_dir)
    sent_again = logs.where(F.col("log_id").endswith("0"))
    kept = T.dedupe_retries(logs.unionByName(sent_again), ["tracker_id", "number", "text"])
    value = F.col("number")["value"].cast("double")
    return kept.select("log_id", "ts", "tracker_id", value.alias("value"))


@query(
    "node_latest",
    """select tracker_id as run_id, 'n' || cast(props_k as bigint) % 7 as id, max(ts) as ts,
              arg_max(event_type, ts) as status
       from {logs} group by all""",
)
def node_latest(spark, sf_dir):
    """Last state of every node of every run."""
    updates = V.view(spark, sf_dir, "logs").select(
        F.col("tracker_id").alias("run_id"),
        F.concat(F.lit("n"), F.col("props_k").cast("bigint") % 7).alias("id"),
        "ts",
        F.col("log_id").alias("seq"),
        F.col("event_type").alias("status"),
    )
    return T.node_latest(updates, ["status"])


@query(
    "read_json_log_lines",
    """select log_id, case when broken then null else upper(event_type) end as levelname,
              case when broken then null else ts end as timestamp,
              case when broken then null else cast(k as bigint) end as line,
              case when broken then null else cast(cast(value as float) as double) end as value, broken
       from (select event_id as log_id, event_type, ts, value, {J} as k,
                    event_type = 'click' as broken from events) e""",
)
def read_json_log_lines(spark, sf_dir):
    """JSON log lines made from the events and read back; clicks are cut short."""
    record = F.struct(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(
            "timestamp"
        ),
        F.upper("event_type").alias("levelname"),
        F.lit("jl1").alias("logtype"),
        F.concat(F.lit("event "), "event_id").alias("message"),
        F.struct(
            F.struct(
                F.lit("a.py").alias("file"),
                F.get_json_object("props", "$.k").cast("int").alias("line"),
            ).alias("code"),
            F.struct("value", F.col("event_id").alias("id")).alias("data"),
        ).alias("log"),
    )
    text = F.to_json(record)
    lines = V.table(spark, sf_dir, "events").select(
        F.when(
            F.col("event_type") == "click",
            F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(",")),
        )
        .otherwise(text)
        .alias("value")
    )
    path = scratch_path(spark, "log-lines")
    lines.write.text(path)
    read = S.read_json_log_lines(spark, path, "jl1")
    broken = F.col("_corrupt_record").isNotNull()
    return read.select(
        F.coalesce(
            F.try_variant_get("log.data", "$.id", "bigint"),
            F.regexp_extract("_corrupt_record", r"(\d+)", 1).try_cast("bigint"),
        ).alias("log_id"),
        "levelname",
        "timestamp",
        F.col("log.code.line").cast("bigint").alias("line"),
        F.try_variant_get("log.data", "$.value", "double").cast("float").cast("double").alias("value"),
        broken.alias("broken"),
    )


@query(
    "read_trace_jsonl",
    """select 'run' || user_id as run_id, event_id as seq, 'e' || event_id as id,
              event_type as name, cast({J} as varchar) as status from events""",
)
def read_trace_jsonl(spark, sf_dir):
    """Node updates parsed from JSON lines made from the events."""
    node = F.struct(
        F.concat(F.lit("e"), "event_id").alias("id"),
        F.col("event_type").alias("name"),
        F.get_json_object("props", "$.k").alias("status"),
    )
    lines = V.table(spark, sf_dir, "events").select(
        F.concat(F.lit("run"), "user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.to_json(node).alias("value"),
    )
    return S.parse_trace_lines(lines).drop("json")


@query(
    "system_metrics_full",
    """select 'h' || l_suppkey as host, l_shipdate as ts, avg(l_quantity) as cpu_usage,
              max(l_partkey * 1048576 + 5) // 1048576 as memory_usage_mb,
              max(l_orderkey * 1048576 + 1048575) // 1048576 as memory_available_mb,
              max(l_tax) as memory_percentage, max(l_discount) as disk_utilisation,
              max(case when l_linenumber = 1 then l_extendedprice end) as "gpu-1_usage",
              max(case when l_linenumber = 1 then l_partkey * 1048577 end) // 1048576
                  as "gpu-1_memory_available_mb",
              max(case when l_linenumber = 1 then l_orderkey * 1048577 end) // 1048576
                  as "gpu-1_memory_usage_mb"
       from lineitem group by l_suppkey, l_shipdate""",
)
def system_metrics_full(spark, sf_dir):
    """All host metrics and those of one GPU."""
    samples = V.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("h"), "l_suppkey").alias("host"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("cpu_usage"),
        (F.col("l_partkey") * 1048576 + 5).alias("memory_bytes"),
        (F.col("l_orderkey") * 1048576 + 1048575).alias("memory_available_bytes"),
        F.col("l_tax").alias("memory_percent"),
        F.col("l_discount").alias("disk_percent"),
        F.col("l_linenumber").alias("gpu"),
        F.col("l_extendedprice").alias("gpu_usage"),
        (F.col("l_partkey") * 1048577).alias("gpu_memory_free_bytes"),
        (F.col("l_orderkey") * 1048577).alias("gpu_memory_used_bytes"),
    )
    return T.system_metrics(samples, [1])
