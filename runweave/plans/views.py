"""The data model's tables as views over the test tables.

Each view is one SQL text that runs in both engines once ``{J}``, ``{US}`` and ``{B}`` are filled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_WORDS = {
    "J": "get_json_object(props,'$.k')",
    "US": "unix_micros(cast(ts as timestamp))",
    "B": "octet_length(html)",
}
DUCKDB_WORDS = {
    "J": "json_extract_string(props,'$.k')",
    "US": "epoch_us(ts)",
    "B": "strlen(html)",
}

VIEWS = {
    "logs": """
        select concat('p', cast(user_id % 5 as string)) project_id,
               concat('t', cast(user_id as string)) tracker_id,
               concat('l', cast(event_id as string)) log_id, ts,
               cast(value as float) value, cast({J} as float) as props_k, event_type
        from events""",
    "trackers": """
        select concat('t', cast(c_custkey as string)) id,
               concat('p', cast(c_custkey % 5 as string)) project_id,
               case when c_acctbal < 0 then 2 else 1 end tracker_type,
               c_nationkey % 3 as agent_type,
               concat('g', cast(c_nationkey as string)) group_id,
               'run' || cast(k as string) instance_id, created_at, updated_at,
               case st when 'F' then 2 when 'O' then 1 when 'P' then 3 else 0 end status,
               concat('en/', cast(c_custkey % 100 as string)) save_location
        from customer left join (
            select o_custkey, min(o_orderdate) created_at, max(o_orderdate) updated_at,
                   max_by(o_orderstatus, o_orderkey) st, max(o_orderkey) k
            from orders group by o_custkey) o on c_custkey = o_custkey""",
    "runs": """
        select concat('run', cast(o_orderkey as string)) run_id,
               concat('g', cast(c_nationkey as string)) job_id, o_orderdate created_at,
               case o_orderstatus when 'F' then 'COMPLETED' when 'P' then 'ERROR'
                    else 'RUNNING' end status,
               cast(substr(o_orderpriority, 1, 1) as int) % 3 as retry_count,
               2 as max_retries,
               case o_orderstatus when 'F' then 0 when 'P' then 1 end exit_code
        from orders join customer on o_custkey = c_custkey""",
    "files": """
        select concat('r', cast(page_id % 5 as string)) relic_id,
               regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') as name,
               {B} as size, 1 as type
        from pages""",
    "activity": """
        select {US} * 1000 as timestamp_ns, concat('r', cast(user_id % 5 as string)) relic_id,
               case event_type when 'signup' then 1 when 'purchase' then 2
                    when 'error' then 3 else 0 end operation,
               cast(value as float) object_size,
               concat('u', cast(user_id as string)) username,
               concat('o', cast(event_id as string)) object_name
        from events""",
    "requests": """
        select concat('l', cast(event_id as string)) id, 'http' as type,
               case event_type when 'view' then '/' when 'signup' then '/metadata'
                    when 'purchase' then concat('/item/', {J}, '/buy')
                    else concat('/item/', {J}) end path,
               cast(round(value * 1000000) as bigint) latency_ns,
               event_type = 'error' as failed, ts
        from events""",
    "machines": """
        select lower(concat(replace(p_brand, '#', '_'), '.p', cast(p_partkey as string))) name,
               p_size as cpu, p_retailprice as memory
        from part""",
    "notebooks": """
        select conv_id nb, turn cell,
               case role when 'assistant' then 'code' else 'markdown' end cell_type,
               text as source
        from conversations""",
    "versions": """
        select p_type as package,
               concat(cast(p_size as string), '.', cast(p_partkey % 10 as string), '.',
                      cast(p_partkey as string),
                      case when p_partkey % 4 = 0 then 'rc1' else '' end) version
        from part""",
    "spans": """
        select cast(floor(o_orderkey / 4) as bigint) thread, o_orderkey region, e.kind,
               timestamp '2024-01-01 00:00:00' + (o_orderkey % 4) * interval '1' hour
                   + e.sec * interval '1' second ts
        from orders cross join
            (values ('ENTER', 0), ('ENTER', 1), ('LEAVE', 30), ('LEAVE', 60)) e(kind, sec)""",
    "projects": """
        select concat('p', cast(r_regionkey as string)) id, r_name as name,
               concat('r', cast(r_regionkey as string)) relic_id
        from region""",
    "jobs": """
        select concat('g', cast(n_nationkey as string)) id, n_name as name,
               n_nationkey % 24 as hour,
               case when n_nationkey % 7 = 0 then 2 else 1 end status
        from nation""",
}

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _fill(text: str, words: dict[str, str]) -> str:
    for name, value in words.items():
        text = text.replace("{" + name + "}", value)
    return text


def duckdb_sql(text: str) -> str:
    """Replace each ``{view}`` of an oracle query by its subquery."""
    for name, body in VIEWS.items():
        text = text.replace("{" + name + "}", f"({_fill(body, DUCKDB_WORDS)})")
    return _fill(text, DUCKDB_WORDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view of the data model; timestamps are instants in UTC."""
    if name == "spans":
        return _spans(table(spark, sf_dir, "orders"))
    return spark_sql(spark, sf_dir, VIEWS[name])


def _spans(orders: DataFrame) -> DataFrame:
    """The spans view without its cross join: each order opens into its four events."""
    events = [("ENTER", 0), ("ENTER", 1), ("LEAVE", 30), ("LEAVE", 60)]
    four = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.lit(s).alias("sec")) for k, s in events]
    )
    start = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    key = F.col("o_orderkey")
    return orders.select(key, F.inline(four)).select(
        F.floor(key / 4).alias("thread"),
        key.alias("region"),
        "kind",
        F.timestamp_seconds(start + (key % 4) * 3600 + F.col("sec")).alias("ts"),
    )


def spark_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run SQL whose ``from``/``join`` names are base tables or ``{view}`` names."""
    for name, body in VIEWS.items():
        text = text.replace("{" + name + "}", f"({body})")
    text = _fill(text, SPARK_WORDS)
    used = {n for n in BASE if re.search(rf"\b{n}\b", text)}
    for name in used:
        text = re.sub(rf"\b(from|join)\s+{name}\b", rf"\1 {{{name}}}", text)
    tables = {n: table(spark, sf_dir, n) for n in used if "{" + n + "}" in text}
    df = spark.sql(text, **tables)
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOGS: one record per event, numbers and texts in maps."""
    flat = view(spark, sf_dir, "logs")
    return flat.select(
        "project_id",
        "tracker_id",
        "log_id",
        "ts",
        F.create_map(
            F.lit("value"), F.col("value"), F.lit("props.k"), F.col("props_k")
        ).alias("number"),
        F.create_map(F.lit("event_type"), F.col("event_type")).alias("text"),
    )
