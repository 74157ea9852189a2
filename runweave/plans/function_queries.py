"""Queries that put each column function over a whole table."""

from pyspark.sql import functions as F

from runweave.functions import fields, paths, schedule, text
from runweave.plans import views as V
from runweave.plans.registry import query


@query(
    "hash_item",
    """select doc_id, md5(text) as md5, sha1(text) as sha1, sha256(text) as sha256,
              md5(cast(n_chars as varchar)) as number_md5 from documents""",
)
def hash_item(spark, sf_dir):
    """Digests of whole texts and of numbers."""
    return V.table(spark, sf_dir, "documents").select(
        "doc_id",
        text.hash_item("text").alias("md5"),
        text.hash_item("text", "sha1").alias("sha1"),
        text.hash_item("text", "sha256").alias("sha256"),
        text.hash_item("n_chars").alias("number_md5"),
    )


@query("strip_path", "select doc_id, trim(text, './') as stripped from documents")
def strip_path(spark, sf_dir):
    """Whole texts without dots and slashes at their ends."""
    docs = V.table(spark, sf_dir, "documents")
    return docs.select("doc_id", paths.strip_path("text").alias("stripped"))


@query(
    "content_type",
    """select name, case lower(regexp_extract(name, '[^/.][^/]*(\\.[^./]*)$', 1))
                  when '.html' then 'text/html' when '.com' then 'application/x-com'
                  else 'application/octet-stream' end as content_type
       from (select name from {files} union all
             select regexp_extract(name, '^[^/]*') from {files}) f""",
)
def content_type(spark, sf_dir):
    """MIME type by extension, of the pages and of their hosts."""
    files = V.view(spark, sf_dir, "files")
    names = files.select("name").unionAll(files.select(F.regexp_extract("name", "^[^/]*", 0)))
    mime = {".html": "text/html", ".com": "application/x-com"}
    return names.select("name", paths.content_type("name", mime).alias("content_type"))


@query(
    "path_join",
    """select page_id, 'root/' || path as joined,
              case when contains(path, '/') then regexp_replace(path, '/[^/]*$', '') else '' end
                  as folder
       from (select page_id, regexp_replace(url, '^https?://', '') as path from pages) p""",
)
def path_join(spark, sf_dir):
    """Joined paths and their folders."""
    path = F.regexp_replace("url", "^https?://", "")
    return V.table(spark, sf_dir, "pages").select(
        "page_id",
        paths.path_join(F.lit("root"), path).alias("joined"),
        paths.parent_folder(path).alias("folder"),
    )


@query(
    "is_valid_uuid",
    """select doc_id, case doc_id % 4 when 0 then 'urn:uuid:' || md5(text)
                  when 1 then '{' || md5(text) || '}' when 2 then substr(md5(text), 2)
                  else text end as candidate, doc_id % 4 < 2 as valid
       from documents""",
)
def is_valid_uuid(spark, sf_dir):
    """UUIDs in several spellings, and texts that are none."""
    kind, digest = F.col("doc_id") % 4, F.md5("text")
    docs = V.table(spark, sf_dir, "documents").withColumn(
        "candidate",
        F.when(kind == 0, F.concat(F.lit("urn:uuid:"), digest))
        .when(kind == 1, F.concat(F.lit("{"), digest, F.lit("}")))
        .when(kind == 2, F.substring(digest, 2, 31))
        .otherwise(F.col("text")),
    )
    return docs.select("doc_id", "candidate", text.is_valid_uuid("candidate").alias("valid"))


@query(
    "to_b64",
    "select doc_id, base64(encode(text)) as encoded, text as decoded from documents",
)
def to_b64(spark, sf_dir):
    """Whole texts to base64 and back."""
    docs = V.table(spark, sf_dir, "documents").select(
        "doc_id", text.to_b64("text").alias("encoded")
    )
    return docs.withColumn("decoded", text.from_b64("encoded"))


@query(
    "to_json_text",
    """select event_id, cast({J} as bigint) as k, cast({J} as bigint) as k_variant, value,
              event_type from events""",
)
def to_json_text(spark, sf_dir):
    """JSON text to fields and back, through a struct and a variant."""
    events = V.table(spark, sf_dir, "events")
    packed = events.select(
        "event_id",
        "props",
        text.to_json_text(F.struct("value", "event_type")).alias("packed"),
    )
    opened = packed.select(
        "event_id",
        text.from_json_text("props", "k bigint").alias("a"),
        text.from_json_text("props").alias("b"),
        text.from_json_text("packed", "value double, event_type string").alias("c"),
    )
    return opened.select(
        "event_id",
        F.col("a.k").alias("k"),
        F.try_variant_get("b", "$.k", "bigint").alias("k_variant"),
        "c.value",
        "c.event_type",
    )


@query(
    "normalize_numbers",
    """select l_orderkey, l_linenumber, l_partkey,
              '{"quantity":' || cast(cast(l_quantity as bigint) as varchar) || ',"in":{"tax":'
              || case when l_tax = 0 then '0' else cast(l_tax as varchar) end || '}}' as json
       from lineitem""",
)
def normalize_numbers(spark, sf_dir):
    """Whole numbers of nested structs lose their decimals."""
    line = V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.struct(
            F.col("l_quantity").alias("quantity"), F.struct(F.col("l_tax").alias("tax")).alias("in")
        ).alias("s"),
    )
    normal = text.normalize_numbers("s", line.schema["s"].dataType)
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_json(normal).alias("json")
    )


@query(
    "epoch_convert",
    """select event_id, cast(floor(epoch_us(ts) / 1000000) as bigint) as seconds,
              epoch_us(ts) * 1000 as ns, date_trunc('second', ts) as whole, ts as again,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as time_text from events""",
)
def epoch_convert(spark, sf_dir):
    """Times to seconds, nanoseconds and text, and back."""
    ts = F.col("ts").cast("timestamp")
    return V.table(spark, sf_dir, "events").select(
        "event_id",
        text.time_to_epoch(ts).alias("seconds"),
        text.time_to_ns(ts).alias("ns"),
        text.epoch_to_time(text.time_to_epoch(ts)).alias("whole"),
        text.ns_to_time(text.time_to_ns(ts)).alias("again"),
        text.time_text(ts).alias("time_text"),
    )


def _nested_orders(spark, sf_dir):
    return V.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(
            F.struct(
                F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
                (F.col("o_custkey") % 3).alias("tries"),
            ).alias("run"),
            F.col("o_orderpriority").alias("priority"),
        ).alias("m"),
    )


@query(
    "get_field",
    """select o_orderkey, case when o_orderstatus <> 'P' then o_orderstatus else 'none' end
                  as status, o_custkey % 3 as tries, 'gone' as absent
       from orders""",
)
def get_field(spark, sf_dir):
    """Dotted look-ups with defaults."""
    df = _nested_orders(spark, sf_dir)
    return df.select(
        "o_orderkey",
        fields.get_field(df, "m.run.status", "none").alias("status"),
        fields.get_field(df, "m.run.tries").alias("tries"),
        fields.get_field(df, "m.run.nothing", "gone").alias("absent"),
    )


@query(
    "set_field",
    """select o_orderkey, 'fixed' as status, o_custkey % 3 as tries,
              'new' as deep, o_orderpriority as priority from orders""",
)
def set_field(spark, sf_dir):
    """Dotted writes, one below a parent that is created."""
    df = _nested_orders(spark, sf_dir)
    df = fields.set_field(df, "m.run.status", "fixed")
    df = fields.set_field(df, "m.extra.deep", "new")
    return df.select(
        "o_orderkey",
        "m.run.status",
        "m.run.tries",
        F.col("m.extra.deep").alias("deep"),
        "m.priority",
    )


@query(
    "set_default",
    """select o_orderkey, case when o_orderstatus = 'P' then 'unset' else o_orderstatus end
                  as status,
              case when o_custkey % 3 = 0 then 9 else o_custkey % 3 end as tries from orders""",
)
def set_default(spark, sf_dir):
    """Null and zero are replaced by defaults."""
    df = fields.set_default(_nested_orders(spark, sf_dir), "m.run.status", "unset")
    df = fields.set_default(df, "m.run.tries", F.lit(9).cast("bigint"))
    return df.select("o_orderkey", "m.run.status", "m.run.tries")


@query(
    "scrub_tokens",
    """select page_id, case when page_id % 2 = 0 then 'https://github.com/' || url
                  else 'https://ghp_' || page_id || '@' || url end as clean
       from pages""",
)
def scrub_tokens(spark, sf_dir):
    """Tokens leave URLs of the one host and stay in others."""
    even = F.col("page_id") % 2 == 0
    remote = F.concat(
        F.lit("https://ghp_"),
        "page_id",
        F.lit("@"),
        F.when(even, "github.com/").otherwise(""),
        "url",
    )
    return V.table(spark, sf_dir, "pages").select(
        "page_id", text.scrub_tokens(remote).alias("clean")
    )


@query(
    "round_sig4",
    """select l_orderkey, l_linenumber, l_partkey,
              cast(format('{:.3e}', l_extendedprice) as double) as price,
              cast(format('{:.3e}', l_discount / 7) as double) as ratio from lineitem""",
)
def round_sig4(spark, sf_dir):
    """Prices and ratios to four significant digits."""
    return V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        text.round_sig4("l_extendedprice").alias("price"),
        text.round_sig4(F.col("l_discount") / 7).alias("ratio"),
    )


@query(
    "log_headline",
    """select conv_id, turn, case when contains(body, chr(10))
                  then left(split_part(body, chr(10), 1), 10) || '...' else body end as headline,
              len(body) - len(replace(body, chr(10), '')) + 1 as lines
       from (select conv_id, turn, regexp_replace(text, '\\n$', '') as body
             from conversations) c""",
)
def log_headline(spark, sf_dir):
    """Headlines of whole messages."""
    return V.table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        text.log_headline("text").alias("headline"),
        F.size(text.message_lines("text")).cast("bigint").alias("lines"),
    )


@query(
    "envelope",
    """select event_id, '{"id":"e' || event_id || '","out":' || props || '}' as body
       from events""",
)
def envelope(spark, sf_dir):
    """JSON bodies in their envelope."""
    return V.table(spark, sf_dir, "events").select(
        "event_id",
        text.envelope(F.concat(F.lit("e"), "event_id"), "props").alias("body"),
    )


def _schedules(spark, sf_dir):
    key = F.col("c_custkey")
    names = F.array(F.lit("mon"), F.lit("sat"))
    start = F.timestamp_seconds(F.lit(820488600) + (key % 700) * 86400)
    return V.table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.when(key % 3 != 2, key % 26).cast("int").alias("hour"),
        F.when(key % 3 == 0, key % 61).when(key % 3 == 2, key % 1500).cast("int").alias("minute"),
        F.when(key % 2 == 0, names)
        .when(key % 11 == 0, F.array(F.lit("day")))
        .otherwise(F.array().cast("array<string>"))
        .alias("days"),
        F.when(key % 5 == 0, F.array(F.lit("jan"), F.lit("dec")))
        .otherwise(F.array().cast("array<string>"))
        .alias("months"),
        start.alias("starts"),
        F.lit(None).cast("timestamp").alias("ends"),
    )


DUCK_SCHEDULES = """
    select c_custkey as id, cast(case when c_custkey % 3 <> 2 then c_custkey % 26 end as int)
               as hour,
           cast(case when c_custkey % 3 = 0 then c_custkey % 61
                     when c_custkey % 3 = 2 then c_custkey % 1500 end as int) as minute,
           c_custkey % 2 = 0 as some_days, c_custkey % 2 <> 0 and c_custkey % 11 = 0 as bad_day,
           c_custkey % 5 = 0 as some_months,
           timestamp '1996-01-01 09:30:00' + to_days(cast(c_custkey % 700 as int)) as starts,
           timestamp '1996-01-08 09:30:00' + to_days(cast(c_custkey % 700 as int)) as ends
    from customer"""
DUCK_VALID = """(not bad_day and case when hour is not null and minute is not null
        then hour between 0 and 23 and minute between 0 and 59
        when hour is not null then hour between 0 and 23
        else minute // 60 between 0 and 23 end)"""


@query(
    "cron_expr",
    f"""select id, case when not {DUCK_VALID} then null
                when hour is not null and minute is not null then
                    minute || ' ' || hour || ' * ' || case when some_months then '1,12' else '*' end
                    || ' ' || case when some_days then '1,6' else '*' end
                when hour is not null then '0 */' || hour || ' * * *'
                else '*/' || minute % 60 || ' ' || case when minute // 60 > 0
                    then '*/' || minute // 60 else '*' end || ' * * *' end as cron
        from ({DUCK_SCHEDULES}) s""",
)
def cron_expr(spark, sf_dir):
    """Cron text of fixed, hourly and minutely schedules, some invalid."""
    cron = schedule.cron_expr(F.col("hour"), F.col("minute"), F.col("days"), F.col("months"))
    return _schedules(spark, sf_dir).select("id", cron.alias("cron"))


@query(
    "schedule_fire_times",
    f"""with s as (select * from ({DUCK_SCHEDULES}) x where {DUCK_VALID}),
             d as (select s.*, unnest(generate_series(cast(starts as date), cast(ends as date),
                       interval 1 day)) as day from s),
             h as (select d.*, unnest(case
                       when hour is not null and minute is not null then [hour]
                       when hour is not null then [x for x in range(24) if hour > 0
                           and x % greatest(hour, 1) = 0]
                       when minute // 60 > 0 then [x for x in range(24)
                           if x % greatest(minute // 60, 1) = 0]
                       else range(24) end) as h
                   from d
                   where not (hour is not null and minute is not null)
                      or ((not some_days or dayofweek(day) in (1, 6))
                          and (not some_months or month(day) in (1, 12)))),
             m as (select h.*, unnest(case
                       when hour is not null and minute is not null then [minute]
                       when hour is not null then [0]
                       else [x for x in range(60) if minute % 60 > 0
                           and x % greatest(minute % 60, 1) = 0] end) as m from h)
        select id, day + to_hours(cast(h as bigint)) + to_minutes(cast(m as bigint)) as fire_at
        from m where day + to_hours(cast(h as bigint)) + to_minutes(cast(m as bigint))
                     between starts and ends""",
)
def schedule_fire_times(spark, sf_dir):
    """Every fire time of a week of each schedule."""
    return schedule.schedule_fire_times(_schedules(spark, sf_dir))


@query(
    "resolve_resource",
    """select c_custkey, case when c_custkey % 3 = 0 then '2' when c_custkey % 3 = 1 then '4'
                  else '128m' end as cpu,
              case when c_nationkey <> 0 then c_nationkey when c_custkey % 5 <> 0
                  then c_custkey % 5 else 2 end as max_retries
       from customer""",
)
def resolve_resource(spark, sf_dir):
    """Resources from user, store and defaults."""
    key = F.col("c_custkey")
    df = V.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 3 == 0, "2").otherwise("").alias("user_cpu"),
        F.when(key % 3 == 1, "4").alias("stored_cpu"),
        F.col("c_nationkey").alias("user_retries"),
        (key % 5).alias("stored_retries"),
    )
    return df.select(
        "c_custkey",
        text.resolve_resource("user_cpu", "stored_cpu", "128m").alias("cpu"),
        text.resolve_resource("user_retries", "stored_retries", 2).alias("max_retries"),
    )


@query(
    "merge_kwargs",
    """select o_orderkey, case when o_orderkey % 2 = 0 then o_orderstatus else 'x' end as a,
              o_orderpriority as b, case when o_orderkey % 3 = 0 then null else 'z' end as c
       from orders""",
)
def merge_kwargs(spark, sf_dir):
    """Defaults overlaid by passed values; a passed null stays."""
    key = F.col("o_orderkey")
    passed = F.map_concat(
        F.create_map(F.lit("b"), F.col("o_orderpriority")),
        F.when(key % 2 == 0, F.create_map(F.lit("a"), F.col("o_orderstatus"))).otherwise(
            F.create_map().cast("map<string,string>")
        ),
        F.when(
            key % 3 == 0, F.create_map(F.lit("c"), F.lit(None).cast("string"))
        ).otherwise(F.create_map().cast("map<string,string>")),
    )
    defaults = F.create_map(
        F.lit("a"), F.lit("x"), F.lit("b"), F.lit("y"), F.lit("c"), F.lit("z")
    )
    merged = V.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.merge_kwargs(defaults, passed).alias("m")
    )
    return merged.select(
        "o_orderkey",
        F.col("m")["a"].alias("a"),
        F.col("m")["b"].alias("b"),
        F.col("m")["c"].alias("c"),
    )
