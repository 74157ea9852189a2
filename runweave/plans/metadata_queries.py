"""Queries over projects, trackers, jobs and runs."""

from datetime import datetime

from pyspark.sql import functions as F

from runweave.operators import paging as P
from runweave.operators import rule_index as RI
from runweave.operators import rules as R
from runweave.operators import runs as N
from runweave.operators import trackers as K
from runweave.plans import views as V
from runweave.plans.registry import query

JOB_STATUS = {0: "NOT_SET", 1: "ACTIVE", 2: "ARCHIVED"}
ARCHIVED = 2


@query(
    "list_trackers",
    """select id, project_id, tracker_type, status, created_at, updated_at from {trackers}
       where tracker_type = 1 and status = 2 and created_at > timestamp '1995-02-01 00:00:00'""",
)
def list_trackers(spark, sf_dir):
    """Completed experiment trackers created after a day."""
    found = K.list_trackers(
        V.view(spark, sf_dir, "trackers"), status=2, created_after=datetime(1995, 2, 1)
    )
    return found.select("id", "project_id", "tracker_type", "status", "created_at", "updated_at")


@query(
    "list_projects",
    """select id, name, relic_id, trackers from {projects} p
       join (select project_id, count(*) as trackers from {trackers} group by project_id) t
         on p.id = t.project_id
       where id = 'ASIA' or name = 'ASIA'""",
)
def list_projects(spark, sf_dir):
    """One project by its name, with its number of trackers."""
    counts = (
        V.view(spark, sf_dir, "trackers")
        .groupBy(F.col("project_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("trackers"))
    )
    return K.list_projects(V.view(spark, sf_dir, "projects"), "ASIA").join(counts, "id")


@query(
    "project_counters",
    """select p.id as project_id,
              cast(coalesce(sum(case when tracker_type = 1 then 1 end), 0) as bigint) total_runs,
              cast(coalesce(sum(case when tracker_type = 2 then 1 end), 0) as bigint)
                  total_servings,
              cast(coalesce(sum(case when tracker_type = 1 and status = 1 then 1 end), 0)
                  as bigint) runs_counter,
              cast(coalesce(sum(case when tracker_type = 2 and status = 1 then 1 end), 0)
                  as bigint) live_counter
       from {projects} p left join {trackers} t on p.id = t.project_id group by p.id""",
)
def project_counters(spark, sf_dir):
    """Runs and servings per project, in all and active."""
    return K.project_counters(
        V.view(spark, sf_dir, "projects").select("id"), V.view(spark, sf_dir, "trackers")
    )


@query(
    "tracker_status",
    """select id as tracker_id,
              case when t.status = 3 then 3 when t.status = 2 then 2
                   when l.tracker_id is not null then 1 else 0 end as status
       from {trackers} t left join (select distinct tracker_id from {logs}) l
         on t.id = l.tracker_id""",
)
def tracker_status(spark, sf_dir):
    """Status from creation, log, end and failure events."""
    trackers = V.view(spark, sf_dir, "trackers")
    kinds = F.array_compact(
        F.array(
            F.lit("created"),
            F.when(F.col("status") == 2, "end"),
            F.when(F.col("status") == 3, "failed"),
        )
    )
    events = trackers.select(F.col("id").alias("tracker_id"), F.explode(kinds).alias("kind"))
    logged = V.view(spark, sf_dir, "logs").select("tracker_id", F.lit("log").alias("kind"))
    return K.tracker_status(events.unionByName(logged))


@query(
    "tracker_agent_runs",
    """select t.id, t.agent_type, case when agent_type = 1 then r.status
              when agent_type = 2 then concat('model of ', r.status) end as agent_status
       from {trackers} t left join {runs} r
         on t.group_id = r.job_id and t.instance_id = r.run_id""",
)
def tracker_agent_runs(spark, sf_dir):
    """The job run or served model behind each tracker."""
    runs = V.view(spark, sf_dir, "runs")
    models = runs.select(
        F.col("job_id").alias("deployment_id"),
        F.col("run_id").alias("model_id"),
        F.concat(F.lit("model of "), "status").alias("status"),
    )
    found = K.tracker_agent_runs(V.view(spark, sf_dir, "trackers"), runs, models)
    return found.select("id", "agent_type", "agent_status")


@query(
    "project_artifacts",
    """with f as (select relic_id, regexp_replace(name, '^[^/]*/', '') as name, size from {files})
       select t.id as tracker_id, f.relic_id, f.name, f.size
       from {trackers} t join {projects} p on t.project_id = p.id
       join f on f.relic_id = p.relic_id
         and (f.name = save_location or starts_with(f.name, concat(save_location, '/')))""",
)
def project_artifacts(spark, sf_dir):
    """Files under each tracker's save location in its project's store."""
    files = V.view(spark, sf_dir, "files").withColumn(
        "name", F.regexp_replace("name", "^[^/]*/", "")
    )
    found = K.project_artifacts(
        V.view(spark, sf_dir, "projects"), V.view(spark, sf_dir, "trackers"), files
    )
    return found.select("tracker_id", "relic_id", "name", "size")


@query(
    "page_offset",
    """select id, created_at from {trackers}
       order by created_at nulls last, id limit 50 offset 100""",
)
def page_offset(spark, sf_dir):
    """Rows 100 to 150 of all trackers by creation time, those without one at the end."""
    order = [F.asc_nulls_last("created_at"), "id"]
    page = P.page_offset(V.view(spark, sf_dir, "trackers"), order, 100, 50)
    return page.select("id", "created_at")


@query(
    "page_no",
    """select run_id, job_id, created_at from {runs}
       order by created_at desc, run_id desc limit 25 offset 50""",
)
def page_no(spark, sf_dir):
    """The third page of the runs, newest first."""
    order = [F.desc("created_at"), F.desc("run_id")]
    page = P.page_no(V.view(spark, sf_dir, "runs"), order, page=3, size=25)
    return page.select("run_id", "job_id", "created_at")


@query(
    "page_after",
    """select run_id, created_at from {runs}
       where created_at > timestamp '1996-06-01 00:00:00'
          or (created_at = timestamp '1996-06-01 00:00:00' and run_id > 'run5')
       order by created_at, run_id limit 40""",
)
def page_after(spark, sf_dir):
    """The page of runs that follows a given key."""
    runs = V.view(spark, sf_dir, "runs").select("run_id", "created_at")
    return P.page_after(runs, ["created_at", "run_id"], [datetime(1996, 6, 1), "run5"], 40)


@query(
    "page_totals",
    """select count(*) as total, cast(ceil(count(*) / 20.0) as bigint) as total_pages
       from {files}""",
)
def page_totals(spark, sf_dir):
    """Number of files and of pages of 20."""
    return P.page_totals(V.view(spark, sf_dir, "files"), 20)


@query("sort_listing", "select id, name, hour, status from {jobs} order by name, id")
def sort_listing(spark, sf_dir):
    """Jobs by name."""
    return P.sort_listing(V.view(spark, sf_dir, "jobs"), "name", "id")


@query(
    "last_n_runs",
    """select job_id, run_id, status, created_at, position from (
           select *, row_number() over (partition by job_id
               order by created_at desc, run_id desc) as position from {runs}) r
       where position <= 10""",
)
def last_n_runs(spark, sf_dir):
    """The ten newest runs of every job."""
    newest = N.last_n_runs(V.view(spark, sf_dir, "runs"), 10)
    return newest.select("job_id", "run_id", "status", "created_at", "position")


@query(
    "decode_status",
    """select run_id, job_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at,
              case code when 0 then 'NOT_SET' when 1 then 'ACTIVE' else 'ARCHIVED' end as status
       from (select *, retry_count as code from {runs}) r""",
)
def decode_status(spark, sf_dir):
    """Status numbers as names and times as text."""
    runs = V.view(spark, sf_dir, "runs").select(
        "run_id",
        "job_id",
        F.unix_seconds("created_at").alias("created_at"),
        F.col("retry_count").alias("status"),
    )
    return N.decode_status(runs, JOB_STATUS)


@query(
    "run_outcome",
    """with a as (select concat('run', cast(l_orderkey as string)) as run_id,
                   l_linenumber - 1 as retry_count, cast(l_quantity as int) * 15 as polls,
                   case l_returnflag when 'A' then 'ERROR' when 'R' then 'COMPLETED'
                        else 'RUNNING' end as status
               from lineitem)
       select run_id, max(retry_count) as retry_count,
              case when bool_or(status = 'COMPLETED') then 'COMPLETED'
                   when bool_or(status = 'ERROR' and retry_count = 2) then 'ERROR'
                   when bool_or(polls > 600) then 'TIMEOUT' else 'PENDING' end as outcome
       from a group by run_id""",
)
def run_outcome(spark, sf_dir):
    """Final state of each run; its attempts are the lines of an order."""
    line = V.table(spark, sf_dir, "lineitem")
    attempts = line.select(
        F.concat(F.lit("run"), "l_orderkey").alias("run_id"),
        F.when(F.col("l_returnflag") == "A", "ERROR")
        .when(F.col("l_returnflag") == "R", "COMPLETED")
        .otherwise("RUNNING")
        .alias("status"),
        (F.col("l_linenumber") - 1).alias("retry_count"),
        F.lit(2).alias("max_retries"),
        (F.col("l_quantity").cast("int") * 15).alias("polls"),
    )
    return N.run_outcome(attempts)


@query(
    "map_progress",
    """select job_id, count(*) as total, count(*) filter (where exit_code = 0) as success,
              count(*) filter (where exit_code <> 0) as errored, count(exit_code) as completed
       from {runs} group by job_id""",
)
def map_progress(spark, sf_dir):
    """Totals by exit code, per job."""
    return N.map_progress(V.view(spark, sf_dir, "runs"), ["job_id"])


@query(
    "runs_in_invocation",
    """select run_id, status from {runs}
       where run_id in (select instance_id from {trackers} where agent_type = 1)""",
)
def runs_in_invocation(spark, sf_dir):
    """Runs named by the trackers of jobs."""
    named = V.view(spark, sf_dir, "trackers").where(F.col("agent_type") == 1)
    ids = named.select(F.col("instance_id").alias("run_id"))
    return N.runs_in_invocation(V.view(spark, sf_dir, "runs"), ids).select("run_id", "status")


def _tags(spark, sf_dir):
    return V.view(spark, sf_dir, "runs").select(
        "run_id", "job_id", F.concat("job_id", F.lit("/return_"), "run_id").alias("output")
    )


def _outputs(spark, sf_dir):
    done = V.view(spark, sf_dir, "runs").where(F.col("status") == "COMPLETED")
    return done.select(
        F.concat("job_id", F.lit("/return_"), "run_id").alias("name"),
        F.concat(F.lit("result of "), "run_id").alias("value"),
        F.col("run_id").alias("tag"),
    )


@query(
    "outputs_ready",
    """select run_id, concat(job_id, '/return_', run_id) as output,
              case when status = 'COMPLETED' then 1 else 0 end as output_found from {runs}""",
)
def outputs_ready(spark, sf_dir):
    """Does the output object of each run exist?"""
    ready = N.outputs_ready(_tags(spark, sf_dir), _outputs(spark, sf_dir))
    return ready.select("run_id", "output", "output_found")


@query(
    "all_outputs_ready",
    """select job_id, count(*) as outputs,
              cast(sum(case when status = 'COMPLETED' then 1 else 0 end) as bigint) as found,
              bool_and(status = 'COMPLETED') as all_ready
       from {runs} group by job_id""",
)
def all_outputs_ready(spark, sf_dir):
    """Are all outputs of a job there?"""
    ready = N.outputs_ready(_tags(spark, sf_dir), _outputs(spark, sf_dir))
    return N.all_outputs_ready(ready, ["job_id"])


@query(
    "ordered_collect",
    """select input_idx, tag, concat('result of ', tag) as value
       from (select *, row_number() over (order by created_at, run_id) as n from {runs}) r
       join (select concat('run', cast(o_orderkey as varchar)) tag, o_orderkey as input_idx
             from orders) o on r.run_id = o.tag
       where status = 'COMPLETED'""",
)
def ordered_collect(spark, sf_dir):
    """Outputs in input order."""
    inputs = V.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run"), "o_orderkey").alias("tag"), F.col("o_orderkey").alias("input_idx")
    )
    outputs = _outputs(spark, sf_dir).select("tag", "value")
    return N.ordered_collect(inputs, outputs)


@query(
    "resolve_refs",
    """with refs as (
           select o_orderkey as ref_id,
                  case when o_orderkey % 5 in (0, 3) then concat('g',
                       cast(o_orderkey % 30 as varchar)) else '' end as id,
                  case when o_orderkey % 5 in (1, 2, 3) then concat('NATION_',
                       cast(o_orderkey % 30 as varchar)) else '' end as name
           from orders),
       hits as (select ref_id, r.id, r.name, j.id as hit_id, j.name as hit_name, j.status
                from refs r left join {jobs} j
                  on ((r.id <> '') <> (r.name <> ''))
                     and ((r.id <> '' and r.id = j.id) or (r.name <> '' and r.name = j.name)))
       select ref_id, id, name, case when status <> 2 then hit_id end as resolved_id,
              hit_name as resolved_name,
              case when (id <> '') = (name <> '') then 'invalid'
                   when hit_id is null then 'missing' end as problem
       from hits""",
)
def resolve_refs(spark, sf_dir):
    """References by id, by name, by both and by none, resolved to jobs."""
    key = F.col("o_orderkey")
    refs = V.table(spark, sf_dir, "orders").select(
        key.alias("ref_id"),
        F.when((key % 5).isin(0, 3), F.concat(F.lit("g"), key % 30)).otherwise("").alias("id"),
        F.when((key % 5).isin(1, 2, 3), F.concat(F.lit("NATION_"), key % 30))
        .otherwise("")
        .alias("name"),
    )
    return N.resolve_refs(refs, V.view(spark, sf_dir, "jobs"), ARCHIVED)


@query(
    "pinned_model",
    """select j.id, j.name, 'm' || cast(c_custkey as varchar) as pinned_id,
              c_name as pinned_name,
              strftime(first_order, '%Y-%m-%d %H:%M:%S') as pinned_last_updated
       from {jobs} j left join (
           select c_nationkey, arg_min(struct_pack(c_custkey, c_name, first_order), c_custkey) m,
                  min(c_custkey) as k
           from (select c_custkey, c_name, c_nationkey, min(o_orderdate) as first_order
                 from customer join orders on o_custkey = c_custkey
                 where c_nationkey <> 3 group by all) c
           group by c_nationkey) x on j.id = concat('g', cast(x.c_nationkey as varchar))
       cross join lateral (select x.m.c_custkey as c_custkey, x.m.c_name as c_name,
                                  x.m.first_order as first_order) y""",
)
def pinned_model(spark, sf_dir):
    """Each serving with its first model."""
    first_order = (
        V.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").cast("timestamp").alias("model_created_at"))
    )
    models = (
        V.table(spark, sf_dir, "customer")
        .where(F.col("c_nationkey") != 3)
        .join(first_order, "c_custkey")
        .select(
            F.concat(F.lit("g"), "c_nationkey").alias("serving_id"),
            F.col("c_custkey").alias("position"),
            F.concat(F.lit("m"), "c_custkey").alias("model_id"),
            F.col("c_name").alias("model_name"),
            "model_created_at",
        )
    )
    return N.pinned_model(V.view(spark, sf_dir, "jobs").select("id", "name"), models)


@query(
    "machine_lookup",
    """with refs as (
           select l_orderkey, l_linenumber, l_partkey,
                  concat('BRAND_', cast(l_partkey % 25 + 1 as varchar),
                         case when l_returnflag = 'A' then '-P' else '.P' end,
                         cast(l_partkey as varchar)) as machine
           from lineitem)
       select l_orderkey, l_linenumber, l_partkey, machine, cpu, memory,
              case when not regexp_full_match(machine, '\\w+\\.\\w+') then 'invalid'
                   when cpu is null then 'unknown' end as problem
       from refs left join {machines} m on lower(machine) = m.name""",
)
def machine_lookup(spark, sf_dir):
    """Machine names of every order line: known, unknown and malformed."""
    part = F.col("l_partkey")
    refs = V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.concat(
            F.lit("BRAND_"),
            part % 25 + 1,
            F.when(F.col("l_returnflag") == "A", "-P").otherwise(".P"),
            part,
        ).alias("machine"),
    )
    return N.machine_lookup(refs, V.view(spark, sf_dir, "machines"))


@query(
    "checkpoint_location",
    """with r as (
           select run_id, case when status <> 'RUNNING' then concat('ck-', run_id) end as checkpoint,
                  status from {runs})
       select run_id as experiment_id, checkpoint,
              case when checkpoint is not null then concat(run_id, '/', checkpoint) end as path,
              coalesce(status = 'COMPLETED', false) as exists,
              case when checkpoint is null then 'missing' end as problem
       from r""",
)
def checkpoint_location(spark, sf_dir):
    """Newest checkpoint of each run; only completed runs have the file."""
    runs = V.view(spark, sf_dir, "runs")
    name = F.concat(F.lit("ck-"), "run_id")
    configured = runs.select(
        F.col("run_id").alias("experiment_id"),
        F.to_json(
            F.struct(F.when(F.col("status") != "RUNNING", name).alias("latest_checkpoint"))
        ).alias("config"),
    )
    files = runs.where(F.col("status") == "COMPLETED").select(
        F.concat("run_id", F.lit("/"), name).alias("name")
    )
    return N.checkpoint_location(configured, files)


# Rules of the test: (id, logic). The same conditions stand in the SQL twin.
RULES = [
    ("slow", {">": [{"var": "value"}, 150]}),
    ("bad", {"and": [{"==": [{"var": "event_type"}, "error"]}, {"<=": [{"var": "props.k"}, 10]}]}),
    ("watch", {"or": [{"in": [{"var": "props.k"}, [1, 2, 3]]}, {"==": [{"var": "tracker_id"}, "t7"]}]}),
    ("quiet", {"!": [{"!=": [{"var": "event_type"}, "view"]}]}),
]


@query(
    "rule_eval",
    """select 'slow' as rule_id, log_id from {logs} where value > 150
       union all select 'bad', log_id from {logs} where event_type = 'error' and props_k <= 10
       union all select 'watch', log_id from {logs}
                 where props_k in (1, 2, 3) or tracker_id = 't7'
       union all select 'quiet', log_id from {logs} where event_type = 'view'""",
)
def rule_eval(spark, sf_dir):
    """Hits of four rules over all records."""
    return R.rule_eval(V.logs(spark, sf_dir), RULES)


@query(
    "match_rules",
    """select concat('rule', cast(p_partkey as varchar)) as rule_id, log_id
       from {logs} join part on tracker_id = concat('t', cast(p_partkey % 997 as varchar))
       where (value > 4 * p_size or event_type in ('error', 'click')) and not props_k = p_size""",
)
def match_rules(spark, sf_dir):
    """A rule a part, all of them matched with all records by counting."""
    rules = V.table(spark, sf_dir, "part").select(
        F.concat(F.lit("rule"), "p_partkey").alias("rule_id"),
        F.format_string(
            '{"and":[{"==":[{"var":"tracker_id"},"t%d"]},'
            '{"or":[{">":[{"var":"value"},%d]},{"in":[{"var":"event_type"},["error","click"]]}]},'
            '{"!":{"==":[{"var":"props.k"},%d]}}]}',
            F.col("p_partkey").cast("bigint") % 997,
            F.col("p_size").cast("bigint") * 4,
            F.col("p_size").cast("bigint"),
        ).alias("logic"),
    )
    return RI.match_rules(V.logs(spark, sf_dir), rules)


@query(
    "active_rules",
    """select concat('rule', cast(p_partkey as varchar)) as id,
              concat('p', cast(p_size % 5 as varchar)) as project_id, p_name as rule_name
       from part where p_brand <> 'Brand#7' and p_size % 5 = 1""",
)
def active_rules(spark, sf_dir):
    """Rules in force of one project."""
    rules = V.table(spark, sf_dir, "part").select(
        F.concat(F.lit("rule"), "p_partkey").alias("id"),
        F.concat(F.lit("p"), F.col("p_size") % 5).alias("project_id"),
        F.col("p_name").alias("rule_name"),
        (F.col("p_brand") == "Brand#7").alias("is_deactivated"),
    )
    return R.active_rules(rules, "p1").drop("is_deactivated")


@query(
    "list_rules",
    """select id, project_id, rule_name, is_deactivated from (
           select 'rule' || p_partkey as id, 'p' || p_size % 5 as project_id, p_name as rule_name,
                  p_brand = 'Brand#7' as is_deactivated,
                  row_number() over (order by p_name, 'rule' || p_partkey) as n
           from part where p_size % 5 = 2) r where n > 10 and n <= 20""",
)
def list_rules(spark, sf_dir):
    """Second page of one project's rules, deactivated ones too."""
    rules = V.table(spark, sf_dir, "part").select(
        F.concat(F.lit("rule"), "p_partkey").alias("id"),
        F.concat(F.lit("p"), F.col("p_size") % 5).alias("project_id"),
        F.col("p_name").alias("rule_name"),
        (F.col("p_brand") == "Brand#7").alias("is_deactivated"),
    )
    return R.list_rules(rules, "p2", page=2, page_size=10)
