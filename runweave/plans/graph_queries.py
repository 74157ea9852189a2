"""Queries over graphs, versions, notebooks and row changes."""

from datetime import datetime

from pyspark.sql import functions as F

from runweave.functions.text import is_valid_uuid
from runweave.operators import graph as G
from runweave.operators import mutations as M
from runweave.operators.merge_table import MergeTable
from runweave.plans import views as V
from runweave.plans.registry import query
from runweave.session import scratch_path


@query(
    "node_source_edges",
    """select 'g' || n_nationkey as id, n_name as name, 'e' || c_custkey as edge_id
       from nation left join customer on c_nationkey = n_nationkey""",
)
def node_source_edges(spark, sf_dir):
    """Edges into each node; half of the node names carry a prefix."""
    nation = V.table(spark, sf_dir, "nation")
    nodes = nation.select(
        F.concat(F.lit("g"), "n_nationkey").alias("id"),
        F.concat(F.when(F.col("n_nationkey") % 2 == 0, "self.").otherwise(""), "n_name").alias(
            "name"
        ),
    )
    edges = V.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("e"), "c_custkey").alias("id"),
        F.concat(F.lit("g"), "c_nationkey").alias("target"),
    )
    return G.node_source_edges(nodes, edges)


def tree_edges(spark, sf_dir):
    """root -> regions -> nations -> customers, with one more edge back and one across."""
    region = V.table(spark, sf_dir, "region").select(
        F.lit("root").alias("parent"),
        F.col("r_regionkey").cast("bigint").alias("ord"),
        F.col("r_name").alias("name"),
        F.concat(F.lit("r"), "r_regionkey").alias("child"),
    )
    nation = V.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("r"), "n_regionkey").alias("parent"),
        F.col("n_nationkey").cast("bigint").alias("ord"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("g"), "n_nationkey").alias("child"),
    )
    customer = V.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("g"), "c_nationkey").alias("parent"),
        F.col("c_custkey").alias("ord"),
        F.concat(F.lit("c"), "c_custkey").alias("name"),
        F.concat(F.lit("c"), "c_custkey").alias("child"),
    )
    back = nation.select("child", F.lit(999).cast("bigint").alias("ord"), F.lit("up").alias("name"),
                         F.lit("root").alias("to"))
    across = region.select("child", F.lit(998).cast("bigint").alias("ord"),
                           F.lit("also").alias("name"), F.lit("g0").alias("to"))
    extra = back.unionByName(across).select(
        F.col("child").alias("parent"), "ord", "name", F.col("to").alias("child")
    )
    return region.unionByName(nation).unionByName(customer).unionByName(extra)


@query(
    "tree_paths",
    """select 'root' as node, '' as path union all
       select 'r' || r_regionkey, r_name from region union all
       select 'g' || n_nationkey, r_name || '.' || n_name
       from nation join region on n_regionkey = r_regionkey union all
       select 'c' || c_custkey, r_name || '.' || n_name || '.c' || c_custkey
       from customer join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey""",
)
def tree_paths(spark, sf_dir):
    """Path of every node of the operator tree at its first visit."""
    roots = spark.createDataFrame([("root",)], "node string")
    return G.tree_paths(tree_edges(spark, sf_dir), roots).select("node", "path")


@query(
    "arg_contract",
    """select p_partkey, case when p_size % 2 = 0 then '' else b end as missing,
              case when p_partkey % 3 = 0 then '' else p_brand end as extra,
              p_size % 2 = 0 and p_partkey % 3 = 0 as ok
       from (select *, split_part(p_name, ' ', 2) as b from part) p""",
)
def arg_contract(spark, sf_dir):
    """Missing and extra arguments of each call."""
    part = V.table(spark, sf_dir, "part")
    first, second = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    calls = part.select(
        "p_partkey",
        F.array(first, second, F.lit("opt")).alias("args"),
        F.array(F.lit("opt")).alias("defaults"),
        F.when(F.col("p_size") % 2 == 0, F.array(first, second, F.col("p_brand")))
        .otherwise(F.array(first, F.col("p_brand")))
        .alias("passed"),
        (F.col("p_partkey") % 3 == 0).alias("var_kwargs"),
    )
    checked = G.arg_contract(calls)
    return checked.select(
        "p_partkey",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("extra", ",").alias("extra"),
        "ok",
    )


@query(
    "latest_stable_version",
    """with v as (select package, version, [cast(x as int) for x in string_split(version, '.')] n
                  from {versions} where not ends_with(version, 'rc1'))
       select p.package, coalesce(arg_max(version, n), '0') as latest
       from (select distinct package from {versions}) p left join v on p.package = v.package
       group by p.package""",
)
def latest_stable_version(spark, sf_dir):
    """Newest version of each package that is no prerelease."""
    return G.latest_stable_version(V.view(spark, sf_dir, "versions"))


@query(
    "masked_update",
    """select c_custkey as id,
              case when n > 12 and c_custkey % 2 = 0 then 'busy' else c_mktsegment end as segment,
              case when n > 12 then total else c_acctbal end as balance, c_name as name
       from customer left join (
           select o_custkey, count(*) as n, max(o_totalprice) as total from orders
           group by o_custkey) o on c_custkey = o_custkey""",
)
def masked_update(spark, sf_dir):
    """Customers patched from their orders; each patch lists the columns it changes."""
    base = V.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_name").alias("name"),
    )
    busy = V.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("balance")
    )
    patch = busy.where(F.col("n") > 12).select(
        "id",
        "balance",
        F.lit("busy").alias("segment"),
        F.lit("never").alias("name"),
        F.when(
            F.col("id") % 2 == 0, F.array(F.lit("balance"), F.lit("segment"))
        ).otherwise(F.array(F.lit("balance"))).alias("update_keys"),
    )
    return M.masked_update(base, patch)


@query(
    "field_mask",
    """select o_orderkey, concat_ws(',', case when o_orderkey % 2 = 0 then 'status' end,
                  case when o_orderkey % 5 = 0 then 'job'
                       when o_orderkey % 3 = 0 then 'job.retries' end) as paths
       from orders""",
)
def field_mask(spark, sf_dir):
    """Fields that differ between two versions of each order, one struct emptied."""
    key = F.col("o_orderkey")
    before = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_custkey").alias("id"), F.lit(1).alias("retries")).alias("job"),
    )
    after = F.struct(
        F.when(key % 2 == 0, "new").otherwise(F.col("o_orderstatus")).alias("status"),
        F.struct(
            F.when(key % 5 != 0, F.col("o_custkey")).alias("id"),
            F.when(key % 5 != 0, F.when(key % 3 == 0, 2).otherwise(1)).alias("retries"),
        ).alias("job"),
    )
    pairs = V.table(spark, sf_dir, "orders").select(
        "o_orderkey", before.alias("before"), after.alias("after")
    )
    paths = M.field_mask(F.col("before"), F.col("after"), pairs.schema["after"].dataType)
    return pairs.select("o_orderkey", F.array_join(paths, ",").alias("paths"))


@query(
    "register_rows",
    """select n_name as name, true as fresh_id, timestamp '2024-05-01 00:00:00' as created_at,
              case when n_nationkey % 2 = 0 then n_regionkey else 1 end as tracker_type,
              0 as status from nation""",
)
def register_rows(spark, sf_dir):
    """New trackers with ids, times and defaults."""
    rows = V.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).alias("tracker_type"),
    )
    added = M.register_rows(rows, datetime(2024, 5, 1), {"tracker_type": 1, "status": 0})
    return added.select(
        "name", is_valid_uuid("id").alias("fresh_id"), "created_at", "tracker_type", "status"
    )


@query(
    "delete_rows",
    """select id, status from {trackers} where id not in (select tracker_id from {logs})""",
)
def delete_rows(spark, sf_dir):
    """Trackers left after those with logs are deleted."""
    doomed = V.view(spark, sf_dir, "logs").select(F.col("tracker_id").alias("id"))
    return M.delete_rows(V.view(spark, sf_dir, "trackers").select("id", "status"), doomed)


@query(
    "merge_on_read",
    """with o as (select o_custkey, count(*) as n, max(o_totalprice) as total from orders group by o_custkey)
       select c_custkey as id, case when n > 12 then 'busy' else c_mktsegment end as segment,
              case when n > 12 and c_custkey % 2 = 0 then total else c_acctbal end as balance
       from customer left join o on c_custkey = o_custkey
       where not coalesce(n < 8, false) or c_custkey % 5 = 0
       union all
       select c_custkey, 'back', null from customer join o on c_custkey = o_custkey where n < 8 and c_custkey % 5 = 1""",
)
def merge_on_read(spark, sf_dir):
    """Customers put, patched from their orders, compacted, deleted and partly put again, in one table."""
    base = V.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    orders = V.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"))
    orders = orders.agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("balance"))
    table = MergeTable(spark, scratch_path(spark, "customers"), base.schema)
    table.put(base)
    busy = orders.where("n > 12")
    table.patch(busy.select("id", F.lit("busy").alias("segment"), F.array(F.lit("segment")).alias("update_keys")))
    table.compact()
    even = busy.where("id % 2 = 0")
    table.patch(even.select("id", "balance", F.array(F.lit("balance")).alias("update_keys")))
    idle = base.join(orders.where("n < 8").select("id"), "id", "left_semi")
    table.delete(idle.where("id % 5 <> 0"))
    lost = F.array(F.lit("segment")).alias("update_keys")
    table.patch(idle.where("id % 5 = 2").select("id", F.lit("no row to patch").alias("segment"), lost))
    back = idle.where("id % 5 = 1")
    table.put(back.select("id", F.lit("back").alias("segment"), F.lit(None).cast("double").alias("balance")))
    return table.read()
