"""Queries that run user functions, and notebook code."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runweave.operators import compute as C
from runweave.operators.logs import log_query
from runweave.plans import views as V
from runweave.plans.registry import query
from runweave.sources import logs as S
from runweave.sources import notebooks as B


@query(
    "notebook_code",
    """select nb, 0 as part, string_agg(regexp_replace(source, '^%', '# %', 'gm') || chr(10), ''
                  order by cell) as code
       from {notebooks} where cell_type = 'code' group by nb""",
)
def notebook_code(spark, sf_dir):
    """Script of each notebook, from whole cells."""
    return B.notebook_code(V.view(spark, sf_dir, "notebooks"))


@query(
    "import_inventory",
    """with c as (select p_brand, p_type, p_partkey % 10 = 9 as broken from part),
            m as (select lower(p_type) as module from c where not broken
                  union all select 'm' || substr(p_brand, 7) || '.sub' from c where not broken
                  union all select cast(null as varchar) from c where broken)
       select module, count(*) as uses from m group by module""",
)
def import_inventory(spark, sf_dir):
    """Modules imported by one script per part; every tenth does not parse."""
    code = F.concat(
        F.lit("import "),
        F.lower("p_type"),
        F.lit(".x as y\ndef f():\n    from m"),
        F.substring("p_brand", 7, 3),
        F.lit(".sub import z\n    return 'import fake'\n"),
        F.when(F.col("p_partkey") % 10 == 9, "!pip list\n").otherwise(""),
    )
    scripts = V.table(spark, sf_dir, "part").select(code.alias("code"))
    return B.import_inventory(scripts)


@query(
    "parallel_map",
    """select o_orderkey as idx, case when o_custkey % 10 <> 0
                  then o_custkey * 2 + length(cast(o_custkey as varchar)) end as value,
              case when o_custkey % 10 = 0 then 'ValueError: bad ' || o_custkey end as error
       from orders""",
)
def parallel_map(spark, sf_dir):
    """A Python function of every order, failures included."""

    def work(n):
        if n % 10 == 0:
            raise ValueError(f"bad {n}")
        return n * 2 + len(str(n))

    inputs = V.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("idx"), F.col("o_custkey").alias("x")
    )
    return C.parallel_map(inputs, work, "x", "bigint")


@query(
    "sequential",
    """select o_orderkey, o_totalprice * 2 as price, upper(o_orderstatus) || '!' as status
       from orders where o_orderstatus <> 'P'""",
)
def sequential(spark, sf_dir):
    """Three steps in a row."""
    chain = C.sequential(
        lambda d: d.where(F.col("o_orderstatus") != "P"),
        lambda d: d.withColumn("price", F.col("o_totalprice") * 2),
        lambda d: d.withColumn("status", F.concat(F.upper("o_orderstatus"), F.lit("!"))),
    )
    return chain(V.table(spark, sf_dir, "orders")).select("o_orderkey", "price", "status")


@query(
    "operator_wrap",
    """select p_partkey, length(p_name) + p_partkey % 7 as size_of, upper(p_name) as shouted
       from part""",
)
def operator_wrap(spark, sf_dir):
    """A function and a class behind one calling form."""

    @C.operator("named", "size_of", "bigint")
    def size_of(text):
        name, _, number = text.rpartition("|")
        return len(name) + int(number)

    @C.operator("p_name", "shouted", "string")
    class Shout:
        def forward(self, text):
            return text.upper()

    parts = V.table(spark, sf_dir, "part").withColumn(
        "named", F.concat("p_name", F.lit("|"), F.col("p_partkey") % 7)
    )
    done = C.sequential(size_of, Shout)(parts)
    return done.select("p_partkey", "size_of", "shouted")


@query(
    "init_once_udf",
    """select p_partkey, case p_type when 'ECONOMY' then 1 when 'PROMO' then 2
                  when 'STANDARD' then 3 else 0 end as code from part""",
)
def init_once_udf(spark, sf_dir):
    """A look-up table built once per task."""

    def build():
        table = {name: i + 1 for i, name in enumerate(["ECONOMY", "PROMO", "STANDARD"])}
        return lambda types: types.map(table).fillna(0).astype("int64")

    code = C.init_once_udf(build, "bigint")
    return V.table(spark, sf_dir, "part").select("p_partkey", code("p_type").alias("code"))


@query(
    "batch_infer",
    """select vec_id, list_position(embedding, list_max(embedding)) - 1 as prediction
       from embeddings""",
)
def batch_infer(spark, sf_dir):
    """A model scores every vector: the position of its largest component."""
    vectors = V.table(spark, sf_dir, "embeddings")

    def make_model():
        return lambda x: np.argmax(x, axis=1).astype("int64")

    width = len(vectors.select("embedding").head()[0])
    scored = C.batch_infer(
        vectors,
        make_model,
        {"x": "embedding"},
        ["x"],
        T.LongType(),
        input_tensor_shapes=[[width]],
    )
    return scored.select("vec_id", "prediction")


class Totals(C.Actor):
    """Orders, largest price and distinct days of one customer's orders."""

    def __init__(self):
        self.orders, self.largest, self.failed = 0, 0.0, 0

    def update(self, rows):
        self.orders += len(rows["o_custkey"])
        self.largest = max(self.largest, float(rows["o_totalprice"].max()))
        self.failed += int((rows["o_orderstatus"] == "P").sum())

    def state(self):
        return {"orders": self.orders, "largest": self.largest, "failed": self.failed}

    def merge(self, state):
        self.orders += int(state["orders"])
        self.largest = max(self.largest, float(state["largest"]))
        self.failed += int(state["failed"])

    def result(self):
        return {
            "orders": self.orders,
            "largest": self.largest,
            "failed_share": self.failed / self.orders,
        }


@query(
    "group_apply",
    """select o_custkey, count(*) as orders, max(o_totalprice) as largest,
              count(*) filter (where o_orderstatus = 'P') / count(*) as failed_share
       from orders group by o_custkey""",
)
def group_apply(spark, sf_dir):
    """One stateful actor per customer."""
    orders = V.table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    return C.group_apply(
        orders,
        "o_custkey",
        Totals,
        "orders bigint, largest double, failed bigint",
        "orders bigint, largest double, failed_share double",
    )


@query(
    "export_log_columns_json",
    """with s as (select tracker_id, 'value' as key, ts, log_id,
                     '"number":' || case when v = 0 then null
                         when v = floor(v) then cast(v as bigint) || '.0'
                         else cast(v as varchar) end as body
                  from (select *, cast(format('{:.4g}', cast(value as double)) as double) as v
                        from {logs}) l
                  union all
                  select tracker_id, 'event_type', ts, log_id, '"text":"' || event_type || '"'
                  from {logs}),
            x as (select *, row_number() over (partition by tracker_id, key order by ts, log_id)
                      - 1 as x from s)
       select tracker_id, key, cast(x // 20 as bigint) as chunk,
              '{"key":"' || key || '","rows":[' || string_agg(
                  '{"log_id":"' || log_id || '",' || coalesce(body || ',', '') || '"timestamp":"'
                  || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"'
                  || case when x > 0 then ',"x":' || x else '' end || '}', ',' order by x)
              || '],"value_type":"' || case key when 'value' then 'NUMBER' else 'STRING' end
              || '"}' as json
       from x group by tracker_id, key, x // 20""",
)
def export_log_columns_json(spark, sf_dir):
    """Record columns as JSON texts."""
    asked = log_query(V.logs(spark, sf_dir), keys=["value", "event_type"])
    return S.log_columns_json(asked, chunk_rows=20)
