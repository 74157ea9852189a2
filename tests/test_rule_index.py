"""Rules matched by counting, against the compiled form."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from runweave.operators.rule_index import match_rules, rule_problems
from runweave.operators.rules import rule_eval

SCHEMA = "project_id string, tracker_id string, log_id string, ts timestamp, number map<string,float>, text map<string,string>"
START = datetime(2024, 1, 1)


def records(n=120, seed=1):
    r = random.Random(seed)
    for i in range(n):
        number = {k: r.choice([None, 0.0, -0.0, float("nan"), float("inf"), float(r.randint(-9, 9)), r.random() * 10]) for k in "abc" if r.random() < 0.8}
        text = {k: r.choice([None, "", "x", "é", "zz", "w" * r.randint(1, 4)]) for k in "st" if r.random() < 0.8}
        yield (r.choice(["p", "q", None]), f"t{r.randint(0, 3)}", f"l{i % 100}", START + timedelta(hours=r.randint(0, 9)), number, text)


def atom(r):
    op = r.choice(["==", "!=", "<", "<=", ">", ">="])
    sort = r.randint(0, 6)
    if sort < 2:
        pair = [{"var": r.choice("abc")}, r.choice([0, -0.0, 0.1, r.randint(-9, 9), r.random() * 10])]
    elif sort == 2:
        pair = [{"var": r.choice("st")}, r.choice(["", "x", "é", "w", "ww"])]
    elif sort == 3:
        pair = [{"var": r.choice(["tracker_id", "project_id"])}, r.choice(["t1", "p", "q", "t2"])]
    elif sort == 4:
        pair = r.choice([[{"var": "a"}, {"var": "b"}], [{"var": "project_id"}, {"var": "tracker_id"}]])
    elif sort == 5:
        return {"in": r.choice([[{"var": "a"}, [1, 2, 0, 2]], [{"var": "s"}, ["x", "zz", "é"]], [{"var": "ts"}, ["2024-01-01 01:00:00"]]])}
    else:
        pair = [{"var": "ts"}, f"2024-01-01 0{r.randint(0, 9)}:00:00"]
    return {op: pair[::-1] if r.random() < 0.2 else pair}


def logic(r, depth):
    if depth == 0 or r.random() < 0.3:
        return atom(r)
    if r.random() < 0.25:
        inner = logic(r, depth - 1)
        return {"!": r.choice([inner, [inner]])}
    return {r.choice(["and", "or"]): [logic(r, depth - 1) for _ in range(r.randint(1, 3))]}


def compare(spark, logs, rules):
    table = spark.createDataFrame([(i, json.dumps(x)) for i, x in rules], "rule_id string, logic string")
    assert rule_problems(table).count() == 0
    got = sorted(tuple(r) for r in match_rules(logs, table).collect())
    want = sorted(tuple(r) for r in rule_eval(logs, rules).collect())
    assert got == want
    return got


def test_random_rules_hit_what_the_compiled_ones_hit(spark):
    r = random.Random(7)
    logs = spark.createDataFrame(list(records()), SCHEMA)
    logs = logs.union(logs.limit(30)).withColumn("path", F.lit(1))  # equal records, and a column named as a helper
    assert len(compare(spark, logs, [(f"r{i}", logic(r, 3)) for i in range(60)])) > 300


def test_more_borders_than_runs(spark, monkeypatch):
    from runweave.operators import rule_index

    monkeypatch.setattr(rule_index, "RUNS", 16)
    r = random.Random(3)
    logs = spark.createDataFrame(list(records(40, 5)), SCHEMA)
    rules = [(f"r{i}", {r.choice(["<", ">=", "!=", "=="]): [{"var": "a"}, r.random() * 10]}) for i in range(120)]
    compare(spark, logs, rules)


def test_without_broadcasts(spark, monkeypatch):
    from runweave.operators import rule_index

    monkeypatch.setattr(rule_index, "SMALL_BYTES", 0)
    r = random.Random(11)
    logs = spark.createDataFrame(list(records(60, 6)), SCHEMA)
    compare(spark, logs, [(f"r{i}", logic(r, 2)) for i in range(40)])


def test_thousands_of_rules_in_a_plan_of_the_same_size(spark):
    logs = spark.createDataFrame([("p", "t", f"l{i}", START, {"a": float(i)}, {"s": str(i % 7)}) for i in range(200)], SCHEMA)

    def rules(n):
        return spark.range(n).select(
            F.concat(F.lit("r"), "id").alias("rule_id"),
            F.concat(F.lit('{"and":[{"<":[{"var":"a"},'), F.col("id") % 977, F.lit(']},{"==":[{"var":"s"},"'), F.col("id") % 9, F.lit('"]}]}')).alias("logic"),
        )

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())

    many = match_rules(logs, rules(5000))
    assert size(many) == size(match_rules(logs, rules(10)))
    want = {(f"r{j}", f"l{i}") for j in range(5000) for i in range(200) if i < j % 977 and str(i % 7) == str(j % 9)}
    got = [tuple(r) for r in many.collect()]
    assert len(got) == len(want) and set(got) == want


def test_small_blocks_and_copies_of_a_record(spark, monkeypatch):
    from runweave.operators import rule_index

    for name, value in (("BLOCK", 16), ("BLOCK_ATOMS", 1), ("BLOCK_LEAVES", 3), ("ROWS_OUT", 7)):
        monkeypatch.setattr(rule_index, name, value, raising=False)
    r = random.Random(5)
    logs = spark.createDataFrame(list(records(80, 2)) * 2, SCHEMA)
    assert compare(spark, logs, [(f"r{i % 50}", logic(r, 3)) for i in range(60)])


def test_pairs_are_not_shuffled_again_for_each_level(spark):
    # A pair of a rule and a record is settled where it is made, however deep the rule.
    logs = spark.createDataFrame(list(records(40)), SCHEMA)

    def shuffles(depth):
        rule = {"<": [{"var": "a"}, 5]}
        for i in range(depth):
            rule = {"or" if i % 2 else "and": [{">": [{"var": "b"}, i]}, rule]}
        table = spark.createDataFrame([("r", json.dumps(rule))], "rule_id string, logic string")
        found = match_rules(logs, table)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rule_eval(logs, [("r", rule)]).collect()))
        return found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")

    assert shuffles(6) == shuffles(1)


BAD = [
    None, "", "{", "3", "{}", '{"xor":[]}', '{"and":[]}', '{"==":[1,1]}', '{"==":[{"var":"a"},true]}',
    '{"in":[{"var":"a"},[]]}', '{"in":[{"var":"a"},[1,"x"]]}', '{"<":[{"var":"ts"},3]}',
    '{"<":[{"var":"ts"},{"var":"a"}]}', '{"<":[{"var":"a"}]}', '{"!":' * 50_000 + "1" + "}" * 50_000,
]


def test_rules_that_cannot_be_read_are_listed(spark):
    good = ("good", '{">":[{"var":"a"},1]}')
    rules = spark.createDataFrame([(f"bad{i}", text) for i, text in enumerate(BAD)] + [good, good], "rule_id string, logic string")
    assert {r.rule_id for r in rule_problems(rules).collect()} == {f"bad{i}" for i in range(len(BAD))}
    logs = spark.createDataFrame([("p", "t", "l", START, {"a": 2.0}, {})], SCHEMA)
    assert [tuple(r) for r in match_rules(logs, rules).collect()] == [("good", "l")]


def test_empty_tables(spark):
    logs, rules = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "rule_id string, logic string")
    some = spark.createDataFrame([("r", '{">":[{"var":"a"},1]}')], rules.schema)
    full = spark.createDataFrame(list(records(3)), SCHEMA)
    for a, b in ((logs, rules), (logs, some), (full, rules)):
        assert match_rules(a, b).collect() == [] and match_rules(a, b).columns == ["rule_id", "log_id"]
