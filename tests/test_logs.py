"""Edge cases of metric records."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from runweave.operators import logs as L
from runweave.operators.rules import rule_column, rule_eval
from runweave.sources import logs as S

NOW = datetime(2024, 1, 1)


def accepted_and_problems(spark, payload, **kw):
    df = spark.createDataFrame(
        [("p", "t", NOW, "l1", payload)], "project_id string, tracker_id string, ts timestamp, log_id string, payload string"
    )
    split = L.halves(L.append_logs(df, **kw))
    good = [(r.number, r.text) for r in split.accepted.collect()]
    bad = [r.problems for r in split.quarantine.collect()]
    return good, bad


def test_nested_dict(spark):
    good, bad = accepted_and_problems(spark, '{"a":{"b":1},"c":"x"}')
    assert good == [({"a.b": 1.0}, {"c": "x"})] and bad == []


@pytest.mark.parametrize(
    "payload, problem",
    [
        ('{"a.b":1}', "separator in key: a.b"),
        ('{"x":{"a.b":1}}', "separator in key: x.a.b"),
        ('{"a b":1}', "invalid key: a b"),
        ('{"é":1}', "invalid key: é"),
        ('{"":1}', "invalid key: "),
        ('{"a":true}', "invalid type: a"),
        ('{"a":null}', "invalid type: a"),
        ('{"a":[1]}', "invalid type: a"),
        ("[1]", "not a JSON object"),
        ("3", "not a JSON object"),
        ("{", "not a JSON object"),
        (None, "not a JSON object"),
    ],
)
def test_quarantine(spark, payload, problem):
    good, bad = accepted_and_problems(spark, payload)
    assert good == [] and bad == [[problem]]


def test_dotted_parent_is_an_error_for_its_children(spark):
    assert accepted_and_problems(spark, '{"a.b":{"c":1}}')[1] == [["separator in key: a.b.c"]]


def test_large_int_is_float32(spark):
    assert accepted_and_problems(spark, '{"a":16777217}')[0] == [({"a": 16777216.0}, {})]


def test_empty_dicts_vanish(spark):
    assert accepted_and_problems(spark, '{"a":{},"b":{"c":{}},"d":1}')[0] == [({"d": 1.0}, {})]
    assert accepted_and_problems(spark, "{}")[0] == [({}, {})]


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 8, 9, 20, 40])
def test_every_depth(spark, depth):
    nested = {"v": 1, "s": "{{"}
    for i in range(depth - 1):
        nested = {f"k{i}": nested, f"n{i}": i}
    number = {".".join([*(f"k{i}" for i in reversed(range(depth - 1))), "v"]): 1.0}
    text = {".".join([*(f"k{i}" for i in reversed(range(depth - 1))), "s"]): "{{"}
    for i in range(depth - 1):
        prefix = [f"k{j}" for j in reversed(range(i + 1, depth - 1))]
        number[".".join([*prefix, f"n{i}"])] = float(i)
    assert accepted_and_problems(spark, json.dumps(nested)) == ([(number, text)], [])


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 6])
@pytest.mark.parametrize(
    "value",
    ['1', '-2.5e3', '123456789012345678901234567890', '"t{}"', '""', 'true', 'null', '[1,{"x":2}]', '{}', '{"p":1,"q":"w"}',
     '{"a b":1}', '{"a.b":{"c":1}}', '{"p":1,"p":2}', 'NaN', '1.', '{"é":1,"b":2,"a":3}'],
)
def test_expressions_and_batches_agree(spark, depth, value):
    text = '{"k":' * depth + value + "}" * depth
    df = spark.createDataFrame([(text,)], "payload string")
    deep = L.leaves_of(text)
    # Trailing braces inside a text send it through the batches, which must not change its leaves.
    got = df.select(L.flat_entries("payload").alias("e")).first().e
    got = got if got is None else [r.asDict() for r in got]
    if deep is not None:
        for r in deep:
            r["number"] = r["number"] if r["number"] is None else float(np.float32(r["number"]))
    assert got == deep


def test_log_id_is_kept_or_made(spark):
    rows = spark.createDataFrame(
        [("t", "given"), ("t", ""), ("t", None)], "tracker_id string, log_id string"
    ).withColumn("payload", F.lit('{"a":1}'))
    ids = [r.log_id for r in L.halves(L.append_logs(rows)).accepted.collect()]
    assert ids[0] == "given" and all(len(i) == 36 for i in ids[1:]) and len(set(ids)) == 3


def test_struct_logs(spark):
    df = spark.sql("select 't' tracker_id, named_struct('b', 1, 'd', 2.5) a, cast(null as string) c")
    row = L.append_struct_logs(df, ["a", "c"]).collect()[0]
    assert row.number == {"a.b": 1.0, "a.d": 2.5} and row.text == {}
    with pytest.raises(ValueError):
        L.append_struct_logs(spark.sql("select true a"), ["a"])
    with pytest.raises(ValueError):
        L.append_struct_logs(spark.sql("select 1 as `a b`"), ["a b"])
    with pytest.raises(ValueError):
        L.append_struct_logs(spark.sql("select named_struct('x.y', 1) a"), ["a"])


@pytest.fixture(scope="module")
def logs(spark):
    rows = [
        ("p", f"t{i % 2}", f"l{i:02d}", NOW + timedelta(minutes=i // 2), {"a": float(i)},
         {"s": str(i)} if i % 3 else {})
        for i in range(20)
    ]
    return spark.createDataFrame(
        rows,
        "project_id string, tracker_id string, log_id string, ts timestamp, number map<string,float>, text map<string,string>",
    )


def ids(df):
    return sorted(r.log_id for r in df.collect())


def test_window_is_exclusive(logs):
    found = L.log_query(logs, after=NOW, before=NOW + timedelta(minutes=2))
    assert ids(found) == ["l02", "l03"]


def test_limit_counts_records_oldest_first(logs):
    assert [r.log_id for r in L.log_query(logs, limit=3).collect()] == ["l00", "l01", "l02"]
    assert len(ids(L.log_query(logs, limit=0))) == 20


def test_keys(logs):
    assert len(ids(L.log_query(logs, keys=[""]))) == 20
    assert len(ids(L.log_query(logs, keys=["s"]))) == 13
    assert ids(L.log_query(logs, keys=["none"])) == []
    row = L.log_query(logs, keys=["s"], limit=1).collect()[0]
    assert row.number == {} and row.text == {"s": "1"}


def test_bad_parameters_fail_before_any_job(logs):
    with pytest.raises(ValueError):
        L.log_query(logs, after=NOW, before=NOW - timedelta(1))
    with pytest.raises(ValueError):
        L.log_query(logs, limit=-1)


def test_log_ids(logs, spark):
    assert ids(L.log_query(logs, log_ids=["l03", "l04"])) == ["l03", "l04"]
    table = spark.createDataFrame([("l05",), ("l05",)], "log_id string")
    assert ids(L.log_query(logs, log_ids=table)) == ["l05"]


def test_tracker_table_takes_newest_that_has_the_key(logs):
    rows = {r.tracker_id: r for r in L.tracker_table(logs, ["a"], ["s"]).collect()}
    assert rows["t0"].a == 18.0 and rows["t0"].s == "16"
    assert rows["t1"].a == 19.0 and rows["t1"].s == "19"


def test_tracker_table_of_one_page(logs, spark):
    page = spark.createDataFrame([("t1",)], "id string")
    assert [r.tracker_id for r in L.tracker_table(logs, ["a"], trackers=page).collect()] == ["t1"]


def test_columns_rebuild_the_series(logs):
    series = L.series_x(L.log_series(logs))
    columns = L.log_columns(series, chunk_rows=4).where("key = 'a' and tracker_id = 't0'")
    chunks = {r.chunk: r.rows for r in columns.collect()}
    assert [len(chunks[i]) for i in range(3)] == [4, 4, 2]
    assert [i.x for c in range(3) for i in chunks[c]] == list(range(10))
    assert [i.number for c in range(3) for i in chunks[c]] == [float(i) for i in range(0, 20, 2)]


def test_dataset_selectors(logs):
    with pytest.raises(ValueError):
        S.select_dataset(logs)
    with pytest.raises(ValueError):
        S.select_dataset(logs, query={"==": [{"var": "a"}, 1]}, log_ids=["l01"])
    assert ids(S.select_dataset(logs, query={">=": [{"var": "a"}, 18]})) == ["l18", "l19"]


def test_rules(logs):
    hits = rule_eval(
        logs,
        [
            ("r1", {"and": [{">": [{"var": "a"}, 3]}, {"<": [{"var": "a"}, 6]}]}),
            ("r2", {"in": [{"var": "s"}, ["5", "7"]]}),
            ("r3", {"!": [{"<": [{"var": "a"}, 19]}]}),
            ("r4", {"==": [{"var": "missing"}, 1]}),
        ],
    )
    assert sorted(tuple(r) for r in hits.collect()) == [
        ("r1", "l04"), ("r1", "l05"), ("r2", "l05"), ("r2", "l07"), ("r3", "l19"),
    ]


@pytest.mark.parametrize(
    "logic", [{"xor": []}, {"==": [{"var": "a"}, True]}, {"in": [{"var": "a"}, []]}, {"and": []}, {}, 3]
)
def test_bad_rules(logic):
    with pytest.raises(ValueError):
        rule_column(logic)


def test_records_nested_too_deeply_are_kept(spark):
    deep = '{"a":' * 100_000 + "1" + "}" * 100_000
    df = spark.createDataFrame([("p", "t", datetime(2024, 1, 1), deep), ("p", "t", datetime(2024, 1, 1), '{"b": 2}')], "project_id string, tracker_id string, ts timestamp, payload string")
    made = L.append_logs(df).collect()
    problems = {r.payload: r.problems for r in made}
    assert problems == {deep: [L.TOO_DEEP], None: []}
    flat = {(r.key, r.number, r.problem) for r in L.flatten_log(df, "payload", []).collect()}
    assert flat == {("", None, L.TOO_DEEP), ("b", 2.0, None)}


@pytest.mark.parametrize("code", ["f" + "()" * 100_000, "-" * 200_000 + "1", "(" * 5_000 + ")" * 5_000])
def test_code_nested_too_deeply_does_not_parse(code):
    from runweave.sources.notebooks import top_modules

    assert top_modules(code) in (None, [])
