"""Metadata, artifacts, graphs and row changes on small tables."""

import fnmatch
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from runweave.operators import artifacts as A
from runweave.operators import graph as G
from runweave.operators import mutations as M
from runweave.operators import paging as P
from runweave.operators import runs as N
from runweave.operators import telemetry as T
from runweave.operators import trackers as K


def names(df, column="name"):
    return sorted(r[column] for r in df.collect())


# --- pages ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(57).select((F.col("id") % 9).alias("k"), F.col("id").cast("string").alias("id"))


def test_pages_make_the_whole_list(numbers):
    whole = [tuple(r) for r in P.page_offset(numbers, ["k", "id"]).collect()]
    by_offset = [tuple(r) for o in range(0, 60, 10) for r in P.page_offset(numbers, ["k", "id"], o, 10).collect()]
    by_page = [tuple(r) for p in range(1, 7) for r in P.page_no(numbers, ["k", "id"], p, 10).collect()]
    by_key, last = [], None
    while True:
        page = [tuple(r) for r in P.page_after(numbers, ["k", "id"], last, 10).collect()]
        by_key += page
        if len(page) < 10:
            break
        last = page[-1]
    assert whole == by_offset == by_page == by_key and len(whole) == 57


def test_first_pages(numbers):
    first = P.page_no(numbers, ["id"], 1, 5).collect()
    assert P.page_no(numbers, ["id"], 0, 5).collect() == first == P.page_no(numbers, ["id"], -1, 5).collect()


def test_totals(numbers):
    assert tuple(P.page_totals(numbers, 10).collect()[0]) == (57, 6)
    assert tuple(P.page_totals(numbers, 0).collect()[0]) == (57, 1)
    assert tuple(P.page_totals(numbers.where("false"), 10).collect()[0]) == (0, 0)


@pytest.mark.parametrize("call", [
    lambda d: P.page_offset(d, ["id"], 0, -1), lambda d: P.page_offset(d, ["id"], -1, 1),
    lambda d: P.page_no(d, ["id"], -2, 5), lambda d: P.page_no(d, ["id"], 1, 0),
    lambda d: P.page_totals(d, -1),
])
def test_bad_pages(numbers, call):
    with pytest.raises(ValueError):
        call(numbers)


def test_unknown_sort_column(numbers):
    assert P.sort_listing(numbers, "nope", "id") is numbers


# --- runs and trackers -----------------------------------------------------------


def test_run_outcome(spark):
    rows = [("a", "ERROR", n, 2, 1) for n in range(3)] + [("b", "ERROR", n, 2, 1) for n in range(2)]
    rows += [("c", "ERROR", 2, 2, 1), ("c", "COMPLETED", 1, 2, 1), ("d", "RUNNING", 0, 2, 601),
             ("e", "RUNNING", 0, 2, 600)]
    df = spark.createDataFrame(rows, "run_id string, status string, retry_count int, max_retries int, polls int")
    got = {r.run_id: r.outcome for r in N.run_outcome(df).collect()}
    assert got == {"a": "ERROR", "b": "PENDING", "c": "COMPLETED", "d": "TIMEOUT", "e": "PENDING"}


def test_resolve_refs_flags(spark):
    jobs = spark.createDataFrame(
        [("j1", "one", 1), ("j2", "two", 1), ("j3", "two", 1), ("j4", "old", 2)], "id string, name string, status int"
    )
    refs = spark.createDataFrame(
        [(1, "j1", None), (2, None, "one"), (3, None, "two"), (4, "j4", ""), (5, "j1", "one"), (6, "", ""), (7, "zz", None)],
        "ref_id int, id string, name string",
    )
    got = {r.ref_id: (r.resolved_id, r.resolved_name, r.problem) for r in N.resolve_refs(refs, jobs, 2).collect()}
    assert got == {
        1: ("j1", "one", None), 2: ("j1", "one", None), 3: (None, None, "ambiguous"), 4: (None, "old", None),
        5: (None, None, "invalid"), 6: (None, None, "invalid"), 7: (None, None, "missing"),
    }


def test_tracker_status_precedence(spark):
    df = spark.createDataFrame(
        [("a", "created"), ("b", "created"), ("b", "log"), ("c", "log"), ("c", "end"), ("c", "log"), ("d", "failed"), ("d", "end")],
        "tracker_id string, kind string",
    )
    assert {r.tracker_id: r.status for r in K.tracker_status(df).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_last_n_must_be_positive(spark):
    with pytest.raises(ValueError):
        N.last_n_runs(spark.range(1), 0)


def test_tracker_windows(spark):
    with pytest.raises(ValueError):
        K.list_trackers(spark.range(1), created_after=datetime(2024, 1, 2), created_before=datetime(2024, 1, 1))


def test_artifacts_stop_at_folder_borders(spark):
    projects = spark.createDataFrame([("p", "r")], "id string, relic_id string")
    trackers = spark.createDataFrame([("t", "p", "a/b/"), ("u", "p", "a")], "id string, project_id string, save_location string")
    files = spark.createDataFrame([("r", n) for n in ("a/b/x", "a/bc/x", "a/b", "b/a/b/x")], "relic_id string, name string")
    got = {(r.tracker_id, r.name) for r in K.project_artifacts(projects, trackers, files).collect()}
    assert got == {("t", "a/b/x"), ("t", "a/b"), ("u", "a/b/x"), ("u", "a/bc/x"), ("u", "a/b")}


# --- artifacts ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def files(spark):
    keys = ["a/b/c.txt", "a/b.txt", "a/", "d.txt", "a/b/", "x/fr/y", "www.example.net/z", "q/66", "q/66/r",
            "line\nexample.net"]
    return spark.createDataFrame([("r", k, 1) for k in keys], "relic_id string, name string, size bigint")


def test_list_dir_types(files):
    got = {r.name: (r.type, r.files) for r in A.list_dir(files, "a").collect()}
    assert got == {"a/b": (2, 2), "a/b.txt": (1, 1), "a/": (1, 1)}


def test_flat_listing(files):
    assert names(A.list_files(files, "a/")) == ["a/", "a/b.txt", "a/b/"]
    assert names(A.list_files(files, "a/", recurse=True)) == ["a/", "a/b.txt", "a/b/", "a/b/c.txt"]


def test_has(files):
    for path, there in [("/a/b.txt/", True), ("a/b.tx", False), ("a/b", True)]:
        assert A.has_file(files, path).collect()[0].exists is there


@pytest.mark.parametrize("pattern", ["/fr/", "*example.net*", "66", "*.txt", "a/*", "?/b*", "[aq]/*", "[!a]*", "*\n*", "b/"])
def test_ignore_patterns(files, pattern):
    every = names(files)
    if pattern.endswith("/"):
        gone = [n for n in every if re.search(pattern, n)]
    elif "*" in pattern:
        gone = fnmatch.filter(every, pattern)
    else:
        gone = [n for n in every if n.endswith(pattern)]
    assert names(A.ignore_files(files, [pattern])) == sorted(set(every) - set(gone))


def test_catalog_of_empty_file(spark):
    df = spark.createDataFrame([("./a.txt", 0, datetime(2024, 1, 1))], "path string, length bigint, modified timestamp")
    row = A.catalog_files(df, "me", {}).collect()[0]
    assert (row.name, row.size, row.created_on, row.content_type) == ("a.txt", 1, 1704067200, "application/octet-stream")


# --- routes ------------------------------------------------------------------------


def test_first_template_wins(spark):
    df = spark.createDataFrame([("/item/5",), ("/item/5/x",), ("/item/é",), ("/item/a-b",), ("/item/5\n",), ("/",)], "path string")
    templates = ["/item/{a}", "/item/{b}", "/"]
    want = {}
    for (path,) in [tuple(r) for r in df.collect()]:
        want[path] = next((t for t in templates if re.match("^" + re.sub(r"\{\w+\}", r"\\w+", t) + "$", path)), None)
    assert {r.path: r.route for r in T.route_match(df, templates).collect()} == want


# --- graphs ---------------------------------------------------------------------------


def test_tree_first_visit(spark):
    # b is reached through a first, although it is also a child of the root; c points back.
    edges = spark.createDataFrame(
        [("r", 1, "a", "a"), ("r", 2, "b", "b"), ("a", 1, "x", "b"), ("b", 1, "c", "c"), ("c", 1, "up", "a")],
        "parent string, ord bigint, name string, child string",
    )
    roots = spark.createDataFrame([("r",)], "node string")
    got = G.tree_paths(edges, roots).orderBy("ordinals").collect()
    assert [(r.node, r.path) for r in got] == [("r", ""), ("a", "a"), ("b", "a.x"), ("c", "a.x.c")]


def test_versions(spark):
    rows = [("p", v) for v in ["1.9", "1.10", "1.10.0rc1", "2.0a1", "1.10.dev3", "1.9.1"]]
    rows += [("q", v) for v in ["1.0rc1"]] + [("s", v) for v in ["1.0", "1.0.post2", "1.0.post10", "1.0+abc"]]
    df = spark.createDataFrame(rows, "package string, version string")
    assert {r.package: r.latest for r in G.latest_stable_version(df).collect()} == {
        "p": "1.10", "q": "0", "s": "1.0.post10",
    }


def test_node_without_edges(spark):
    nodes = spark.createDataFrame([("1", "self.a"), ("2", "selfish")], "id string, name string")
    edges = spark.createDataFrame([("e", "1"), ("f", "9")], "id string, target string")
    got = {tuple(r) for r in G.node_source_edges(nodes, edges).select("id", "name", "edge_id").collect()}
    assert got == {("1", "a", "e"), ("2", "selfish", None)}


# --- row changes ------------------------------------------------------------------------


def test_field_mask_paths(spark):
    kind = "a struct<x:int,y:struct<z:int>>, b string, l array<int>"
    def mask(old, new):
        df = spark.createDataFrame([(old, new)], f"o struct<{kind.replace(' struct', ':struct').replace('b string', 'b:string').replace('l array', 'l:array')}>, n struct<{kind.replace(' struct', ':struct').replace('b string', 'b:string').replace('l array', 'l:array')}>")
        return df.select(M.field_mask(F.col("o"), F.col("n"), df.schema["n"].dataType).alias("m")).collect()[0].m
    full = ((1, (2,)), "s", [1])
    assert mask(full, full) == []
    assert mask(full, ((1, (3,)), "t", [2])) == ["a.y.z", "b", "l"]
    assert mask(full, ((None, (None,)), "s", [1])) == ["a"]
    assert mask(full, (None, "s", [1])) == ["a"]
    assert mask(None, full) == ["a.x", "a.y.z", "b", "l"]
    assert mask(full, None) == ["a", "b", "l"]


def test_masked_update_with_its_own_mask(spark):
    base = spark.createDataFrame([(i, i % 3, f"n{i}") for i in range(20)], "id int, a int, b string")
    new = spark.createDataFrame([(i, i % 4, f"n{i - i % 2}") for i in range(15)], "id int, a int, b string")
    both = base.select("id", F.struct("a", "b").alias("o")).join(new.select("id", F.struct("a", "b").alias("n")), "id")
    patch = both.select("id", "n.a", "n.b", M.field_mask(F.col("o"), F.col("n"), both.schema["n"].dataType).alias("update_keys"))
    got = sorted(map(tuple, M.masked_update(base, patch).collect()))
    want = {r.id: tuple(r) for r in base.collect()} | {r.id: tuple(r) for r in new.collect()}
    assert got == sorted(want.values())
    with pytest.raises(ValueError):
        M.masked_update(base, patch.withColumn("zz", F.lit(1)))


def test_register_rows(spark):
    rows = spark.createDataFrame([("a", None), ("b", 3)], "name string, status int")
    got = {r.name: r for r in M.register_rows(rows, datetime(2024, 1, 1), {"status": 0, "kind": "x"}).collect()}
    assert got["a"].status == 0 and got["b"].status == 3 and got["a"].kind == "x"
    assert got["a"].id != got["b"].id and got["a"].created_at == datetime(2024, 1, 1)
