"""Files in and out."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from runweave.operators import artifacts as A
from runweave.operators import logs as L
from runweave.operators.telemetry import node_latest
from runweave.session import scratch_path, shared_folder
from runweave.sources import files as FS
from runweave.sources import logs as S
from runweave.sources import notebooks as B

NOW = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(
        [("w", f"p{i % 2}", "t", f"l{i}", NOW, {"a": i / 3}, {"s": "x"} if i else {}) for i in range(6)],
        "workspace_id string, project_id string, tracker_id string, log_id string, ts timestamp, number map<string,float>, text map<string,string>",
    )


def test_write_then_read_prunes_and_pushes(spark, logs, tmp_path):
    L.write_logs(logs, f"{tmp_path}/logs")
    L.write_logs(logs, f"{tmp_path}/logs")
    read = S.read_logs(spark, f"{tmp_path}/logs")
    assert read.count() == 12
    found = L.log_query(read, project_id="p1", tracker_id="t", after=datetime(2023, 1, 1), keys=["a"])
    assert found.count() == 6
    plan = found.select("log_id", "number")._jdf.queryExecution().executedPlan().toString()
    assert "project_id" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "EqualTo(tracker_id,t)" in plan and "GreaterThan(ts" in plan
    assert "workspace_id" not in plan.split("ReadSchema:")[1]


def test_wire_logs(spark, tmp_path):
    line = {"tracker_id": "t", "log_id": "l", "timestamp": "2024-01-01T00:00:00Z", "number_keys": ["a", "b"],
            "number_values": [1, 16777217], "text_keys": [], "text_values": []}
    (tmp_path / "x.json").write_text(json.dumps(line))
    row = S.read_wire_logs(spark, str(tmp_path)).collect()[0]
    assert row.number == {"a": 1.0, "b": 16777216.0} and row.text == {}


def test_export_dataset(spark, logs, tmp_path):
    path = f"{tmp_path}/ds"
    assert not S.dataset_completed(spark, path)
    S.export_dataset(logs, path, log_ids=["l1", "l2"])
    assert S.dataset_completed(spark, path)
    assert sorted(r.log_id for r in spark.read.json(path).collect()) == ["l1", "l2"]


def test_column_json(spark, logs, tmp_path):
    S.export_log_columns_json(logs, f"{tmp_path}/out", project_id="p0", limit=2)
    got = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert got == [
        {"key": "a", "rows": [{"log_id": "l0", "timestamp": "2024-01-01T00:00:00.000000Z"},
                              {"log_id": "l2", "number": 0.6667, "timestamp": "2024-01-01T00:00:00.000000Z", "x": 1}],
         "value_type": "NUMBER"},
        {"key": "s", "rows": [{"log_id": "l2", "text": "x", "timestamp": "2024-01-01T00:00:00.000000Z"}],
         "value_type": "STRING"},
    ]


def test_json_log_lines(spark, tmp_path):
    good = {"timestamp": "2024-01-01T01:00:00+01:00", "levelname": "INFO", "logtype": "t1", "message": "m",
            "log": {"code": {"file": "a.py", "line": 3}, "data": {"x": [1]}, "lines": ["m", "n"]}}
    other = {**good, "logtype": "t2"}
    (tmp_path / "a.log").write_text("\n".join([json.dumps(good), json.dumps(other), '{"broken', "text"]) + "\n")
    read = S.read_json_log_lines(spark, str(tmp_path), "t1")
    rows = read.orderBy("_corrupt_record").select("*", F.to_json("log.data").alias("d")).collect()
    assert [r._corrupt_record for r in rows] == [None, "text", '{"broken']
    assert rows[0].timestamp == NOW and rows[0].log.code.line == 3 and rows[0].d == '{"x":[1]}'
    assert S.read_json_log_lines(spark, str(tmp_path)).count() == 4


def test_traces_last_write_wins_over_blocks(spark, tmp_path):
    lines = [json.dumps({"id": f"n{i % 3}", "name": "x", "status": str(i)}) for i in range(4000)]
    (tmp_path / "run1.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "run2.jsonl").write_text("\n".join(reversed(lines)) + "\n")
    (tmp_path / "other.txt").write_text("no trace\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        nodes = S.read_trace_jsonl(spark, str(tmp_path))
        assert nodes.rdd.getNumPartitions() > 4
        latest = node_latest(nodes.withColumn("ts", F.lit(0)), ["status"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {(r.run_id, r.id): r.status for r in latest}
    assert got == {("run1", "n0"): "3999", ("run1", "n1"): "3997", ("run1", "n2"): "3998",
                   ("run2", "n0"): "0", ("run2", "n1"): "1", ("run2", "n2"): "2"}


def test_scan_and_put_tree(spark, tmp_path):
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "a.txt").write_text("")
    (tmp_path / "sub" / "b.txt").write_text("12345")
    (tmp_path / "sub" / "deep" / "__init__.py").write_text("1")
    (tmp_path / "sub" / ".hidden").write_text("12")
    (tmp_path / "link").symlink_to(tmp_path / "sub")
    scan = FS.scan_files(spark, str(tmp_path))
    assert sorted((r.path, r.length) for r in scan.collect()) == [
        ("a.txt", 0), ("sub/.hidden", 2), ("sub/b.txt", 5), ("sub/deep/__init__.py", 1),
    ]
    both = FS.scan_files(spark, str(tmp_path), [".txt", "b.txt"])
    assert sorted(r.path for r in both.collect()) == ["a.txt", "sub/b.txt"]
    put = A.put_tree(scan, "remote/", "me", {".txt": "text/plain"}, "store", prefix="en/1")
    assert sorted((r.name, r.size, r.content_type) for r in put.collect()) == [
        ("en/1/remote/a.txt", 1, "text/plain"),
        ("en/1/remote/sub/.hidden", 2, "application/octet-stream"),
        ("en/1/remote/sub/b.txt", 5, "text/plain"),
        ("en/1/remote/sub/deep/__init__.py", 1, "application/octet-stream"),
    ]


def test_notebooks(spark, tmp_path):
    cells = [{"cell_type": "code", "source": ["%matplotlib inline\n", "import os.path as p, sys\n", "x = '%d'"]},
             {"cell_type": "markdown", "source": ["import no"]},
             {"cell_type": "code", "source": "from a.b import c\n"}]
    (tmp_path / "n.ipynb").write_text(json.dumps({"cells": cells, "nbformat": 4}))
    read = B.read_notebooks(spark, str(tmp_path))
    code = B.notebook_code(read)
    assert [r.code for r in code.collect()] == [
        "# %matplotlib inline\nimport os.path as p, sys\nx = '%d'\nfrom a.b import c\n\n"
    ]
    assert {r.module: r.uses for r in B.import_inventory(code).collect()} == {"os": 1, "sys": 1, "a.b": 1}
    parts = B.notebook_code(read, chunk_cells=1).orderBy("part").collect()
    assert [r.part for r in parts] == [0, 1] and "".join(r.code for r in parts) == code.collect()[0].code


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
