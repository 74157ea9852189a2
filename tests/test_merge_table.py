"""The merge-on-read table against rewriting, with competing writers, compaction and a stream."""

import os
import random

import pytest

from runweave.operators import merge_table
from runweave.operators.merge_table import MergeTable, merge_stream
from runweave.streaming import live as S

ROW = "id long, a string, b double, c int"
PATCH = "id long, update_keys array<string>, a string, b double"


@pytest.fixture
def table(spark, tmp_path):
    return MergeTable(spark, f"{tmp_path}/t", spark.createDataFrame([], ROW).schema)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_changes_equal_a_rewritten_table(spark, table, monkeypatch, tmp_path):
    monkeypatch.setattr(merge_table, "MOST_DELTAS", 5)
    rng = random.Random(4)
    want = {i: (i, f"a{i}", float(i), i % 3) for i in range(40)}
    table.put(spark.createDataFrame(list(want.values()), ROW))
    for step in range(14):
        kind = ("patch", "patch", "delete", "put")[step % 4]
        ids = rng.sample(range(50), 6)
        if kind == "put":
            new = [(i, f"p{step}", None, step) for i in ids]
            table.put(spark.createDataFrame(new, ROW))
            want.update({r[0]: r for r in new})
        elif kind == "delete":
            table.delete(spark.createDataFrame([(i,) for i in ids * 2], "id long"))
            for i in ids:
                want.pop(i, None)
        else:
            new = [(i, rng.sample(["a", "b"], rng.randint(0, 2)), None if i % 5 == 0 else f"x{step}", step / 7) for i in ids]
            table.patch(spark.createDataFrame(new, PATCH))
            for i, names, a, b in new:
                if i in want:
                    old = want[i]
                    want[i] = (i, a if "a" in names else old[1], b if "b" in names else old[2], old[3])
        if step % 5 == 4:
            assert rows(table.read()) == sorted(want.values())
    assert rows(table.read()) == sorted(want.values())
    assert len(table.manifest()["deltas"]) < 5
    table.compact()
    assert rows(table.read()) == sorted(want.values()) and table.manifest()["deltas"] == []
    table.vacuum(keep=1)
    left = [n for n in os.listdir(f"{tmp_path}/t") if n.startswith(("base-", "delta-"))]
    assert len(left) == 1 and rows(table.read()) == sorted(want.values())


def test_readers_see_old_or_new_during_compaction(spark, table):
    table.put(spark.createDataFrame([(1, "a", 1.0, 1), (2, "b", 2.0, 2)], ROW))
    old = table.read()
    version = table.patch(spark.createDataFrame([(1, ["a"], "new", None)], PATCH))
    create, seen = table._create, []

    def slow(manifest):
        """Another writer changes the table just before the compaction commits."""
        if not seen:
            seen.append(rows(table.read()))
            table._create = create
            table.delete(spark.createDataFrame([(2,)], "id long"))
        return create(manifest)

    table._create = slow
    table.compact()
    assert seen == [[(1, "new", 1.0, 1), (2, "b", 2.0, 2)]]
    assert rows(table.read()) == [(1, "new", 1.0, 1)]
    assert [d["kind"] for d in table.manifest()["deltas"]] == ["delete"]
    assert rows(old) == [(1, "a", 1.0, 1), (2, "b", 2.0, 2)] and rows(table.read(version))[0][1] == "new"


def test_refused_and_empty_changes(spark, table):
    assert rows(table.read()) == [] and table.compact() == 0 and table.vacuum() == []
    table.patch(spark.createDataFrame([(1, ["a"], "x", None)], PATCH))
    assert rows(table.read()) == []
    table.put(spark.createDataFrame([(1, "a", 1.0, 1)], ROW))
    before = table.manifest()
    for bad in ([(1, "a", 1.0, 1), (1, "b", 2.0, 2)], [(None, "a", 1.0, 1)]):
        with pytest.raises(ValueError):
            table.put(spark.createDataFrame(bad, ROW))
    with pytest.raises(ValueError):
        table.patch(spark.createDataFrame([(1, ["z"], 1)], "id long, update_keys array<string>, z int"))
    assert table.manifest() == before
    table.patch(spark.createDataFrame([(1, ["a", "b"], None, 5.0)], PATCH))
    assert rows(table.read()) == [(1, None, 5.0, 1)]
    table.delete(spark.createDataFrame([(1,), (7,)], "id long"))
    table.patch(spark.createDataFrame([(1, ["a"], "back", None)], PATCH))
    assert rows(table.read()) == []


def test_only_one_writer_gets_a_version(spark, table):
    now = {**table.manifest(), "version": 1}
    table._fs.mkdirs(table._path(f"{table.path}/_manifests"))
    assert table._create(now) and not table._create(now)
    table.put(spark.createDataFrame([(1, "a", 1.0, 1)], ROW), ("w", 3))
    version = table.put(spark.createDataFrame([(1, "again", 1.0, 1)], ROW), ("w", 3))
    assert version == table.manifest()["version"] == 2 and rows(table.read()) == [(1, "a", 1.0, 1)]


def test_stream_into_a_table(spark, table, monkeypatch, tmp_path):
    monkeypatch.setattr(merge_table, "MOST_DELTAS", 2)
    want = {}
    for part in range(5):
        new = [(i % 4, f"v{part}", float(part), i) for i in range(part, part + 6)]
        want.update({r[0]: r for r in new})
        spark.createDataFrame(new, ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        df = S.stream_logs(spark, f"{tmp_path}/in", table.schema)
        merge_stream(df, table, f"{tmp_path}/c", "s", S.ONCE, ["c"]).awaitTermination()
        assert rows(table.read()) == sorted(want.values()) and len(table.manifest()["deltas"]) < 2


def test_a_dead_writers_claim_is_given_up(spark, table, monkeypatch):
    monkeypatch.setattr(merge_table, "STALE_SECONDS", 0)
    table._fs.create(table._path(f"{table.path}/_manifests/.claim-1"), False).close()
    assert table.put(spark.createDataFrame([(1, "a", 1.0, 1)], ROW)) == 1 and rows(table.read()) == [(1, "a", 1.0, 1)]
