"""Growing files as a stream: appended lines, half lines, rotation and restarts, each line once."""

import os

import pytest
from pyspark.sql import functions as F

from runweave.sources import tailing
from runweave.streaming import live as S


def lines(n, start=0, name="a"):
    return [f"{name} line {i} é{'x' * (i % 90)}" for i in range(start, start + n)]


def put(path, text, mode="ab"):
    with open(path, mode) as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def run(spark, tmp_path, **kw):
    assert S.tail_logs(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c", **kw)
    return sorted(r.value for r in spark.read.text(f"{tmp_path}/out").collect())


def test_grown_rotated_and_restarted(spark, tmp_path):
    """Every run is a new query from the checkpoint, so each is a restart."""
    os.mkdir(f"{tmp_path}/in")
    log = f"{tmp_path}/in/job.log"
    want = lines(300)
    put(log, "\n".join(want) + "\nhalf of a")
    assert run(spark, tmp_path) == sorted(want)
    # The half line is finished, more follow, and a second file appears.
    put(log, " line\n" + "\n".join(lines(50, 300)) + "\n")
    put(f"{tmp_path}/in/other.log", "\n".join(lines(20, name="b")) + "\n")
    want += ["half of a line", *lines(50, 300), *lines(20, name="b")]
    assert run(spark, tmp_path) == sorted(want)
    # Lines come, then the log is renamed and a new one begun under its name.
    put(log, "\n".join(lines(30, 350)) + "\n")
    os.rename(log, f"{tmp_path}/in/job.log.1")
    put(log, "\n".join(lines(40, name="c")) + "\n")
    want += [*lines(30, 350), *lines(40, name="c")]
    assert run(spark, tmp_path) == sorted(want)
    # The writer still has the old file, and writes to both.
    put(f"{tmp_path}/in/job.log.1", "last words\n")
    put(log, "c more\n")
    want += ["last words", "c more"]
    assert run(spark, tmp_path) == sorted(want)
    assert run(spark, tmp_path) == sorted(want)
    # Cut to nothing and begun anew, shorter than before.
    put(log, "fresh start\n", "wb")
    assert run(spark, tmp_path) == sorted([*want, "fresh start"])


def test_one_query_that_goes_on(spark, tmp_path):
    os.mkdir(f"{tmp_path}/in")
    log, want = f"{tmp_path}/in/x.log", []
    query = S.append_stream(
        tailing.tail_lines(spark, f"{tmp_path}/in", range_bytes=700), f"{tmp_path}/t", f"{tmp_path}/c", {"processingTime": "0 seconds"}
    )
    try:
        for step in range(4):
            if step == 2:
                os.rename(log, f"{tmp_path}/in/x.log.1")
            new = lines(60, 60 * step)
            put(log, "\n".join(new) + "\n")
            want += new
            query.processAllAvailable()
    finally:
        query.stop()
    got = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(r.line for r in got.collect()) == sorted(want)
    assert got.groupBy("id", "at").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("range_bytes", [1, 7, 64, 1000, 1 << 20])
def test_ranges_cut_anywhere(tmp_path, monkeypatch, range_bytes):
    monkeypatch.setattr(tailing, "BATCH_BYTES", 50)
    monkeypatch.setattr(tailing, "LOOK_BYTES", 16)
    text = b"\n\nfirst\r\n" + b"y" * 200 + b"\n" + "é日本\n".encode() * 9 + b"\xff broken\n\n" + b"no end"
    put(f"{tmp_path}/f", text)
    reader = tailing.TailReader({"folder": str(tmp_path), "range_bytes": str(range_bytes)})
    end = reader.latestOffset()
    got = []
    for part in reader.partitions(reader.initialOffset(), end):
        for batch in reader.read(part):
            got += list(zip(batch.column("at").to_pylist(), batch.column("line").to_pylist()))
    want, at = [], 0
    for line in text.split(b"\n")[:-1]:
        want.append((at, line.removesuffix(b"\r").decode("utf-8", "replace")))
        at += len(line) + 1
    assert got == want
    assert reader.partitions(end, reader.latestOffset()) == []


def test_a_batch_planned_before_a_rename(tmp_path):
    put(f"{tmp_path}/f", "one\ntwo\n")
    reader = tailing.TailReader({"folder": str(tmp_path)})
    (part,) = reader.partitions({"files": {}}, reader.latestOffset())
    os.rename(f"{tmp_path}/f", f"{tmp_path}/f.1")
    put(f"{tmp_path}/f", "three\n")
    again = tailing.TailReader({"folder": str(tmp_path)})
    assert [b.column("line").to_pylist() for b in again.read(part)] == [["one", "two"]]
    os.remove(f"{tmp_path}/f.1")
    with pytest.raises(FileNotFoundError):
        list(again.read(part))


def test_unchanged_files_are_not_opened(tmp_path):
    for i in range(3):
        put(f"{tmp_path}/f{i}", f"{i}\n")
    put(f"{tmp_path}/.hidden", "x\n")
    put(f"{tmp_path}/empty", "")
    reader = tailing.TailReader({"folder": str(tmp_path), "glob": "*"})
    first = reader.latestOffset()
    assert len(first["files"]) == 3
    opened, look = [], reader._identity
    reader._identity = lambda path, *a: (opened.append(path), look(path, *a))[1]
    assert reader.latestOffset() == first and not opened
    put(f"{tmp_path}/f1", "more\n")
    reader.latestOffset()
    assert [os.path.basename(p) for p in opened] == ["f1"]


def test_missing_folder_and_glob(spark, tmp_path):
    reader = tailing.TailReader({"folder": f"{tmp_path}/none"})
    assert reader.latestOffset() == {"files": {}}
    os.mkdir(f"{tmp_path}/in")
    put(f"{tmp_path}/in/a.log", "yes\n")
    put(f"{tmp_path}/in/a.txt", "no\n")
    assert run(spark, tmp_path, glob="*.log") == ["yes"]
    assert S.tail_logs(spark, f"file://{tmp_path}/in", f"{tmp_path}/out2", f"{tmp_path}/c2")
    assert spark.read.text(f"{tmp_path}/out2").agg(F.count("*")).first()[0] == 2
