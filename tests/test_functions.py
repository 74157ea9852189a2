"""Column functions on literal edge cases."""

import hashlib
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from runweave.functions import fields, paths, schedule, text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("out")).collect()[0].out


def each(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn("v").alias("out")).orderBy("i").collect()]


def test_strip_path(spark):
    values = ["./a/b.txt/", "../.env", "a", "", "..//.."]
    assert each(spark, values, paths.strip_path) == [v.strip("./") for v in values]


def test_content_type(spark):
    import os

    table = {".txt": "text/plain", ".gz": "application/gzip"}
    names = ["a.txt", "A.TXT", "b.tar.gz", "noext", ".txt", "..txt", "d.txt/x", "x.", "a/.b.txt", "", "a.unknown"]
    want = [
        table.get(os.path.splitext(n)[1].lower(), "application/octet-stream") for n in names
    ]
    assert each(spark, names, lambda c: paths.content_type(c, table)) == want


def test_path_join_and_folder(spark):
    import posixpath

    for a, b in [("a", "b"), ("a/", "b"), ("", "b"), ("a", "/b"), ("a", "")]:
        got = one(spark, paths.path_join(F.col("a"), F.col("b")), a=a, b=b)
        assert got == posixpath.join(a, b)
    names = ["/a/b", "/a", "a/b/c", "a", "/", "a/"]
    assert each(spark, names, paths.parent_folder) == [posixpath.split(n)[0] for n in names]


def test_uuid(spark):
    good = str(uuid.uuid4())
    values = [good, "{" + good + "}", "urn:uuid:" + good, good.replace("-", ""), good.upper(),
              "", "x", good[:-1], good + "0", "g" * 32, None]
    def want(v):
        try:
            uuid.UUID(v)
            return True
        except (ValueError, TypeError):
            return False
    assert each(spark, values, text.is_valid_uuid) == [want(v) for v in values]


def test_hash(spark):
    assert one(spark, text.hash_item("v"), v=12) == hashlib.md5(b"12").hexdigest()
    assert one(spark, text.hash_item("v", "sha512"), v="é") == hashlib.sha512("é".encode()).hexdigest()
    with pytest.raises(ValueError):
        text.hash_item("v", "crc")


def test_b64(spark):
    import base64

    long = "é" * 200
    assert one(spark, text.to_b64("v"), v=long) == base64.b64encode(long.encode()).decode()
    assert one(spark, text.from_b64(text.to_b64("v")), v=long) == long


def test_scrub(spark):
    values = ["https://ghp_ab12@github.com/x", "https://ghp_ab12@other.com/x", "git@github.com:x", None]
    assert each(spark, values, text.scrub_tokens) == [
        "https://github.com/x", "https://ghp_ab12@other.com/x", "git@github.com:x", None,
    ]


def test_round_sig4(spark):
    values = [959.15, 1000.5, 1001.5, 0.000123456, -12345.6, 0.0, 1e300, 16777216.0, None]
    want = [None if v is None else float(f"{v:.4g}") for v in values]
    assert each(spark, values, text.round_sig4, "double") == want


def test_headline(spark):
    values = ["one", "a long first line\nsecond", "ends\n", "x\r\ny", "", "\n"]
    assert each(spark, values, text.log_headline) == ["one", "a long fir...", "ends", "x...", "", ""]


def test_times(spark):
    ns = 1704078023688079123
    assert one(spark, F.date_format(text.ns_to_time("v"), "ss.SSSSSS"), v=ns) == "23.688079"
    assert one(spark, F.unix_micros(text.ns_to_time("v")), v=-1500) == -2
    assert one(spark, text.time_text(text.epoch_to_time("v")), v=0) == "1970-01-01 00:00:00.000000"


def test_normalize_numbers(spark):
    df = spark.sql("select named_struct('a', 3.0d, 'b', array(1.5d, 2.0d), 'c', named_struct('d', -4.0d), 'e', 'x', 'n', cast(null as double)) s")
    out = text.normalize_numbers("s", df.schema["s"].dataType)
    assert df.select(F.to_json(out).alias("j")).collect()[0].j == '{"a":3,"b":[1.5,2],"c":{"d":-4},"e":"x"}'


def test_resource(spark):
    got = one(spark, text.resolve_resource("u", "s", "128m"), u="", s="2")
    assert got == "2"
    assert one(spark, text.resolve_resource("u", "s", 2), u=0, s=0) == 2


def test_merge_keeps_null(spark):
    df = spark.sql("select map('a', 'x', 'b', 'y') d, map('b', cast(null as string), 'c', 'z') p")
    assert df.select(text.merge_kwargs("d", "p").alias("m")).collect()[0].m == {"a": "x", "b": None, "c": "z"}


NEST = "select named_struct('b', named_struct('c', 1), 'd', 'x') a, 0 n, '' t, array() l, false f"


def test_get_field(spark):
    df = spark.sql(NEST)
    row = df.select(
        fields.get_field(df, "a.b.c").alias("x"), fields.get_field(df, "a.z", 9).alias("y")
    ).collect()[0]
    assert (row.x, row.y) == (1, 9)
    with pytest.raises(KeyError):
        fields.get_field(df, "a.z")


def test_set_field_creates_parents(spark):
    df = fields.set_field(spark.sql(NEST), "a.new.deep", 7)
    df = fields.set_field(df, "other.x.y", 8)
    row = df.collect()[0]
    assert (row.a.b.c, row.a.d, row.a.new.deep, row.other.x.y) == (1, "x", 7, 8)


def test_set_default_replaces_falsy(spark):
    df = spark.sql("select 0 n, '' t, cast(array() as array<int>) l, false f, 5 five, cast(null as int) z")
    for name, value in [("n", 1), ("t", "d"), ("l", [1]), ("f", True), ("five", 6), ("z", 3)]:
        value = F.array(F.lit(1)) if name == "l" else value
        df = fields.set_default(df, name, value)
    row = fields.set_default(df, "fresh", "v").collect()[0]
    assert (row.n, row.t, row.l, row.f, row.five, row.z, row.fresh) == (1, "d", [1], True, 5, 3, "v")


def cron(spark, hour, minute, days=None, months=None, **kw):
    df = spark.createDataFrame(
        [(hour, minute, days, months)], "hour int, minute int, days array<string>, months array<string>"
    )
    out = schedule.cron_expr(F.col("hour"), F.col("minute"), F.col("days"), F.col("months"), **kw)
    return df.select(out.alias("c")).collect()[0].c


def test_cron(spark):
    assert cron(spark, 16, 20) == "20 16 * * *"
    assert cron(spark, 4, 20, ["fri"]) == "20 4 * * 5"
    assert cron(spark, 4, 20, ["fri", "sun"], ["jan", "feb"]) == "20 4 * 1,2 5,0"
    assert cron(spark, 1, None) == "0 */1 * * *"
    assert cron(spark, 1, None, minute_of_hour=15) == "15 */1 * * *"
    assert cron(spark, None, 69) == "*/9 */1 * * *"
    assert cron(spark, None, 20) == "*/20 * * * *"
    for bad in [(None, None), (24, 0), (0, 60), (None, 24 * 60), (1, 1, ["day"]), (1, 1, None, ["x"])]:
        assert cron(spark, *bad) is None


def test_fire_times_end_inclusive(spark):
    start = datetime(2024, 1, 1, 16, 20)
    df = spark.createDataFrame(
        [("a", 16, 20, None, None, start, datetime(2024, 1, 3, 16, 20)),
         ("b", None, 45, None, None, start, datetime(2024, 1, 1, 18, 0)),
         ("w", 1, 0, ["sun"], ["jan"], start, None)],
        "id string, hour int, minute int, days array<string>, months array<string>, starts timestamp, ends timestamp",
    )
    got = sorted((r.id, r.fire_at.strftime("%d %H:%M")) for r in schedule.schedule_fire_times(df).collect())
    assert got == [
        ("a", "01 16:20"), ("a", "02 16:20"), ("a", "03 16:20"),
        ("b", "01 16:45"), ("b", "01 17:00"), ("b", "01 17:45"), ("b", "01 18:00"),
        ("w", "07 01:00"),
    ]


def test_round_sig4_of_floats(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    some = (rng.normal(size=400) * 10.0 ** rng.integers(-30, 30, 400)).astype("float32").tolist()
    ties = [0.0, -0.0, 12345.0, 12355.0, -12345.0, 0.5, 1.00048828125, 1000.5, 1001.5, 99995.0, 10.0625, 959.15, 1e-42, 3.4e38]
    some += [float(np.float32(x)) for x in ties] + [None, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in some], "v float").select("v", text.round_sig4_float("v").alias("r"))
    for v, r in df.collect():
        want = None if v is None else float(f"{v:.4g}")
        assert r == want or (want != want and r != r), (v, r)
