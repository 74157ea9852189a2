"""WARC files and the url filter."""

import base64
import gzip
import hashlib
import io
import random
import uuid

import pytest
from pyspark.sql import functions as F

from runweave.llm import urls, warc
from runweave.llm.queries import URL_RULES
from runweave.session import shared_folder


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}".removeprefix("file://")


PAGES = [
    (3, "http://a.example/ x\r\ny", "<p>é</p>"),
    (1, None, "<p>é</p>"),
    (7, "http://b", None),
    (5, "http://b", ""),
    (9, "u", "z" * 300_000),
    (9, "u", "z" * 300_000),
    (None, "u", "z" * 300_000),
    (None, "v", "alone"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    warc.write_warc(warc.page_records(df), folder)
    rows = warc.read_warc(spark, folder).collect()
    assert len(rows) == len(PAGES)
    first = {}
    for i, _, t in PAGES:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    text_of = {digest(t): t or "" for _, _, t in PAGES}
    for r in rows:
        text = text_of[r.payload_digest.removeprefix("sha1:")]
        assert r.payload_bytes == len(text.encode())
        if r.record_type == "response":
            assert bytes(r.payload) == text.encode() and r.refers_to is None
        else:
            assert r.payload is None and r.refers_to == f"<urn:page:{first[text]}>"
    got = sorted((r.record_id, r.record_type) for r in rows)
    assert got == sorted(
        (f"<urn:page:{'' if i is None else i}>", "response" if i == first.get(t or "") or (t or "") not in first else "revisit")
        for i, _, t in PAGES
    )
    assert {r.target_uri for r in rows} >= {None, "http://a.example/%20x%0D%0Ay"}


def test_predicates_reach_the_reader(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_warc(warc.page_records(df), folder)
    found = warc.read_warc(spark, folder).where("record_type = 'revisit' and target_uri in ('http://b', 'u')")
    assert sorted(r.record_id for r in found.collect()) == ["<urn:page:7>", "<urn:page:>"]
    reader = warc.WarcReader(folder, 1 << 20, True)
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")])) == []
    revisits = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert revisits == warc.read_warc(spark, folder).where("record_type = 'revisit'").count() == 3
    assert [r.payload for r in warc.read_warc(spark, folder, payload="false").collect()] == [None] * len(PAGES)
    parts = warc.WarcReader(folder, 1, True).partitions()
    assert len(parts) >= 1 and all(len(p.names) == 1 for p in parts)


def test_empty_table_and_short_payloads(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_warc(warc.page_records(df.limit(0)), folder)
    assert warc.read_warc(spark, folder).count() == 0
    some = warc.page_records(df, least_bytes=100)
    assert {r.record_id for r in some.where("record_type = 'revisit'").collect()} == {"<urn:page:>"}


def rows():
    return [
        {"record_type": "response", "record_id": f"<urn:page:{i}>", "target_uri": None, "payload_digest": None, "refers_to": None,
         "payload_bytes": None, "payload": bytes([65 + i]) * (i * 4999)}
        for i in range(20)
    ]


@pytest.mark.parametrize("form", ["members", "foreign members", "plain"])
@pytest.mark.parametrize("every", [1, 2, 50])
def test_records_are_skipped_or_read(form, every):
    made = [warc.record(r, "2024-01-01T00:00:00Z") for r in rows()]
    assert gzip.decompress(made[3]).startswith(b"WARC/1.1\r\n")
    if form == "foreign members":  # without the length of the member
        made = [gzip.compress(gzip.decompress(m)) for m in made]
    if form == "plain":
        made = [gzip.decompress(m) for m in made]
    data = b"".join(made)
    seen = 0
    for i, (headers, block) in enumerate(warc._Members(io.BytesIO(data), len(data))):
        assert headers["warc-record-id"] == f"<urn:page:{i}>"
        if i % every == 0:
            assert block().partition(b"\r\n\r\n")[2] == rows()[i]["payload"]
        seen += 1
    assert seen == 20


class Counting(io.BytesIO):
    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


@pytest.mark.parametrize("form", ["members", "plain"])
def test_headers_alone_leave_the_payload_unread(form):
    payload = random.Random(1).randbytes(3_000_000)
    row = rows()[0] | {"payload": payload}
    made = warc.record(row, "2024-01-01T00:00:00Z")
    data = (gzip.decompress(made) if form == "plain" else made) * 4
    stream, seen = Counting(data), 0
    for _, block in warc._Members(stream, len(data)):
        head, gap, rest = block(head_only=True).partition(b"\r\n\r\n")
        assert gap and b"Content-Length: 3000000" in head and payload.startswith(rest) and len(rest) < 100_000
        seen += 1
    assert seen == 4 and stream.got < 1_000_000


def test_verified_lengths_and_digests_come_from_payloads(spark, folder):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    records = warc.page_records(df)
    warc.write_warc(records, folder)
    got = sorted(map(str, warc.verified(spark, folder).select("record_id", "record_type", "payload_bytes", "payload_digest").collect()))
    want = sorted(map(str, records.select("record_id", "record_type", "payload_bytes", "payload_digest").collect()))
    assert got == want
    # Headers that tell another digest and length than the payload has.
    false = records.withColumn("payload_digest", F.lit("sha1:no")).withColumn("payload_bytes", F.lit(5).cast("bigint"))
    warc.write_warc(false, folder + "-false")
    for r in warc.verified(spark, folder + "-false").collect():
        assert (r.payload_digest is None) == (r.record_type == "revisit") and r.payload_digest != "sha1:no"
        assert r.payload_bytes is None or r.record_type == "response"
    warc.write_warc(records.limit(0), folder + "-none")
    assert warc.verified(spark, folder + "-none").collect() == []


URLS = [
    ("http://x.net/a", "x.net", "/a", "net/", "block"),
    ("https://A.Example.NET/en/1?q#f", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/fr/", "example.net", "/fr/", "net/", "block"),
    ("http://sub.example.com/de/1", "sub.example.com", "/de/1", "example.com/de/", "block"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, None),
    ("http://w.org/fr/2", "w.org", "/fr/2", "org/fr/", "allow"),
    ("http://net", "net", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("no scheme", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
    ("x://?a/b", "", "", None, None),
    ("x://h\ni/p\nq", "h\ni", "/p\nq", None, None),
    ("http://" + "very-long." * 500 + "net/x", "very-long." * 500 + "net", "/x", "net/", "block"),
]


def test_rules_and_parts_of_urls(spark):
    model = urls.train(spark.createDataFrame(urls.LABELLED, "url string, label int"))
    df = spark.createDataFrame([(i, u[0], "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    for r in urls.judge(df, URL_RULES, model).collect():
        _, host, path, rule, verdict = URLS[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        p = model.probability([host], [path])[0]
        assert abs(r.score - p) < 1e-12 and r.verdict == (verdict or ("block" if p >= 0.5 else "allow"))
    assert urls.judge(df.limit(0), URL_RULES, model).count() == 0


def test_model_learns_its_table(spark):
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    model = urls.train(labelled)
    found = urls.judge(labelled.selectExpr("label page_id", "url"), [], model).collect()
    assert sum((r.verdict == "block") == r.page_id for r in found) >= 0.95 * len(found)
    # Each half of the table judges the other one well enough.
    right = 0
    for k in (0, 1):
        part = [u for i, u in enumerate(urls.LABELLED) if i % 2 == k]
        rest = [u for i, u in enumerate(urls.LABELLED) if i % 2 != k]
        half = urls.train(spark.createDataFrame(part, "url string, label int"))
        judged = urls.judge(spark.createDataFrame(rest, "url string, page_id int"), [], half).collect()
        right += sum((r.verdict == "block") == r.page_id for r in judged)
    assert right >= 0.75 * len(urls.LABELLED)
    nothing = urls.train(labelled.limit(0))
    assert nothing.probability(["a"], ["/"])[0] < 0.5


def test_payloads_are_grouped_by_one_hash(spark):
    # A digest of 32 letters below a group hashed the payload for each of them.
    pages = spark.createDataFrame([(1, "u", "a"), (2, "v", "a"), (3, None, None)], "page_id bigint, url string, html string")
    found = warc.page_records(pages)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert max(line.count("sha1(") for line in plan) == 1
    for row in found.collect():
        raw = {"<urn:page:3>": b""}.get(row.record_id, b"a")
        assert row.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert row.refers_to == ("<urn:page:1>" if row.record_id == "<urn:page:2>" else None)
