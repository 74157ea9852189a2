"""WARC files as a PySpark Python data source: ``format("warc")``.

Reading plans one partition a file, or several where small files add up to a target size. Equality and
membership predicates on the record type and on the other header columns are taken over by the reader,
which looks at a record's headers first: the payload of a record that is not wanted, or where no payload is
wanted, is skipped beyond the HTTP headers, which give its length. Files hold one gzip member a record; the writer puts the member's length in its
``sl`` extra field, and the reader then jumps over the rest of a member; without the field it has to
inflate, but still decodes and keeps nothing.

Writing makes files of a target size, named by task and attempt. On commit the list of the files of the
attempts that won is written as ``_MANIFEST``, and a folder with a manifest is read by it, so that
leftovers of failed attempts are never seen.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceArrowWriter,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from runweave.llm.common import stored

TARGET = 64 << 20
MANIFEST = "_MANIFEST"
BATCH_BYTES = 8 << 20

#: Columns, and the header each comes from; the payload and its length come from the HTTP block.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
READ = ", ".join(f"{c} string" for c in HEADERS) + ", payload_bytes bigint, payload binary"
WRITE = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, payload_bytes bigint, payload binary"


def _files(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return fs.LocalFileSystem(), path


def header_value(text: str) -> str:
    """A value that cannot break out of its line: controls and white space are percent-encoded."""
    return "".join(quote(c) if ord(c) <= 32 or ord(c) == 127 else c for c in text)


def record(row: dict, date: str) -> bytes:
    """One record as a gzip member. A revisit has the HTTP headers only, the length among them."""
    payload = row["payload"] or b""
    size = row["payload_bytes"] if row["payload_bytes"] is not None else len(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (b"" if row["record_type"] == "revisit" else payload)
    lines = ["WARC/1.1", f"WARC-Date: {date}"]
    for column in ("record_type", "record_id", "target_uri", "payload_digest", "refers_to"):
        if row[column] is not None:
            lines.append(f"{HEADERS[column]}: {header_value(row[column])}")
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    plain = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    # gzip header with one extra field "sl": length of the member, length of its content (both modulo 2**32)
    head = 10 + 2 + 12
    extra = struct.pack("<2sHII", b"sl", 8, (head + len(body) + 8) & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    start = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return start + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


@dataclass
class Wrote(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, target: int, date: str) -> None:
        self.path, self.target, self.date, self.run = path, target, date, uuid.uuid4().hex[:12]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Wrote:
        from pyspark import TaskContext

        store, base = _files(self.path)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"{self.run}-{task.partitionId():05d}-{task.taskAttemptId()}"
        files, out, size = [], None, 0

        def close() -> None:
            if out is not None:
                out.close()
                files.append((name, size))

        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    name, size = f"{stem}-{len(files):04d}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                # One row at a time becomes Python objects, so memory holds one payload twice at most.
                member = record(batch.slice(i, 1).to_pylist()[0], self.date)
                out.write(member)
                size += len(member)
                if size >= self.target:
                    close()
                    out = None
        close()
        return Wrote(files)

    def commit(self, messages: list[Wrote | None]) -> None:
        store, base = _files(self.path)
        store.create_dir(base, recursive=True)
        files = [f for m in messages if m for f in m.files]
        with store.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[Wrote | None]) -> None:
        store, base = _files(self.path)
        for name, _ in [f for m in messages if m for f in m.files]:
            store.delete_file(f"{base}/{name}")


@dataclass
class Files(InputPartition):
    names: list[str]


class _Members:
    """The records of one stream, gzip members or plain: headers first, the block on demand."""

    def __init__(self, stream, size: int) -> None:
        self.stream, self.size, self.at = stream, size, 0
        self.held = b""

    def _more(self, n: int) -> bytes:
        if len(self.held) < n:
            parts, have = [self.held], len(self.held)
            while have < n and (got := self.stream.read(max(n - have, 1 << 16))):
                parts.append(got)
                have += len(got)
            self.held = b"".join(parts)
        return self.held

    def _skip(self, n: int) -> None:
        """Forward by ``n`` raw bytes: by a seek where they are not read yet."""
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.stream.seek(self.stream.tell() + n - len(self.held))
            self.held = b""

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        while True:
            head = self._more(12)
            blank = len(head) - len(head.lstrip(b"\r\n\0"))
            if not head:
                return
            if blank:
                self._skip(blank)
            elif head[:2] == b"\x1f\x8b":
                yield from self._member()
            else:
                yield from self._plain()

    def _member(self):
        head = self._more(12)
        length = None
        if head[3] & 4:
            n = struct.unpack("<H", head[10:12])[0]
            extra = self._more(12 + n)[12 : 12 + n]
            while len(extra) >= 4:
                name, k = struct.unpack("<2sH", extra[:4])
                if name == b"sl" and k == 8:
                    length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + k :]
        inflate = zlib.decompressobj(31)
        data, fed, ended = bytearray(), 0, False

        def feed(size: int, keep: bool) -> bool:
            """Inflate some more; ``keep`` its output."""
            nonlocal fed, ended
            raw = self._more(1)
            if ended or not raw:
                return False
            got = inflate.decompress(raw[: 1 << 16] if not inflate.unconsumed_tail else inflate.unconsumed_tail, size)
            if inflate.eof or not inflate.unconsumed_tail:
                used = min(len(raw), 1 << 16) - len(inflate.unused_data)
                fed += used
                self._skip(used)
            if keep:
                data.extend(got)
            ended = inflate.eof
            return True

        while (end := data.find(b"\r\n\r\n")) < 0 and feed(1 << 12, True):
            pass
        headers = _headers(bytes(data[: max(end, 0)]))
        taken = False

        def block(head_only: bool = False) -> bytes:
            """The block, or its beginning with the inner headers, after which nothing is inflated."""
            nonlocal taken
            start = end + 4
            if head_only:
                while data.find(b"\r\n\r\n", start) < 0 and feed(1 << 12, True):
                    pass
            else:
                taken = True
                while feed(1 << 20, True):
                    pass
            return bytes(data[start : start + int(headers.get("content-length", 0))])

        yield headers, block
        if taken or ended:
            return
        if length is not None:
            self._skip(length - fed)
        else:
            while feed(1 << 20, False):
                pass

    def _plain(self):
        n = 1 << 12
        while (end := self._more(n).find(b"\r\n\r\n")) < 0 and len(self.held) >= n:
            n *= 2
        if end < 0:
            raise ValueError("a record's headers do not end")
        headers = _headers(self.held[:end])
        self._skip(end + 4)
        size, taken = int(headers.get("content-length", 0)), False

        def block(head_only: bool = False) -> bytes:
            nonlocal taken
            if head_only:
                n = 1 << 12
                while self._more(min(n, size)).find(b"\r\n\r\n", 0, size) < 0 and n < size:
                    n *= 2
                return self.held[: min(n, size)]
            taken = True
            out = self._more(size)[:size]
            self._skip(size)
            return out

        yield headers, block
        if not taken:
            self._skip(size)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, target: int, payload: bool) -> None:
        self.path, self.target, self.payload = path, target, payload
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif not (isinstance(f, IsNotNull) and column == "payload_bytes"):
                yield f

    def partitions(self) -> list[Files]:
        store, base = _files(self.path)
        try:
            with store.open_input_stream(f"{base}/{MANIFEST}") as f:
                found = [(f"{base}/{name}", size) for name, size in json.loads(f.read())]
        except FileNotFoundError:
            listed = store.get_file_info(fs.FileSelector(base, recursive=True))
            if isinstance(listed, fs.FileInfo):
                listed = [listed]
            found = [(f.path, f.size) for f in listed if f.path.endswith((".warc", ".warc.gz"))]
        parts, held = [], 0
        for name, size in sorted(found):
            if not parts or held + size > self.target:
                parts.append(Files([]))
                held = 0
            parts[-1].names.append(name)
            held += size
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _files(self.path)
        rows, held = [], 0
        for name in partition.names:
            info = store.get_file_info(name)
            with store.open_input_file(name) as stream:
                for headers, block in _Members(stream, info.size):
                    row = [headers.get(h.lower()) for h in HEADERS.values()]
                    if any(row[i] not in self.wanted[c] for i, c in enumerate(HEADERS) if c in self.wanted):
                        continue
                    http = (row[-1] or "").startswith("application/http")
                    payload, size = None, int(headers.get("content-length", 0))
                    if http or self.payload:
                        data = block(head_only=not self.payload)
                        if http:
                            head, gap, data = data.partition(b"\r\n\r\n")
                            left = size - len(head) - len(gap)
                            size = next((int(x[15:]) for x in head.split(b"\r\n") if x[:15].lower() == b"content-length:"), left)
                        payload = data if self.payload and row[0] != "revisit" else None
                    rows.append((*row, size, payload))
                    held += len(payload or b"") + 500
                    if held >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


_ARROW = pa.schema([*[(c, pa.string()) for c in HEADERS], ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


class WarcSource(DataSource):
    """Options: ``path``, ``target`` (bytes of a partition or file), ``payload`` (false: inflated up to the
    end of the inner headers, the rest skipped), ``date`` (of written records)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> WarcReader:
        target = int(self.options.get("target", TARGET))
        return WarcReader(self.options["path"], target, self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        date = self.options.get("date", "1970-01-01T00:00:00Z")
        return WarcWriter(self.options["path"], int(self.options.get("target", TARGET)), date)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known and let predicates reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records under ``path``: header columns, ``payload_bytes`` of the full payload, ``payload`` (null in a
    revisit). Without files, or with files without records, there are no rows; a header that a record lacks is null."""
    register(spark)
    return spark.read.format("warc").options(path=path, **options).load()


def verified(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, record_type, refers_to, payload_bytes, payload_digest)`` of the responses and revisits under ``path``.

    Length and digest are those of the stored payload: a response's own, a revisit's from the response that it
    refers to and whose payload has the digest that it names; null where there is none. Only responses are
    decoded; of revisits the headers are read. Records with equal ids all come back.
    """
    own = read_warc(spark, path).where(F.col("record_type") == "response")
    own = own.select(
        "record_id",
        "record_type",
        "refers_to",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.concat(F.lit("sha1:"), digest(F.col("payload"))).alias("payload_digest"),
    )
    own = stored(own, "warc-responses")
    held = own.select(F.col("record_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    held = held.withColumn("digest", F.col("payload_digest"))
    other = read_warc(spark, path, payload="false").where(F.col("record_type") == "revisit")
    other = other.drop("payload_bytes").join(held, ["refers_to", "payload_digest"], "left")
    names = ["record_id", "record_type", "refers_to", "payload_bytes"]
    return own.union(other.select(*names, F.col("digest").alias("payload_digest")))


def write_warc(df: DataFrame, path: str, **options) -> None:
    """Write records (the columns of ``WRITE``; others are not looked at) below ``path``, a new folder."""
    register(df.sparkSession)
    names = [c.split(" ")[0] for c in WRITE.split(", ")]
    df.select(*names).write.format("warc").mode("append").options(path=path, **options).save()


def digest(payload) -> F.Column:
    """Base32 of the SHA-1 of a binary column, in upper case."""
    return base32(F.sha1(payload))


def base32(hexed: F.Column) -> F.Column:
    """Base32, in upper case, of 40 hex digits: a column, since it is read once for each of the 32 letters."""
    # 40 hex digits are 8 groups of 20 bits, and each of these 4 letters of base32.
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for g in range(8):
        bits = F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substr(letters, F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*out)


ID = "urn:page:"


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Records for ``(page_id, url, html)``: of equal payloads the one with the smallest id is the response.

    The others revisit it; payloads under ``least_bytes`` are all responses. A null html is an empty
    payload, a null url gives no target header, rows with a null id are written with an empty id (the first
    of a payload only if no row has one). Repeated rows of the first page are all responses.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").alias("target_uri"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    # Grouped and joined by the plain hash: as a group's key, all letters of the digest would hash the payload each.
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(F.min("page_id").alias("first"))
    rows = rows.join(first, "sha1", "left").withColumn("payload_digest", base32(F.col("sha1")))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
        "target_uri",
        F.concat(F.lit("sha1:"), F.col("payload_digest")).alias("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"<{ID}"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_id(column: str) -> F.Column:
    """The page id in a record id; null where it is empty."""
    return F.nullif(F.regexp_extract(column, f"^<{ID}(-?[0-9]*)>$", 1), F.lit("")).cast("bigint")


ORACLE_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b) as n, sha1(b) as h from p),
f as (select h, min(page_id) as first from d group by h),
g as (
    select h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(floor(v / (32 ** s)) as bigint) % 32, 1), ''
        order by i, 3 - s) as digest
    from (
        select h, i, s,
            (instr('0123456789abcdef', substr(h, 5 * i + 1, 1)) - 1) * 65536
            + (instr('0123456789abcdef', substr(h, 5 * i + 2, 1)) - 1) * 4096
            + (instr('0123456789abcdef', substr(h, 5 * i + 3, 1)) - 1) * 256
            + (instr('0123456789abcdef', substr(h, 5 * i + 4, 1)) - 1) * 16
            + (instr('0123456789abcdef', substr(h, 5 * i + 5, 1)) - 1) as v
        from f, unnest(range(0, 8)) as a(i), unnest(range(0, 4)) as c(s))
    group by h)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from d join f on d.h = f.h join g on d.h = g.h
"""
