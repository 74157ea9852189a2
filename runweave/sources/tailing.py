"""Growing log files as a stream of lines: a Python data source whose offset is a byte in each file.

Spark's file source takes a file once, as it is when first seen; lines appended later are lost. Here the offset
of a batch says up to which byte each file is read, always just behind a line feed, so a half-written line
waits until it is whole. A file is known by its first line and, where the file system has one, its inode, and
not by its name: a log that is rotated (renamed, and a new file begun) goes on where it was, and the new
file begins at its start. Nothing is remembered outside Spark's checkpoint, so a restart goes on as well.

Files are cut into ranges of bounded size, which are read in parallel; the driver reads the first line and
the last bytes of the files that have changed.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of one range, which one task reads, and of one look for a line feed.
RANGE_BYTES, LOOK_BYTES = 64 << 20, 1 << 16
#: Bytes of lines in one Arrow batch, about.
BATCH_BYTES = 1 << 20
SCHEMA = "file string, id string, at bigint, line string"


@dataclass
class Range(InputPartition):
    """Lines of one file that begin from ``begin`` up to, but not at, ``end``; its lines end at ``last``."""

    name: str
    identity: str
    begin: int
    end: int
    last: int


def _open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), os.path.abspath(folder)


def _line_end(file: pa.NativeFile, begin: int, size: int) -> int | None:
    """Place behind the first line feed from ``begin`` on."""
    at = begin
    while at < size:
        block = file.read_at(min(LOOK_BYTES, size - at), at)
        if not block:
            return None
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return None


def _last_line_end(file: pa.NativeFile, least: int, size: int) -> int:
    """Place behind the last line feed, at ``least`` at least, which is behind one."""
    end = size
    while end > least:
        begin = max(least, end - LOOK_BYTES)
        found = file.read_at(end - begin, begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        end = begin
    return least


class TailReader(DataSourceStreamReader):
    """Offsets are ``{identity: [name, byte]}`` of the files that hold a whole line."""

    def __init__(self, options: dict[str, str]) -> None:
        self.fs, self.root = _open_folder(options["folder"])
        self.glob = options.get("glob", "*")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        # What a file was when it was last looked at: unchanged ones are not opened again.
        self.looked: dict[str, tuple] = {}

    def _files(self) -> list[pafs.FileInfo]:
        found = self.fs.get_file_info(pafs.FileSelector(self.root, allow_not_found=True, recursive=False))
        shown = [f for f in found if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_"))]
        return [f for f in shown if fnmatch(f.base_name, self.glob)]

    def _identity(self, path: str, file: pa.NativeFile, size: int) -> tuple[str, int] | None:
        """Who a file is, and where its first line ends; None while it has no whole line."""
        end = _line_end(file, 0, size)
        if end is None:
            return None
        digest = hashlib.sha256()
        for at in range(0, end, LOOK_BYTES):
            digest.update(file.read_at(min(LOOK_BYTES, end - at), at))
        local = isinstance(self.fs, pafs.LocalFileSystem)
        # Files in an object store are never renamed, so their name may stand for the inode.
        own = os.stat(path).st_ino if local else hashlib.sha256(path.encode()).hexdigest()[:16]
        return f"{own}-{digest.hexdigest()[:32]}", end

    def _look(self, info: pafs.FileInfo) -> tuple[str, int] | None:
        stamp = (info.size, info.mtime_ns)
        known = self.looked.get(info.path)
        if known and known[0] == stamp:
            return known[1]
        found = None
        try:
            with self.fs.open_input_file(info.path) as file:
                size = file.size()
                who = self._identity(info.path, file, size)
                if who:
                    found = who[0], _last_line_end(file, who[1], size)
        except FileNotFoundError:  # renamed meanwhile: it is found under its new name, now or next time
            return None
        self.looked[info.path] = stamp, found
        return found

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        files, listed = {}, self._files()
        for info in sorted(listed, key=lambda f: f.path):
            found = self._look(info)
            if found:
                # During a rename a file may be listed under both names.
                _, end = files.get(found[0], ("", 0))
                files[found[0]] = [info.base_name, max(end, found[1])]
        here = {f.path for f in listed}
        self.looked = {p: x for p, x in self.looked.items() if p in here}
        return {"files": files}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for identity, (name, last) in end["files"].items():
            first = start["files"].get(identity, ["", 0])[1]
            for at in range(first, last, self.range_bytes):
                out.append(Range(name, identity, at, min(at + self.range_bytes, last), last))
        return out

    def _found(self, part: Range) -> pa.NativeFile:
        """The file of a range, under whatever name it has by now."""
        names = [f"{self.root}/{part.name}", *[f.path for f in self._files() if f.base_name != part.name]]
        for path in names:
            try:
                file = self.fs.open_input_file(path)
            except FileNotFoundError:
                continue
            who = self._identity(path, file, file.size()) if file.size() >= part.last else None
            if who and who[0] == part.identity:
                return file
            file.close()
        raise FileNotFoundError(f"{part.name} is gone from {self.root} before it was read up to byte {part.last}")

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with self._found(partition) as file:
            at = partition.begin
            if at and file.read_at(1, at - 1) != b"\n":  # the line across the border belongs to the range before
                at = _line_end(file, at, partition.last) or partition.last
            while at < partition.end:
                stop = min(at + BATCH_BYTES, partition.last)
                # Whole lines: on to the end of the one that the last byte is part of.
                stop = _line_end(file, stop - 1, partition.last) or partition.last
                block = file.read_at(stop - at, at)
                lines, places = block.split(b"\n")[:-1], []
                for line in lines:
                    places.append(at)
                    at += len(line) + 1
                keep = len(places)
                while keep and places[keep - 1] >= partition.end:
                    keep -= 1
                texts = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines[:keep]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition.name] * keep, pa.string()),
                        pa.array([partition.identity] * keep, pa.string()),
                        pa.array(places[:keep], pa.int64()),
                        pa.array(texts, pa.string()),
                    ],
                    names=["file", "id", "at", "line"],
                )


class TailSource(DataSource):
    """Format ``tail``; options ``folder``, ``glob`` (of file names) and ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def tail_lines(spark: SparkSession, folder: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, id, at, line)`` of every whole line of the files in ``folder``, as they grow, each line once.

    ``at`` is the line's first byte, and ``id`` the file, whatever its name was by then: together they name a
    line. Files of the folder itself count, whose names match ``glob`` and do not
    begin with ``.`` or ``_``. Rotation by renaming is followed as long as the renamed file stays in the folder
    and matches ``glob``; a file that was cut to nothing and begun anew with another first line is a new
    one. A copy of a file is a new file, so rotation by copying needs a ``glob`` without the copies. A line
    without a line feed waits for it. Bytes that are no UTF-8 become replacement characters; a carriage
    return before the line feed is no part of the line. A file that is gone before its range was read is
    an error, as lines would be lost.
    """
    spark.dataSource.register(TailSource)
    options = {"folder": folder, "glob": glob, "range_bytes": str(range_bytes)}
    return spark.readStream.format("tail").options(**options).load()
