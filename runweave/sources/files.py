"""Files of a folder tree as rows."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runweave.session import reliable_checkpoint

LISTED = "full_path string, is_folder boolean, length bigint, modified_us bigint"
ROWS_PER_BATCH = 10_000


def scan_files(spark: SparkSession, folder: str, suffixes: Sequence[str] = ("*",)) -> DataFrame:
    """Path (relative to ``folder``), length and time of every file below it.

    Only files that end with one of ``suffixes`` (``*`` is all); each file once, whatever number
    of suffixes it fits. Hidden and empty files count too, which Spark's file sources leave out.
    Folders are listed by the tasks, one level of the tree after the other, so no list of all
    files ever sits on the driver; no file is opened. The folder must be one that every executor
    sees. Linked folders are not entered.
    """
    root = folder.rstrip("/")
    level = spark.createDataFrame([(root,)], "folder string")
    found = None
    while True:
        listed = reliable_checkpoint(level.mapInPandas(_list_folders, LISTED))
        files = listed.where(~F.col("is_folder"))
        found = files if found is None else found.unionByName(files)
        level = listed.where("is_folder").select(F.col("full_path").alias("folder"))
        if level.isEmpty():
            break
        # Big folders come with small ones: deal them out anew.
        level = level.repartition("folder")
    if "*" not in suffixes:
        found = found.where(
            reduce(lambda a, b: a | b, [F.col("full_path").endswith(s) for s in suffixes])
        )
    return found.select(
        F.substr("full_path", F.lit(len(root) + 2)).alias("path"),
        "full_path",
        "length",
        F.timestamp_micros("modified_us").alias("modified"),
    )


def _list_folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder in batch["folder"]:
            rows = list(_entries(folder))
            for i in range(0, len(rows), ROWS_PER_BATCH):
                yield pd.DataFrame(
                    rows[i : i + ROWS_PER_BATCH],
                    columns=["full_path", "is_folder", "length", "modified_us"],
                )


def _entries(folder: str) -> Iterator[tuple[str, bool, int, int]]:
    local = folder.startswith("/")
    if local:
        system, path = fs.LocalFileSystem(), folder
    else:
        system, path = fs.FileSystem.from_uri(folder)
    for info in system.get_file_info(fs.FileSelector(path)):
        name = f"{folder}/{info.base_name}"
        if info.type == fs.FileType.Directory:
            if not (local and os.path.islink(name)):
                yield name, True, 0, 0
        elif info.type == fs.FileType.File:
            yield name, False, info.size, info.mtime_ns // 1000
