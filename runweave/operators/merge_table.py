"""A table of rows by key that is changed without being rewritten: merge on read.

A version of the table is a manifest: a small JSON file that names one base and the deltas since, in order. A
change writes its rows as a delta and commits by creating the next manifest, which only one writer can do;
whoever loses reads the new one and tries again. Readers take the newest manifest and merge: only keys that
deltas touch are shuffled, the rest of the base is read as it is. Compaction writes the merged rows as a new
base and commits it like a change, keeping the deltas that came meanwhile, so readers see the old version
or the new one. Files of versions that no manifest kept names are removed by :meth:`MergeTable.vacuum`.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"
#: Deltas after which a change compacts the table, and tries to commit among other writers.
MOST_DELTAS, TRIES = 16, 50
#: Age at which a claim without its manifest is given up.
STALE_SECONDS = 60
PUT, PATCH, DELETE = "put", "patch", "delete"


class MergeTable:
    """Rows of ``schema``, one a key, below ``path`` in shared storage.

    ``put`` sets whole rows, ``patch`` the columns that a row lists in ``update_keys``, of keys that exist;
    ``delete`` removes keys. A change has one row a key, else it is refused. A key may not be null.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "id") -> None:
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.values = [f.name for f in schema.fields if f.name != key]
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # Manifests ---------------------------------------------------------------------------------------

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.path}/{MANIFESTS}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        """The newest version, or the one asked for; an empty table is version 0."""
        if version is None:
            version = max(self._versions(), default=0)
        if not version:
            return {"version": 0, "base": None, "deltas": [], "batches": {}}
        text = self.spark.read.text(f"{self.path}/{MANIFESTS}/{version}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _create(self, manifest: Mapping[str, Any]) -> bool:
        """Write a manifest under its number; False if another writer was first.

        The text is written aside and renamed, which fails where the name is taken, so no reader sees half
        of it. This is so for HDFS and file systems like it; others need their own lock.
        """
        final = self._path(f"{self.path}/{MANIFESTS}/{manifest['version']}.json")
        aside = self._path(f"{self.path}/{MANIFESTS}/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        # A claim that only one writer can make, for file systems whose rename replaces.
        claim = self._path(f"{self.path}/{MANIFESTS}/.claim-{manifest['version']}")
        try:
            self._fs.create(claim, False).close()
        except Exception as error:  # noqa: BLE001  the JVM's FileAlreadyExistsException
            self._fs.delete(aside, False)
            if not self._fs.exists(claim):
                raise error
            age = time.time() - self._fs.getFileStatus(claim).getModificationTime() / 1000
            if age > STALE_SECONDS and not self._fs.exists(final):
                self._fs.delete(claim, False)  # its writer died between claim and commit
            return False
        return bool(self._fs.rename(aside, final))

    def _commit(self, change) -> int:
        """Commit ``change``, a function from the newest manifest to the next or to None (nothing to do)."""
        for _ in range(TRIES):
            now = self.manifest()
            new = change(now)
            if new is None:
                return now["version"]
            new["version"] = now["version"] + 1
            if self._create(new):
                return new["version"]
            time.sleep(0.1)
        raise RuntimeError(f"{self.path}: no commit in {TRIES} tries")

    # Changes -----------------------------------------------------------------------------------------

    def put(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Insert or replace whole rows; returns the version. ``batch`` as in :meth:`patch`."""
        return self._change(rows.select(*self.schema.names), PUT, batch)

    def patch(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Set the columns that each row lists in ``update_keys``; keys that do not exist stay absent.

        ``batch`` names a writer and its growing number: one that is committed already changes nothing.
        """
        named = [c for c in rows.columns if c not in (self.key, "update_keys")]
        for name in named:
            if name not in self.values:
                raise ValueError(f"no column {name!r} to update")
        return self._change(rows, PATCH, batch)

    def delete(self, keys: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Remove the rows of the listed keys, which may repeat or be absent."""
        return self._change(keys.select(self.key).distinct(), DELETE, batch)

    def _change(self, rows: DataFrame, kind: str, batch: tuple[str, int] | None) -> int:
        def done(manifest: Mapping[str, Any]) -> bool:
            return batch is not None and manifest["batches"].get(batch[0], -1) >= batch[1]

        now = self.manifest()
        if done(now):
            return now["version"]
        name = f"delta-{uuid.uuid4().hex}"
        fields = {f.name: f for f in self.schema.fields}
        columns = [
            F.col(c).cast(fields[c].dataType).alias(c) if c in rows.columns else F.lit(None).cast(fields[c].dataType).alias(c)
            for c in self.schema.names
        ]
        mask = F.col("update_keys") if kind == PATCH else F.lit(None).cast("array<string>")
        rows.select(*columns, mask.alias("update_keys")).write.parquet(f"{self.path}/{name}")
        stored = self._delta({"name": name, "kind": kind})
        wrong = stored.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 or `{self.key}` is null")
        if not wrong.isEmpty():
            raise ValueError(f"a change needs one row a key and no null key: {wrong.first()[0]!r}")

        def add(manifest: dict[str, Any]) -> dict[str, Any] | None:
            if done(manifest):
                return None
            batches = {**manifest["batches"], **({batch[0]: batch[1]} if batch else {})}
            return {**manifest, "deltas": [*manifest["deltas"], {"name": name, "kind": kind}], "batches": batches}

        version = self._commit(add)
        if len(self.manifest()["deltas"]) >= MOST_DELTAS:
            version = self.compact()
        return version

    # Reading -----------------------------------------------------------------------------------------

    def _delta(self, delta: Mapping[str, str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("update_keys", T.ArrayType(T.StringType()))])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{delta['name']}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of the one asked for."""
        return self._merged(self.manifest(version))

    def _merged(self, manifest: Mapping[str, Any]) -> DataFrame:
        base = self.spark.createDataFrame([], self.schema)
        if manifest["base"]:
            base = self.spark.read.schema(self.schema).parquet(f"{self.path}/{manifest['base']}")
        if not manifest["deltas"]:
            return base
        changes = None
        for seq, delta in enumerate(manifest["deltas"], 1):
            part = self._delta(delta).withColumn("__seq", F.lit(seq)).withColumn("__kind", F.lit(delta["kind"]))
            changes = part if changes is None else changes.unionByName(part)
        touched = changes.select(self.key).distinct()
        old = base.join(touched, self.key, "left_semi")
        old = old.withColumn("update_keys", F.lit(None).cast("array<string>"))
        old = old.withColumn("__seq", F.lit(0)).withColumn("__kind", F.lit(PUT))
        whole = F.col("__kind") != PATCH

        def newest(c: str) -> Column:
            # Of the rows that set this column; a struct, so that a value set to null counts as set.
            sets = (F.col("__kind") == PUT) | F.array_contains("update_keys", c)
            return F.max_by(F.struct(F.col(c).alias("v")), F.when(sets, F.col("__seq"))).alias(c)

        last = F.max_by("__kind", F.when(whole, F.col("__seq"))).alias("__last")
        merged = old.unionByName(changes).groupBy(self.key).agg(last, *[newest(c) for c in self.values])
        merged = merged.where(F.col("__last") == PUT)  # else deleted, or patched without ever having been put
        merged = merged.select(self.key, *[F.col(c)["v"].alias(c) for c in self.values]).select(*self.schema.names)
        untouched = base.join(touched, self.key, "left_anti").select(*self.schema.names)
        return untouched.unionByName(merged)

    # Upkeep ------------------------------------------------------------------------------------------

    def compact(self) -> int:
        """Write the merged rows as a new base; changes that are committed meanwhile stay deltas."""
        before = self.manifest()
        if not before["deltas"]:
            return before["version"]
        name = f"base-{uuid.uuid4().hex}"
        self._merged(before).write.parquet(f"{self.path}/{name}")
        known = [d["name"] for d in before["deltas"]]

        def swap(manifest: dict[str, Any]) -> dict[str, Any] | None:
            names = [d["name"] for d in manifest["deltas"]]
            if manifest["base"] != before["base"] or names[: len(known)] != known:
                return None  # another writer has compacted
            return {**manifest, "base": name, "deltas": manifest["deltas"][len(known) :]}

        return self._commit(swap)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the folders that none of the newest ``keep`` manifests names, and older manifests.

        Returns what was removed. To be run while no change is being written, and no reader is older.
        """
        versions = self._versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        named = {m["base"] for m in kept} | {d["name"] for m in kept for d in m["deltas"]}
        gone = []
        for status in self._fs.listStatus(self._path(self.path)) if versions else []:
            name = status.getPath().getName()
            if name.startswith(("base-", "delta-")) and name not in named:
                self._fs.delete(status.getPath(), True)
                gone.append(name)
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"{self.path}/{MANIFESTS}/{v}.json"), False)
            gone.append(f"{v}.json")
        return gone


def merge_stream(df: DataFrame, table: MergeTable, checkpoint: str, name: str, trigger: Mapping[str, Any], order: Sequence[str] = ()):
    """Put the changed rows of every batch of a stream into ``table``, each batch once.

    A batch that runs again after it was committed changes nothing. Of several rows of a key in a batch the last
    by ``order`` counts. The table's folders stay bounded, as changes compact it.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        if order:
            newest = F.max_by(F.struct(*table.schema.names), F.struct(*order)).alias("r")
            batch = batch.groupBy(F.col(table.key).alias("__key")).agg(newest).select("r.*")
        table.put(batch, (name, batch_id))

    writer = df.writeStream.outputMode("update").foreachBatch(save)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
