"""Additive parts of a stream, merged level by level, under a manifest.

Every micro-batch writes one part.  As soon as ``fanout`` parts of one level are
there, they are merged into one part of the next level, so that a stream of b
batches leaves fewer than ``fanout`` parts on each of about log(b) levels.  A read
sums those, whatever the number of batches.

The list of live parts is a table of one file, written anew for each change under
the next version number.  Its file appears as a whole or not at all, which makes it
the point of commit: data without an entry is as if it had not been written and is
removed later, and a repeated batch that already has an entry changes nothing.

One writer per folder.  The stream's checkpoint belongs into the same folder, since
batch numbers only mean something together with it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST = "path string, level int, first_batch long, last_batch long"


@dataclass(frozen=True)
class Entry:
    path: str
    level: int
    first_batch: int
    last_batch: int


class Folder:
    """The few file operations that the reader and writer of a table do not offer."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def create(self, path: str) -> None:
        system, place = self._at(path)
        system.mkdirs(place)

    def names(self, path: str) -> list[str]:
        system, place = self._at(path)
        return [found.getPath().getName() for found in system.listStatus(place)]

    def remove(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)


class Parts:
    """The parts below ``folder``; ``merge`` maps the rows of any parts to the rows of one part.

    ``merge`` must give the same result in whatever order and grouping parts are
    merged, and keep the schema.  ``keep`` versions of the manifest stay readable;
    parts that none of them lists are removed.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame],
        fanout: int = 8,
        keep: int = 10,
    ):
        if fanout < 2 or keep < 1:
            raise ValueError("fanout must be 2 or more, keep 1 or more")
        self.spark, self.folder, self.schema, self.merge = spark, folder.rstrip("/"), schema, merge
        self.fanout, self.keep = fanout, keep
        self.files = Folder(spark)
        for name in ("data", "manifest"):
            self.files.create(f"{self.folder}/{name}")
        self.version, self.entries = self._newest()

    # --- manifest ---------------------------------------------------------------

    def _newest(self) -> tuple[int, list[Entry]]:
        """Newest version and its entries.  A version holds few rows and few versions are kept."""
        rows = (
            self.spark.read.schema(f"{MANIFEST}, version long").parquet(f"{self.folder}/manifest").collect()
        )
        version = max((r["version"] for r in rows), default=0)
        entries = [Entry(r["path"], r["level"], r["first_batch"], r["last_batch"]) for r in rows if r["version"] == version]
        return version, sorted(entries, key=lambda e: e.first_batch)

    def _commit(self, entries: list[Entry]) -> None:
        rows = [(e.path, e.level, e.first_batch, e.last_batch) for e in entries]
        target = f"{self.folder}/manifest/version={self.version + 1}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(target)
        self.version, self.entries = self.version + 1, entries

    # --- data -------------------------------------------------------------------

    def _read(self, entries: list[Entry]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/data/{e.path}" for e in entries])

    def _write(self, part: DataFrame) -> str:
        name = uuid.uuid4().hex
        part.write.parquet(f"{self.folder}/data/{name}")
        return name

    def add(self, part: DataFrame, batch: int) -> None:
        """Keep the part of a batch; without effect for a batch that is kept already."""
        if any(e.first_batch <= batch <= e.last_batch for e in self.entries):
            return
        self._commit([*self.entries, Entry(self._write(part), 0, batch, batch)])
        self._compact()
        self._expire()

    def _compact(self) -> None:
        """Merge full levels, the lowest first; a merge can fill the next one."""
        level = 0
        while any(e.level >= level for e in self.entries):
            full = [e for e in self.entries if e.level == level]
            if len(full) >= self.fanout:
                merged = Entry(
                    self._write(self.merge(self._read(full))),
                    level + 1,
                    min(e.first_batch for e in full),
                    max(e.last_batch for e in full),
                )
                others = [e for e in self.entries if e.level != level]
                self._commit(sorted([*others, merged], key=lambda e: e.first_batch))
            level += 1

    def _expire(self) -> None:
        manifest = f"{self.folder}/manifest"
        for name in self.files.names(manifest):
            if name.startswith("version=") and int(name.split("=")[1]) <= self.version - self.keep:
                self.files.remove(f"{manifest}/{name}")
        kept = self.spark.read.schema(f"{MANIFEST}, version long").parquet(manifest)
        live = {r["path"] for r in kept.select("path").distinct().collect()}
        for name in self.files.names(f"{self.folder}/data"):
            if name not in live:
                self.files.remove(f"{self.folder}/data/{name}")

    def current(self) -> DataFrame:
        """The merged rows of all live parts."""
        return self.merge(self._read(self.entries))
