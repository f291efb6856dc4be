"""Versioned files: what a step has finished, by file version.

A lake step (extract, load) writes the rows of its input files into a fresh folder
``version=<id>/source_file=<name>/`` of its own and then appends one row per file to
its manifest, a small Parquet dataset. That append is the commit: readers resolve
their files through the manifest, so a folder that no row names does not exist for
them, whatever a lost run left behind. Nothing is deleted or replaced before the commit;
``vacuum`` removes folders that no current file needs afterwards.

Each manifest row is of one file version (path, length, modification time). A row with
a ``reason`` is a failure: that version is quarantined, which leaves the last good
version of the file in place, and is not tried again until the file changes.

One run at a time may write to a lake.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schema import SOURCE_FILE

KEY = ("path", "length", "modificationTime")
KEY_SCHEMA = "path string, length bigint, modificationTime timestamp"
ENTRY = (f"{KEY_SCHEMA}, source_file string, columns array<string>, version string, rows bigint, "
         "reason string")
SCHEMA = f"{ENTRY}, written timestamp"
ENTRY_COLUMNS = (*KEY, "source_file", "columns", "version", "rows", "reason")

VERSION = "version"
VERIFY_PAGES = "parquet.page.verify-checksum.enabled"
#: Length of a withdrawn file version: no listed file has it, so the file is taken again.
WITHDRAWN = -1


def new_version() -> str:
    """A folder name of its own for every attempt."""
    return uuid.uuid4().hex[:16]


@dataclass
class State:
    """One small row per file, as any file index has on the driver."""

    last: dict[str, Row]  # path -> its last row, good or failed
    good: dict[str, Row]  # path -> its last good row
    sizes: dict[str, int]  # version -> files with rows that were committed with it


def _key(row: Row) -> tuple:
    return row.path, row.length, row.modificationTime


class Manifest:
    """Versions of files that a step has finished or given up.

    The rows are read once by an object and followed through its own commits.
    """

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory
        self._state: State | None = None

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.directory)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    @property
    def state(self) -> State:
        """The manifest as of the last read or commit of this object."""
        if self._state is None:
            row = F.struct(*(c for c in ENTRY_COLUMNS if c != "columns"), "written")
            good = F.when(F.col("reason").isNull(), F.col("written"))
            last = self.rows().groupBy("path").agg(F.max_by(row, "written").alias("last"),
                                                   F.max_by(row, good).alias("good")).collect()
            sizes = (self.rows().where("reason IS NULL AND rows > 0").groupBy(VERSION)
                     .agg(F.count(F.lit(1)).alias("n")).collect())
            self._state = State({r.path: r.last for r in last}, {r.path: r.good for r in last if r.good},
                                {r[VERSION]: r.n for r in sizes})
        return self._state

    def latest(self) -> dict[str, Row]:
        """path -> the last good row of each file: what readers see."""
        return self.state.good

    def pending(self, files: Iterable[Row]) -> list[Row]:
        """The rows of ``files`` (with the key columns) whose version is not the last one here,
        good or failed."""
        last = self.state.last
        return [f for f in files if f.path not in last or _key(last[f.path]) != _key(f)]

    def quarantined(self, files: Iterable[Row]) -> list[tuple[str, str]]:
        """(path, reason) of the rows of ``files`` whose present version has failed."""
        last = self.state.last
        return sorted((f.path, last[f.path].reason) for f in files
                      if f.path in last and last[f.path].reason is not None and _key(last[f.path]) == _key(f))

    def add(self, entries: Iterable[tuple]) -> None:
        """Append rows of ``ENTRY_COLUMNS`` in one commit (one file, so all or none)."""
        entries = list(entries)
        rows = self.spark.createDataFrame(entries, ENTRY)
        (rows.withColumn("written", F.current_timestamp())
         .coalesce(1).write.mode("append").parquet(self.directory))
        if self._state is not None:
            for e in entries:
                row = Row(**dict(zip(ENTRY_COLUMNS, e)))
                self._state.last[row.path] = row
                if row.reason is None:
                    self._state.good[row.path] = row
                    if row.rows:
                        self._state.sizes[row.version] = self._state.sizes.get(row.version, 0) + 1

    def columns(self) -> list[str]:
        """Every column name seen so far, in the order of first sight."""
        seen = (self.rows().where(F.col("reason").isNull())
                .select("written", "path", F.posexplode("columns").alias("at", "name"))
                .groupBy("name").agg(F.min(F.struct("written", "at", "path")).alias("first")))
        return [r["name"] for r in seen.orderBy("first", "name").collect()]

    def lists(self) -> dict[str, list[str]]:
        """path -> ``columns`` of its last good row."""
        last = self.rows().where("reason IS NULL").groupBy("path").agg(
            F.max_by("columns", "written").alias("columns"))
        return {r.path: list(r["columns"] or ()) for r in last.collect()}


class VersionedFiles:
    """Rows by source file in version folders, seen through a manifest."""

    def __init__(self, spark: SparkSession, directory: str, manifest: Manifest):
        self.spark, self.directory, self.manifest = spark, directory.rstrip("/"), manifest

    def folder(self, version: str) -> str:
        return f"{self.directory}/{VERSION}={version}"

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return path, path(self.directory).getFileSystem(conf)

    def file_folder(self, version: str, name: str) -> str:
        escape = self.spark.sparkContext._jvm \
            .org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        return f"{self.folder(version)}/{SOURCE_FILE}={escape(name)}"

    def paths(self, names: Iterable[str] | None = None) -> list[str]:
        """Folders of the current files (or of those named).

        A version all of whose files are current and wanted is one folder; of others each
        file is named. Files without rows have no folder.
        """
        wanted = None if names is None else set(names)
        size = self.manifest.state.sizes
        current: dict[str, list[str]] = {}
        for r in self.manifest.latest().values():
            if r.rows and (wanted is None or r[SOURCE_FILE] in wanted):
                current.setdefault(r[VERSION], []).append(r[SOURCE_FILE])
        out = []
        for version, files in sorted(current.items()):
            if len(files) == size[version]:
                out.append(self.folder(version))
            else:
                out += [self.file_folder(version, f) for f in sorted(files)]
        return out

    def read(self, schema: T.StructType, names: Iterable[str] | None = None,
             verify: bool = False) -> DataFrame:
        """The current rows, with the columns of ``schema``; ``verify`` checks page checksums."""
        paths = self.paths(names)
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        return (self.spark.read.schema(stored).option("basePath", self.directory)
                .option(VERIFY_PAGES, str(verify).lower()).parquet(*paths)
                .select(*(f"`{c}`" for c in schema.names)))

    def read_version(self, version: str, schema: T.StructType) -> DataFrame:
        """Rows of one version folder, committed or not."""
        path, fs = self._fs()
        if not fs.exists(path(self.folder(version))):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder(version))

    def file_rows(self, version: str, schema: T.StructType) -> dict[str, int]:
        """Rows of each file of one version folder (reads footers only)."""
        counts = self.read_version(version, schema).groupBy(SOURCE_FILE).count()
        return {r[SOURCE_FILE]: r["count"] for r in counts.collect()}

    def vacuum(self) -> int:
        """Remove what no reader can see: superseded files and folders of lost runs.

        Call it when no reader still works on an earlier snapshot. Returns the number of
        folders removed.
        """
        path, fs = self._fs()
        if not fs.exists(path(self.directory)):
            return 0
        keep = set(self.paths())
        held = {p.rsplit(f"/{SOURCE_FILE}=", 1)[0] for p in keep}
        removed = 0
        for status in fs.listStatus(path(self.directory)):
            name = status.getPath().getName()
            folder = f"{self.directory}/{name}"
            if not name.startswith(f"{VERSION}=") or folder in keep:
                continue
            if folder not in held:
                removed += bool(fs.delete(status.getPath(), True))
                continue
            for child in fs.listStatus(status.getPath()):
                at = f"{folder}/{child.getPath().getName()}"
                if child.isDirectory() and at not in keep:
                    removed += bool(fs.delete(child.getPath(), True))
        return removed
