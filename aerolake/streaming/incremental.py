"""Load processed Parquet files into the bronze table, once each.

Two loads, for two kinds of source:

* ``load_incremental`` for folders to which files are only added: a Structured
  Streaming query;
* ``load_files`` for folders whose files may be published again: a batch that writes
  file versions to folders of their own and commits them in a manifest.

``load_incremental`` is a Structured Streaming query over the processed directory with
``trigger(availableNow=True)``: it takes every file not yet seen, writes it to
the bronze Parquet table through the file sink, and stops. The checkpoint
(file-source offsets) and the sink's commit log live in the shared folder, so

* re-running the load adds no rows (the reference appended duplicates);
* a lost executor only re-runs its tasks; a lost driver resumes from the
  last committed batch;
* readers of the bronze table see committed files only.

Partitioning by ``source_file`` keeps each input file's rows together, so a
per-file reconciliation (Q12) reads partition values, not data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schema import SOURCE_FILE
from aerolake.session import open_partitions
from aerolake.sources.manifest import VersionedFiles, new_version


@dataclass
class LoadStats:
    rows_added: int
    files: int
    bronze_dir: str
    per_file: dict[str, int] = field(default_factory=dict)
    failed: list[str] = field(default_factory=list)

    def as_dict(self) -> dict:
        return {"total_linhas": self.rows_added, "arquivos": self.files, "falhas": len(self.failed)}


def sink_files(spark: SparkSession, bronze_dir: str, schema: T.StructType) -> set[str]:
    """Data files of the sink, from its listing (no data or footer is read)."""
    try:
        return set(spark.read.schema(schema).parquet(bronze_dir).inputFiles())
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def count_rows(spark: SparkSession, bronze_dir: str, schema: T.StructType,
               files: set[str]) -> dict[str, int]:
    """Rows of each source file in some data files of the sink (reads footers only)."""
    if not files:
        return {}
    rows = spark.read.schema(schema).option("basePath", bronze_dir).parquet(*sorted(files))
    key = F.col(SOURCE_FILE) if SOURCE_FILE in schema.fieldNames() else F.lit(bronze_dir)
    counts = rows.groupBy(key.alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return {r["f"]: r["n"] for r in counts.collect()}


def processed_schema(spark: SparkSession, processed_dir: str) -> T.StructType:
    """Schema of the processed dataset (from Parquet footers; all STRING)."""
    return spark.read.option("mergeSchema", "true").parquet(processed_dir).schema


def load_incremental(spark: SparkSession, processed_dir: str, bronze_dir: str,
                     checkpoint_dir: str, schema: T.StructType | None = None,
                     max_files_per_batch: int | None = None) -> LoadStats:
    """Append every processed file not loaded before to ``bronze_dir``."""
    schema = schema or processed_schema(spark, processed_dir)
    reader = spark.readStream.schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_batch))
    stream = reader.parquet(processed_dir)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", bronze_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if SOURCE_FILE in schema.fieldNames():
        writer = writer.partitionBy(SOURCE_FILE)
    # Rows are counted in the sink, in the files this run adds; a query's progress keeps
    # its last batches only.
    before = sink_files(spark, bronze_dir, schema)
    writer.start().awaitTermination()
    new = sink_files(spark, bronze_dir, schema) - before
    added = count_rows(spark, bronze_dir, schema, new)
    return LoadStats(sum(added.values()), len(added), bronze_dir, added)


def load_files(source: VersionedFiles, target: VersionedFiles, entries: list,
               schema: T.StructType) -> LoadStats:
    """Put the current rows of files of ``source`` into ``target``, as one new version.

    ``entries`` are rows of the source's manifest. The files are written to a version
    folder of their own, counted there (nothing else is) and then committed. Until that
    commit readers see the files' earlier versions; a load that is lost leaves nothing
    that a reader sees. Page checksums of the source are verified on the way.
    """
    if not entries:
        return LoadStats(0, 0, target.directory)
    version = new_version()
    rows = source.read(schema, [e[SOURCE_FILE] for e in entries], verify=True)
    with open_partitions(source.spark):  # a split is of one file, or of a few small ones
        rows.write.partitionBy(SOURCE_FILE).parquet(target.folder(version))
    counts = target.file_rows(version, schema)
    short = {e[SOURCE_FILE]: (e.rows, counts.get(e[SOURCE_FILE], 0)) for e in entries
             if e.rows != counts.get(e[SOURCE_FILE], 0)}
    if short:
        raise RuntimeError(f"rows extracted and loaded differ: {short}")
    target.manifest.add((e.path, e.length, e.modificationTime, e[SOURCE_FILE], None, version,
                         e.rows, None) for e in entries)
    return LoadStats(sum(counts.values()), len(counts), target.directory, counts)


def bronze_row_count(spark: SparkSession, bronze_dir: str) -> int:
    """Rows in the bronze table (errors are raised, not hidden as 0)."""
    return spark.read.parquet(bronze_dir).count()
