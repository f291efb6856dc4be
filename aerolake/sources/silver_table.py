"""The silver table kept up to date month by month.

Silver is partitioned by (ano, mes). A refresh rewrites only the months that a changed
file touches: those of its new rows, read from its new version in bronze, and those of
the rows it had when silver last took it, which silver's own manifest remembers with
the bronze version of every file. Of bronze, only the files with rows in those months
are read. Each month is replaced as a whole by Spark's dynamic partition overwrite, so
every other month stays as it is and the gold views never find an empty table; months
that no file has rows in any more are dropped after that.

All months are rewritten, in the same way, when there is no manifest yet or the airport
dimension has changed (its fingerprint is kept in the manifest). A run that is lost
before its manifest rows are written does the same months again.

Rows that must be clustered by month are written in slices of some months each, one after
the other, and the shuffle files of a slice go before the next begins. So the disk holds
the shuffle of a part of the rows; each slice reads bronze's files once more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.dates import guarded_date
from aerolake.operators.silver import build_silver
from aerolake.schema import SILVER_COLUMNS, SOURCE_FILE
from aerolake.session import open_partitions, shuffles_removed
from aerolake.sources import catalog
from aerolake.sources.manifest import Manifest, VersionedFiles

#: The manifest row of the airport dimension; its version is the fingerprint.
AIRPORTS = "#airports"
#: Month of rows without a reference date, which land in the default partition.
NO_MONTH = "0"
#: Clustered rows are written in slices of so many rows on average, in so many slices at most.
ROWS_PER_SLICE = 1_000_000
MOST_SLICES = 8


@dataclass
class Refresh:
    table: str
    months: list[str]  # 'yyyymm' of the rewritten ones, NO_MONTH for those without a date
    files_read: int


def month_key(date: Column) -> Column:
    """'yyyymm' of a date, NO_MONTH without one."""
    return F.coalesce((F.year(date) * 100 + F.month(date)).cast("string"), F.lit(NO_MONTH))


def airports_fingerprint(airports: DataFrame) -> str:
    """Count and order-free sums of the row hashes of the dimension."""
    h = F.xxhash64(*sorted(airports.columns))
    row = airports.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)),
                       F.sum(F.shiftrightunsigned(h, 32))).first()
    return "-".join(str(v or 0) for v in row)


def _table_exists(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the table is in the catalog; one that a session before has left is added."""
    if spark.catalog.tableExists(name):
        return True
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return False
    fields = spark.read.parquet(path).schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (ano, mes) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return True


def _write_months(spark: SparkSession, rows: DataFrame, name: str, path: str) -> None:
    if not _table_exists(spark, name, path):
        rows.write.format("parquet").partitionBy("ano", "mes").option("path", path).saveAsTable(name)
        return
    # by path: an insert into the table takes the overwrite mode from the session only
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ano", "mes").parquet(path))
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _drop_months(spark: SparkSession, name: str, path: str, months: list[str]) -> None:
    """Remove months that have no row any more."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path
    files = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for key in months:
        ano, mes = ("null", "null") if key == NO_MONTH else (str(int(key[:-2])), str(int(key[-2:])))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (ano = {ano}, mes = {mes})")
        default = "__HIVE_DEFAULT_PARTITION__"
        folder = f"ano={default}/mes={default}" if key == NO_MONTH else f"ano={ano}/mes={mes}"
        files.delete(hadoop(path, folder), True)


def month_slices(rows: dict[str, float]) -> list[list[str]]:
    """The months of ``rows`` (month -> its rows) in order, cut into slices of about as many rows
    each. A month is never cut, so one with more rows than that is a slice by itself.
    """
    total = sum(rows.values())
    share = total / max(1, min(MOST_SLICES, -(-total // ROWS_PER_SLICE)))
    slices: list[list[str]] = [[]]
    held = 0.0
    for month in sorted(rows):
        if slices[-1] and held + rows[month] > share:
            slices.append([])
            held = 0.0
        slices[-1].append(month)
        held += rows[month]
    return slices


def refresh_silver(spark: SparkSession, bronze: VersionedFiles, schema: T.StructType,
                   airports: DataFrame, database: str, path: str, manifest: Manifest,
                   table: str = catalog.SILVER_TABLE) -> Refresh:
    """Bring the silver table to the current versions of bronze's files."""
    name = f"`{database}`.`{table}`"
    # One row per file each, as in any file index.
    current, taken = bronze.manifest.latest(), manifest.latest()
    dimension = airports_fingerprint(airports)
    whole = (AIRPORTS not in taken or taken[AIRPORTS].version != dimension
             or not _table_exists(spark, name, path))
    # the manifest's lists are here of the months that a file has rows in
    known = {p: set(m) for p, m in (manifest.lists() if taken else {}).items() if p != AIRPORTS}
    changed = [p for p, r in current.items() if p not in taken or taken[p].version != r.version]

    months: dict[str, set[str]] = {p: set(m) for p, m in known.items() if p in current}
    # rows by file and month; those of a file that is not read here count as dealt evenly
    rows_in = {p: dict.fromkeys(m, current[p].rows / len(m)) for p, m in months.items() if m}
    for p in changed:
        months[p], rows_in[p] = set(), {}
    if changed:
        names = {current[p][SOURCE_FILE]: p for p in changed}
        rows = bronze.read(schema, names)
        found = (rows.groupBy(SOURCE_FILE, month_key(guarded_date("dt_referencia")).alias("month"))
                 .count().collect())
        for r in found:
            months[names[r[SOURCE_FILE]]].add(r.month)
            rows_in[names[r[SOURCE_FILE]]][r.month] = r["count"]
    gone = [p for p in known if p not in current]
    touched = set().union(*(months[p] | known.get(p, set()) for p in changed), *(known[p] for p in gone))
    if whole:
        touched = set().union(touched, *months.values(), *known.values())
    held = set().union(*months.values()) if months else set()
    read = [current[p][SOURCE_FILE] for p in current if months[p] & touched]
    if touched & held or whole:
        rows = bronze.read(schema, read)
        month = month_key(guarded_date("dt_referencia"))
        if not whole:
            rows = rows.where(month.isin(sorted(touched)))
        cluster = catalog.needs_clustering(rows)
        sizes = dict.fromkeys(touched, 0.0)
        for in_file in rows_in.values():
            for m in in_file.keys() & touched:
                sizes[m] += in_file[m]
        slices = month_slices(sizes) if cluster else [sorted(touched)]
        for part in slices:
            of_part = rows.where(month.isin(part)) if len(slices) > 1 else rows
            silver = build_silver(of_part, airports, cluster_by_month=cluster).select(*SILVER_COLUMNS)
            with open_partitions(spark), shuffles_removed(spark):
                _write_months(spark, silver, name, path)
    if touched - held:
        _drop_months(spark, name, path, sorted(touched - held))
    if whole or changed or gone:
        spark.catalog.refreshTable(name)
        done = [(p, r.length, r.modificationTime, r[SOURCE_FILE], sorted(months[p]), r.version, r.rows, None)
                for p, r in current.items() if p in set(changed)]
        manifest.add([*done, (AIRPORTS, 0, None, None, None, dimension, 0, None)])
    return Refresh(name, sorted(touched), len(read))
