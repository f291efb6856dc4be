"""Delimited text files -> processed Parquet, with lineage.

* Listing (S1/S2) uses the ``binaryFile`` source without its ``content``
  column, so only file metadata is read; a missing directory gives an empty
  listing with a warning, and ``require_inputs`` turns "nothing matched" into
  an error.
* One distributed pass profiles every file (encoding, header, ragged lines)
  and is written once as a small table in the shared folder; then one CSV
  scan per (encoding, header) group reads the rows as STRING with
  a schema taken from the header (UTF-16 in splittable line mode by its byte
  order), normalises the missing-value tokens a pandas reader turns into
  NULL, and adds the lineage column ``source_file`` (the processed Parquet
  name of the file, ``<stem>.parquet``). Files whose quoted fields span lines are
  split over tasks as well: ``records.py`` stitches their records.
* A file fails as a whole (S13) when it has a record with more fields than its
  header, ends inside a quoted field, or is empty when passed explicitly (Spark's
  listing already skips zero-length files); short records are kept with NULLs.
  Failed files are dropped before the write; the status and the reason of each are
  returned.
* The schema always comes from the header. Names of the documented record are
  matched without regard to case; a repeated name gets ``.1``, ``.2``, ... as a
  pandas reader would name it, so the first column keeps its name and values.
* The write is one job, partitioned by ``source_file``; with
  ``replace_files=True`` only the partitions of the files being written are
  replaced (dynamic partition overwrite), so re-running a file is idempotent.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.functions.text import normalise_na_sql
from aerolake.schema import BRONZE_COLUMNS, SOURCE_FILE
from aerolake.session import open_partitions, scratch_dir
from aerolake.sources.encoding import (
    FIELD_SEPARATOR,
    UTF16_BE,
    UTF16_LE,
    decode_header,
    profile_text_files,
    scan_quotes,
)
from aerolake.sources.codepages import CP860, MAC_TURKISH, choose, likely_pages  # noqa: F401
from aerolake.sources.records import read_lines, stitch_records

log = logging.getLogger(__name__)

# Input file patterns.
PATTERN_TXT = "*.txt"
PATTERN_CSV = "*.csv"
PATTERN_CSV_GZIP = "*.csv.gz"
PATTERN_PARQUET = "*.parquet"

# Why a file with a record longer than its header fails.
MORE_FIELDS = "a record has more fields than the header"

LEGACY_CHARSETS_CONF = "spark.sql.legacy.javaCharsets"


def allow_java_charsets(spark: SparkSession) -> None:
    """Spark 4 accepts 7 charsets in CSV by default; windows-1252 needs the legacy flag."""
    spark.conf.set(LEGACY_CHARSETS_CONF, "true")


def list_inputs(spark: SparkSession, directory: str, pattern: str = PATTERN_TXT,
                recursive: bool = False) -> DataFrame:
    """(path, file_name, length, modificationTime) of matching files, sorted by path."""
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(recursive).lower())
            .load(directory)
            .select("path", "length", "modificationTime")
        )
    except AnalysisException as exc:  # missing directory or nothing to read
        log.warning("no input under %s (%s)", directory, exc.getCondition())
        schema = "path string, length bigint, modificationTime timestamp"
        return spark.createDataFrame([], schema).withColumn("file_name", F.lit(None).cast("string"))
    return listing.withColumn(
        "file_name", F.regexp_extract("path", r"([^/]+)$", 1)
    ).orderBy("path")


def require_inputs(listing: DataFrame) -> list[str]:
    """Paths of the listing, or FileNotFoundError when nothing matched.

    The listing has one row per file (the driver already holds the file index).
    """
    paths = [r.path for r in listing.select("path").collect()]
    if not paths:
        raise FileNotFoundError("no input files matched")
    return paths


def processed_file_name(path: str, root: str | None = None) -> str:
    """Processed name of a source path (driver side, same rule as the reader's lineage).

    ``<stem>.parquet``; with the ``root`` that was listed recursively, folders below it
    are part of the name (``a/b/x.txt`` -> ``a__b__x.parquet``), so it is unique per path.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if root is not None:
        name = _plain(path)[len(_plain(root).rstrip("/")) + 1:].replace("/", "__")
    stem = name.rsplit(".", 1)[0] if "." in name else name
    return f"{stem}.parquet"


def unique_names(paths: list[str], root: str | None) -> dict[str, str]:
    """path -> processed name; raises if two paths would share one."""
    names = {p: processed_file_name(p, root) for p in paths}
    if len(set(names.values())) < len(names):
        seen: dict[str, str] = {}
        for p, n in names.items():
            if n in seen:
                raise ValueError(f"{seen[n]} and {p} would both be {n}; pass their common root")
            seen[n] = p
    return names


def processed_name(file_name_col):
    """``<stem>.parquet`` for a source file name (same rule as the reader's lineage)."""
    ext = F.substring_index(file_name_col, ".", -1)
    without_ext = F.substring(file_name_col, F.lit(1),
                              F.length(file_name_col) - F.length(ext) - F.lit(1))
    stem = F.when(F.instr(file_name_col, ".") > 0, without_ext).otherwise(file_name_col)
    return F.concat(stem, F.lit(".parquet"))


@dataclass
class ExtractResult:
    """What ``extract_text_files`` did: the S6 statistics plus the per-file profile."""

    succeeded: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    rows_written: int = 0
    profile: DataFrame | None = None
    # processed name -> encoding that each file was read with
    encodings: dict[str, str] = field(default_factory=dict)
    # path of each file that failed -> why
    reasons: dict[str, str] = field(default_factory=dict)
    # processed name -> column names of each file that succeeded
    columns: dict[str, list[str]] = field(default_factory=dict)

    def stats(self) -> dict:
        return {"sucessos": len(self.succeeded), "falhas": len(self.failed),
                "falhos": list(self.failed)}


_CANONICAL = {c.lower(): c for c in BRONZE_COLUMNS}


def header_columns(header: str | None, sep: str = FIELD_SEPARATOR) -> list[str] | None:
    """Column names from a decoded header line; None if it cannot be decoded.

    Documented names are matched without regard to case, a repeated name gets
    ``.1``, ``.2``, ..., and an empty one is ``Unnamed: <position>``.
    """
    if not header or "\ufffd" in header:
        return None
    names = [h.strip() for h in header.rstrip("\r").split(sep)]
    names = [h[1:-1].replace('""', '"') if len(h) > 1 and h[0] == h[-1] == '"' else h for h in names]
    out: list[str] = []
    seen: set[str] = set()
    for i, name in enumerate(names):
        name = _CANONICAL.get(name.lower(), name) or f"Unnamed: {i}"
        unique, k = name, 0
        while unique.lower() in seen:
            k += 1
            unique = f"{name}.{k}"
        seen.add(unique.lower())
        out.append(unique)
    return out


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _utf16(encoding: str) -> bool:
    return encoding in (UTF16_BE, UTF16_LE)


def utf16_lines(spark: SparkSession, paths: list[str], encoding: str, sep: str) -> dict[str, tuple]:
    """path -> (most fields of a line, whether some line leaves a quote open), decoded."""
    lines = read_lines(spark, paths, encoding).select("file_path", scan_quotes(F.col("text"), sep).alias("scan"))
    seen = lines.groupBy("file_path").agg(F.max("scan.separators").alias("most"),
                                          F.bool_or("scan.open").alias("open"))
    return {_plain(r.file_path): (r.most + 1, r.open) for r in seen.collect()}


def _lineage(path: str, name: str, root: str | None) -> str:
    """SQL of ``<stem>.parquet`` (string functions only), given SQL of path and name."""
    if root is not None:
        plain = _plain(root).rstrip("/").replace("\\", "\\\\").replace("'", "\\'")
        name = (f"replace(substring({path}, instr({path}, '{plain}') + "
                f"{len(_plain(root).rstrip('/')) + 1}), '/', '__')")
    return (f"concat(CASE WHEN instr({name}, '.') > 0 THEN left({name}, length({name}) "
            f"- length(substring_index({name}, '.', -1)) - 1) ELSE {name} END, '.parquet') "
            f"AS {SOURCE_FILE}")


def read_text_group(spark: SparkSession, paths: list[str], encoding: str,
                    sep: str = FIELD_SEPARATOR, columns: list[str] | None = None,
                    crlf: bool = False, root: str | None = None) -> DataFrame:
    """One CSV scan of files sharing encoding and header; every column STRING.

    With ``columns`` known from the profile the schema is given (no inference
    job); the header line of every file is skipped. Files are split by lines, UTF-16
    ones too: their byte order is taken from the mark, and ``lineSep`` is then encoded
    in that charset. Records that span lines are read by ``read_spanning_group``.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("inferSchema", False)
        # a file's own header may differ in case or repeat a name
        .option("enforceSchema", True)
    )
    if _utf16(encoding):
        reader = reader.option("lineSep", "\r\n" if crlf else "\n")
    if columns:
        reader = reader.schema(_schema(columns))
    df = reader.csv(paths)
    exprs = [normalise_na_sql(c) for c in df.columns]
    if _utf16(encoding) and not crlf and exprs:
        # line ends are mixed: the last column of some lines ends with a carriage return
        last = "`" + df.columns[-1].replace("`", "``") + "`"
        bare = f"regexp_replace({last}, '\\r$', '')"
        df = df.withColumn(df.columns[-1], F.expr(bare))
    return df.selectExpr(*exprs, _lineage("_metadata.file_path", "_metadata.file_name", root))


def read_spanning_group(spark: SparkSession, paths: list[str], encoding: str, sep: str,
                        columns: list[str], root: str | None) -> tuple[DataFrame, dict[str, str]]:
    """S4 for files with quoted fields over several lines, which stay split over tasks.

    Returns the rows of the good files and path -> reason of the others. Records are
    stitched from the lines of all splits (``records.py``), written once, and parsed.
    """
    records, unclosed = stitch_records(spark, paths, encoding, sep)
    folder = scratch_dir(spark, "text-records")
    records.write.parquet(folder)
    records = spark.read.schema(records.schema).parquet(folder)
    bad = {path: "a quote is never closed" for path in unclosed}
    ragged = records.where(F.col("fields") > len(columns)).select("file_path").distinct()
    bad.update((r.file_path, MORE_FIELDS) for r in ragged.collect())
    if bad:
        records = records.where(~F.col("file_path").isin(sorted(bad)))
    parsed = F.from_csv("text", _ddl(columns),
                        {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    rows = records.select("file_path", parsed.alias("r"))
    names = [f"r{i}" for i in range(len(columns))]
    flat = rows.select("file_path", *(F.col("r").getField(n) for n in names)) \
        .toDF("__file_path", *columns)
    name = "substring_index(__file_path, '/', -1)"
    frame = flat.selectExpr(*(normalise_na_sql(c) for c in columns), _lineage("__file_path", name, root))
    return frame, {_plain(p): reason for p, reason in bad.items()}


def _ddl(columns: list[str]) -> str:
    """A schema of as many STRING columns, named by position."""
    return ", ".join(f"r{i} STRING" for i in range(len(columns)))


def read_text_files(spark: SparkSession, paths: list[str], sep: str = FIELD_SEPARATOR,
                    encoding_overrides: dict[str, str] | None = None,
                    root: str | None = None) -> tuple[DataFrame | None, ExtractResult]:
    """Profile, then read the good files. Returns (rows or None, result).

    ``encoding_overrides`` maps a file name to a Java charset name (e.g.
    ``IBM860``) and replaces the detected encoding of that file. ``root`` is the
    folder whose recursive listing gave the paths (see ``processed_file_name``).
    """
    overrides = dict(encoding_overrides or {})
    allow_java_charsets(spark)
    names = {_plain(p): n for p, n in unique_names(paths, root).items()}
    # One pass over all bytes. The small per-file result is read several times
    # below and later, so it is written once as a table in the shared folder
    # (``checkpoint()`` would compute the scan twice: once to count, once to save).
    profile_dir = scratch_dir(spark, "text-profile")
    profile_text_files(spark.read.text(paths), sep).write.parquet(profile_dir)
    profile = spark.read.parquet(profile_dir)
    # One small row per file (no header text): the read plan needs the paths on
    # the driver, as any file scan's index does. Header text comes once per
    # distinct header, grouped on the executors.
    rows = profile.select("file_path", "file_name", "encoding", "multiline", "crlf", "header_key",
                          "too_many_fields", "may_be_legacy").collect()
    legacy = [r.file_path for r in rows if r.may_be_legacy and r.file_name not in overrides]
    likely = likely_pages(spark, legacy) if legacy else {}
    headers = {
        (r.header_key, r.encoding): r.header_bytes
        for r in profile.groupBy("header_key", "encoding").agg(
            F.first("header_bytes").alias("header_bytes")).collect()
    }
    seen = {_plain(r.file_path) for r in rows}
    reasons = {p: "empty" for p in paths if _plain(p) not in seen}
    by_plain = {_plain(p): p for p in paths}
    groups: dict[tuple, list[str]] = {}
    result = ExtractResult(profile=profile)
    for r in rows:
        path = by_plain.get(_plain(r.file_path), r.file_path)
        if r.too_many_fields:
            reasons[path] = MORE_FIELDS
            continue
        enc = overrides.get(r.file_name) or choose(r.encoding, likely.get(r.file_path))
        result.encodings[names[_plain(path)]] = enc
        groups.setdefault((enc, r.multiline, r.crlf, r.header_key, r.encoding), []).append(path)
    data = None
    # UTF-16: what the profile sees of other files is seen on decoded lines
    for group in [g for g in groups if _utf16(g[0])]:
        files = groups.pop(group)
        lines = utf16_lines(spark, files, group[0], sep)
        for p in files:
            most, spans = lines.get(_plain(p), (0, False))
            columns = header_columns(decode_header(headers[group[3], group[4]], group[0]), sep)
            if columns and most > len(columns) and not spans:
                reasons[p] = MORE_FIELDS
            else:
                groups.setdefault((group[0], spans, *group[2:]), []).append(p)
    for (enc, spanning, crlf, key, detected), files in sorted(groups.items(), key=lambda kv: kv[1][0]):
        columns = header_columns(decode_header(headers[key, detected], enc), sep)
        frame, bad = None, {}
        if spanning and columns:
            frame, bad = read_spanning_group(spark, files, enc, sep, columns, root)
        reasons.update((by_plain[p], reason) for p, reason in bad.items())
        files = [p for p in files if _plain(p) not in bad]
        if not files:
            continue
        if frame is None:
            frame = read_text_group(spark, files, enc, sep, columns, crlf, root)
        result.succeeded += [p.rsplit("/", 1)[-1] for p in files]
        shape = [c for c in frame.columns if c != SOURCE_FILE]
        result.columns.update((names[_plain(p)], shape) for p in files)
        data = frame if data is None else data.unionByName(frame, allowMissingColumns=True)
    result.succeeded.sort()
    result.reasons = reasons
    result.failed = sorted(p.rsplit("/", 1)[-1] for p in reasons)
    return data, result


def _plain(path: str) -> str:
    """Compare local paths with and without a ``file:`` scheme the same way."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return path


def extract_text_files(spark: SparkSession, paths: list[str], processed_dir: str,
                       sep: str = FIELD_SEPARATOR, replace_files: bool = True,
                       encoding_overrides: dict[str, str] | None = None,
                       root: str | None = None) -> ExtractResult:
    """Text files -> Parquet under ``processed_dir`` partitioned by ``source_file``."""
    data, result = read_text_files(spark, paths, sep, encoding_overrides, root)
    if data is None:
        return result
    writer = data.write.partitionBy(SOURCE_FILE)
    if replace_files:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    with open_partitions(spark):  # a split is of one file, or of a few small ones
        writer.parquet(processed_dir)
    return result
