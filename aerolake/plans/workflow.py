"""The whole run, text files -> bronze -> silver -> gold -> data tests.

Stage order and gates:

1. list the input files; stop if none match;
2. extract the file versions not tried before -> processed Parquet, and commit the good
   ones; stop if no file was ever extracted. A version that
   fails is recorded with its reason and not tried again until its file changes; the
   earlier version of that file stays in use;
3. validate the processed files; stop if none is valid, and name the others;
4. load valid files whose version bronze lacks; a failure here is reported and the
   run continues with what bronze already holds;
5. rewrite the months of silver that changed files touch and create the gold views;
   skipped when there is no bronze yet;
6. run the declared data tests (report; ``strict=True`` raises on failures).

Each stage adds one row to the returned stats frame. Extract and load write every file
version to a folder of its own and commit it in a manifest (``sources/manifest.py``): a
file published again replaces its rows at that commit, never before. What no reader
can see any more is removed at the end of the run.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators import quality
from aerolake.operators.silver import require_columns
from aerolake.schema import SOURCE_FILE
from aerolake.sources import catalog
from aerolake.sources.manifest import WITHDRAWN, Manifest, VersionedFiles, new_version
from aerolake.sources.parquet import bronze_schema, validate_parquet
from aerolake.sources.seed import load_airport_seed
from aerolake.sources.silver_table import refresh_silver
from aerolake.sources.text import (
    PATTERN_TXT,
    extract_text_files,
    list_inputs,
    unique_names,
)
from aerolake.streaming.incremental import LoadStats, load_files

log = logging.getLogger(__name__)

STATS_SCHEMA = "stage string, status string, files bigint, rows bigint, detail string"


@dataclass
class WorkflowConfig:
    input_dir: str
    lake_root: str
    pattern: str = PATTERN_TXT
    database_prefix: str = ""
    strict_tests: bool = False
    # The bronze load commits at most this many files at once, so a large backlog
    # is done in restartable pieces.
    max_files_per_batch: int = 1000
    # file name -> Java charset, for encodings the byte rules cannot detect (cp860 ...)
    encoding_overrides: dict[str, str] | None = None

    @property
    def processed_dir(self) -> str:
        return f"{self.lake_root}/processed"

    @property
    def bronze_dir(self) -> str:
        return f"{self.lake_root}/bronze/bronze_voos"

    @property
    def extract_manifest(self) -> str:
        return f"{self.lake_root}/_manifests/extract"

    @property
    def load_manifest(self) -> str:
        return f"{self.lake_root}/_manifests/load"

    @property
    def silver_manifest(self) -> str:
        return f"{self.lake_root}/_manifests/silver"

    @property
    def silver_dir(self) -> str:
        return f"{self.lake_root}/silver/silver_voos"

    def current_bronze(self, spark: SparkSession, columns: list[str]) -> DataFrame:
        """Bronze as committed: its last good version of every file."""
        return self.bronze_files(spark).read(bronze_schema(columns))

    def processed_files(self, spark: SparkSession) -> VersionedFiles:
        return VersionedFiles(spark, self.processed_dir, Manifest(spark, self.extract_manifest))

    def bronze_files(self, spark: SparkSession) -> VersionedFiles:
        return VersionedFiles(spark, self.bronze_dir, Manifest(spark, self.load_manifest))


@dataclass
class WorkflowRun:
    stats: DataFrame
    silver_table: str | None = None
    gold_views: list[str] | None = None
    tests: DataFrame | None = None


@dataclass
class LoadedBronze:
    """Bronze after a run's extract and load; ``bronze`` is None if there is none yet."""

    bronze: DataFrame | None = None
    columns: list[str] = field(default_factory=list)
    loaded: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    stopped: bool = False


def extract_new(spark: SparkSession, processed: VersionedFiles, cfg: WorkflowConfig, todo: list,
                names: dict[str, str], root: str | None) -> int:
    """Extract, check and commit file versions; returns how many succeeded.

    All are written to one new version folder. A file that cannot be read is recorded as
    failed with the reason; its earlier version, if it has one, stays what readers see.
    """
    version = new_version()
    result = extract_text_files(spark, [f.path for f in todo], processed.folder(version),
                                replace_files=False, encoding_overrides=cfg.encoding_overrides, root=root)
    read = {names[f.path]: f for f in todo if names[f.path] in result.columns}
    schema = bronze_schema(sorted({c for n in read for c in result.columns[n]}))
    rows = processed.file_rows(version, schema)
    entries, good = [], 0
    for f in todo:
        name = names[f.path]
        reason = None if name in read else result.reasons.get(f.path, "not read")
        good += reason is None
        entries.append((f.path, f.length, f.modificationTime, name,
                        result.columns.get(name) if reason is None else None,
                        version if reason is None else None, rows.get(name, 0), reason))
    processed.manifest.add(entries)
    return good


def load_checked(processed: VersionedFiles, bronze: VersionedFiles, entries: list, invalid: list[str],
                 schema, max_files: int) -> LoadStats:
    """Load file versions into bronze; damaged processed files are withdrawn.

    If a load fails, the content of its files is checked; those with damaged pages are
    left out and the others loaded. The text of a withdrawn file is taken again by the
    next run.
    """
    spark = processed.spark
    damaged = {e[SOURCE_FILE] for e in entries} & set(invalid)
    total = LoadStats(0, 0, bronze.directory)
    for start in range(0, len(entries), max_files):
        piece = [e for e in entries[start:start + max_files] if e[SOURCE_FILE] not in damaged]
        try:
            done = load_files(processed, bronze, piece, schema)
        except Exception:
            names = [e[SOURCE_FILE] for e in piece if e.rows]
            checked = validate_parquet(
                spark, processed.directory, spark.createDataFrame([(n,) for n in names], f"{SOURCE_FILE} string"),
                schema, processed.paths(names)).collect()
            bad = {r[SOURCE_FILE] for r in checked if not r.valid}
            if not bad:
                raise
            damaged |= bad
            done = load_files(processed, bronze, [e for e in piece if e[SOURCE_FILE] not in bad], schema)
        total.per_file.update(done.per_file)
    lost = [e for e in entries if e[SOURCE_FILE] in damaged]
    if lost:
        processed.manifest.add((e.path, WITHDRAWN, e.modificationTime, e[SOURCE_FILE], None, None, None,
                                "processed file damaged") for e in lost)
    total.rows_added, total.files = sum(total.per_file.values()), len(total.per_file)
    total.failed = sorted(damaged)
    return total


def extract_and_load(spark: SparkSession, cfg: WorkflowConfig, recursive: bool = False,
                     stage=lambda *a: None) -> LoadedBronze:
    """Stages 1 to 4; ``stage(name, status, files, rows, detail)`` is told of each."""
    listing = list_inputs(spark, cfg.input_dir, cfg.pattern, recursive=recursive)
    # One row per file, as any file scan's index has on the driver.
    files = listing.select("path", "length", "modificationTime").collect()
    if not files:
        stage("list_inputs", "stopped", 0, None, f"no {cfg.pattern} under {cfg.input_dir}")
        return LoadedBronze(stopped=True)
    stage("list_inputs", "ok", len(files), None, "")

    root = cfg.input_dir if recursive else None
    names = unique_names([f.path for f in files], root)
    processed, bronze = cfg.processed_files(spark), cfg.bronze_files(spark)
    extracted, loaded = processed.manifest, bronze.manifest
    # Only versions neither extracted nor failed before: a re-run with the same inputs
    # adds nothing, and a file that cannot be read is not tried until it changes.
    todo = extracted.pending(files)
    good = extract_new(spark, processed, cfg, todo, names, root) if todo else 0
    failed = {names[path]: reason for path, reason in extracted.quarantined(files)}
    detail = "failed: " + ", ".join(f"{n} ({r})" for n, r in failed.items()) if failed else ""
    listed = {f.path for f in files}
    current = sorted((r for p, r in extracted.latest().items() if p in listed), key=lambda r: r.path)
    if not current:
        stage("extract", "stopped", 0, None, detail or "no file could be read")
        return LoadedBronze(stopped=True)
    stage("extract", "failures" if failed else "ok", good, None,
          detail or ("" if todo else "no new input file"))

    columns = extracted.columns()
    schema = bronze_schema(columns)
    # Footers only: the load reads every page and verifies its checksum.
    with_rows = [e[SOURCE_FILE] for e in current if e.rows]
    expected = spark.createDataFrame([(n,) for n in with_rows], f"{SOURCE_FILE} string")
    checked = validate_parquet(spark, cfg.processed_dir, expected, schema, processed.paths(with_rows),
                               content=False).collect()
    valid = {r[SOURCE_FILE] for r in checked if r.valid}
    invalid = sorted(r[SOURCE_FILE] for r in checked if not r.valid)
    if with_rows and not valid:
        stage("validate", "stopped", 0, None, "no valid Parquet file")
        return LoadedBronze(stopped=True)
    stage("validate", "ok", len(valid), None, "invalid: " + ",".join(invalid) if invalid else "")

    out = LoadedBronze(columns=columns, failed=failed)
    try:
        load = load_checked(processed, bronze, loaded.pending(current), invalid, schema,
                            cfg.max_files_per_batch)
        out.loaded = load.per_file
        stage("load_bronze", "ok", load.files, load.rows_added,
              "damaged: " + ",".join(load.failed) if load.failed else "")
    except Exception as exc:  # reported; later stages use what bronze holds
        log.exception("bronze load")
        stage("load_bronze", "failed", None, None, type(exc).__name__)
    if loaded.latest():
        out.bronze = bronze.read(schema)
    return out


def run_workflow(spark: SparkSession, cfg: WorkflowConfig,
                 airports: DataFrame | None = None, recursive: bool = False) -> WorkflowRun:
    rows: list[tuple] = []

    def stage(name, status, files=None, n=None, detail=""):
        rows.append((name, status, files, n, detail))
        log.info("stage %s: %s files=%s rows=%s %s", name, status, files, n, detail)

    def done(**kw) -> WorkflowRun:
        return WorkflowRun(stats=spark.createDataFrame(rows, STATS_SCHEMA), **kw)

    load = extract_and_load(spark, cfg, recursive, stage)
    if load.stopped:
        return done()
    if load.bronze is None:
        stage("silver", "skipped", None, None, "no bronze table yet")
        return done()
    require_columns(load.columns)
    seed = airports if airports is not None else load_airport_seed(spark)
    dbs = catalog.create_layers(spark, cfg.lake_root, cfg.database_prefix)
    refresh = refresh_silver(spark, cfg.bronze_files(spark), bronze_schema(load.columns), seed,
                             dbs["silver"], cfg.silver_dir, Manifest(spark, cfg.silver_manifest))
    silver_table = refresh.table
    views = catalog.create_gold_views(spark, dbs["gold"], silver_table)
    stage("silver", "ok", None, spark.table(silver_table).count(),
          f"{len(refresh.months)} months written from {refresh.files_read} files")
    stage("gold", "ok", len(views))

    gold_db = dbs["gold"]
    report = quality.declared_tests(
        spark.table(silver_table), seed,
        spark.table(f"`{gold_db}`.`gold_pontualidade`"),
        spark.table(f"`{gold_db}`.`gold_volume_periodo`"),
        spark.table(f"`{gold_db}`.`gold_ranking_rotas_atrasadas`"),
    )
    failed = report.filter(~F.col("passed")).count()
    stage("tests", "ok" if failed == 0 else "failures", None, failed,
          f"{failed} of 21 declared tests failed")
    for files in (cfg.processed_files(spark), cfg.bronze_files(spark)):
        files.vacuum()
    if cfg.strict_tests:
        quality.enforce(report)
    return done(silver_table=silver_table, gold_views=views, tests=report)
