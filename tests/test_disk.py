"""What a run keeps on disk: compressed text, shuffle files of one step, silver by slices of months."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from aerolake.session import SHUFFLE_CLEANUP_CONF, shuffles_removed
from aerolake.sources import catalog, silver_table
from aerolake.sources.manifest import Manifest
from aerolake.sources.silver_table import month_key, month_slices, refresh_silver
from aerolake.sources.seed import load_airport_seed
from tests.test_workflow import fixture_text, write_text


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before: set[str]) -> set[str]:
    """Shuffle files that are new; they go a moment after their query has ended."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


def test_shuffle_files_go_with_their_write(spark, scratch):
    before = shuffle_files(spark)
    setting = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    rows = spark.range(0, 5000, 1, 3).withColumn("p", F.col("id") % 3)
    with shuffles_removed(spark):
        rows.repartition(4, "p").write.partitionBy("p").parquet(f"{scratch}/kept")
    assert not left_over(spark, before) and spark.read.parquet(f"{scratch}/kept").count() == 5000
    with pytest.raises(ValueError), shuffles_removed(spark):
        raise ValueError("stop")
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == setting


def test_months_are_cut_into_slices_of_rows(monkeypatch):
    monkeypatch.setattr(silver_table, "ROWS_PER_SLICE", 10)
    monkeypatch.setattr(silver_table, "MOST_SLICES", 3)
    assert month_slices({}) == [[]] and month_slices({"202501": 0, "0": 0}) == [["0", "202501"]]
    assert month_slices({"202501": 4, "202502": 5}) == [["202501", "202502"]]  # few rows: one slice
    even = {f"2025{m:02}": 100.0 for m in range(1, 13)}
    assert [len(s) for s in month_slices(even)] == [4, 4, 4]
    hot = {"0": 1000.0, **even}
    assert month_slices(hot)[0] == ["0"] and sum(month_slices(hot), []) == sorted(hot)


def test_clustered_silver_is_written_by_slices(spark, scratch, monkeypatch):
    """Every row of every month, with and without a date, in a first build and after changes;
    no slice leaves its shuffle behind, and each holds a part of the rows."""
    seed = load_airport_seed(spark)
    days = [f"{d:02}/{m:02}/2025" for m in range(1, 7) for d in (1, 2, 3)] + ["bad"]

    def publish(name, dates):
        write_text(f"{scratch}/in", name, fixture_text([("GLO", "SBGR", "SBSP", d, d, d) for d in dates]))

    from aerolake.plans.workflow import WorkflowConfig, extract_and_load
    from aerolake.sources.parquet import bronze_schema

    cfg = WorkflowConfig(input_dir=f"{scratch}/in", lake_root=f"{scratch}/lake")
    written, left, write = [], [], silver_table._write_months

    def noted(spark, rows, name, path):
        before = shuffle_files(spark)
        write(spark, rows, name, path)
        left.extend(left_over(spark, before))
        month = month_key(F.col("dt_referencia_ts")).alias("month")
        written.append({r.month for r in rows.select(month).distinct().collect()})

    def run(airports=seed):
        written.clear()
        load = extract_and_load(spark, cfg)
        dbs = catalog.create_layers(spark, cfg.lake_root, "sl_")
        done = refresh_silver(spark, cfg.bronze_files(spark), bronze_schema(load.columns), airports,
                              dbs["silver"], cfg.silver_dir, Manifest(spark, cfg.silver_manifest))
        got = spark.table(done.table).groupBy("ano", "mes").count().collect()
        return {(r.ano, r.mes): r["count"] for r in got}

    monkeypatch.setattr(silver_table, "_write_months", noted)
    monkeypatch.setattr(silver_table, "ROWS_PER_SLICE", 10)
    monkeypatch.setattr(catalog, "needs_clustering", lambda rows: True)
    publish("a.txt", days)
    publish("b.txt", days)
    months = {(2025, m): 6 for m in range(1, 7)}
    assert run() == {**months, (None, None): 2}
    assert len(written) > 1 and sum(map(len, written)) == 7 == len(set().union(*written))
    publish("b.txt", ["05/06/2025"])  # five months and undated rows of one file are gone
    assert run() == {**{m: 3 for m in months}, (2025, 6): 4, (None, None): 1}
    assert sum(map(len, written)) == len(set().union(*written)) == 7
    assert run(seed.where("icao_aerodromo <> 'SBGR'")) == {**{m: 3 for m in months}, (2025, 6): 4, (None, None): 1}
    assert len(written) > 1 and not left


def test_the_workflow_reads_compressed_text(spark, scratch, monkeypatch):
    """The files it writes from the tables are gzip text of all encodings, with every row; nothing
    of the joins' shuffles is left."""
    from aerolake.plans import ingest_queries
    from tests.test_moved_data import small_tables

    small_tables(spark, scratch)
    roots, made = [], ingest_queries.scratch_dir

    def noted(spark, tag):
        roots.append(made(spark, tag))
        return roots[-1]

    monkeypatch.setattr(ingest_queries, "scratch_dir", noted)
    stages = {r.stage: (r.status, r.files, r.rows) for r in ingest_queries.q_workflow_stages(spark, scratch).collect()}
    assert stages["list_inputs"] == ("ok", 2, None) and stages["load_bronze"] == ("ok", 2, 2)
    root = roots[0].removeprefix("file:")
    files = [f"{d}/{f}" for d, _, names in os.walk(f"{root}/input") for f in names if not f.startswith((".", "_"))]
    assert len(files) == 2 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(gzip.open(f).read().count(b"\n") for f in files) == [2, 2]  # a header and a row
