"""S12/S17 option building (no database is started), S15/S19/S20 catalog layers."""

import pytest

from aerolake.operators.silver import build_silver, conform_bronze
from aerolake.sources import catalog
from aerolake.sources.jdbc import JdbcTarget
from aerolake.sources.seed import load_airport_seed, seed_rows
from tests.fixtures import f1_bronze


def test_jdbc_options():
    t = JdbcTarget(host="db", database="flights/bronze", user="u", password="p")
    o = t.options("bronze_voos", "bronze")
    assert o["url"] == "jdbc:mysql://db:3306/flights" and o["dbtable"] == "bronze.bronze_voos"
    assert o["batchsize"] == "50000"
    pg = JdbcTarget(host="db", database="flights", user="u", password="p", port=6543, dialect="postgres")
    assert pg.options("t")["url"] == "jdbc:postgresql://db:6543/flights"
    with pytest.raises(ValueError):
        JdbcTarget(host="db", database="x", user="u", password="").options("t")
    assert t.create_schema_sql("bronze") == "CREATE SCHEMA IF NOT EXISTS `bronze`"
    assert pg.create_schema_sql("bronze") == 'CREATE SCHEMA IF NOT EXISTS "bronze"'
    with pytest.raises(ValueError):
        pg.create_schema_sql('x"; DROP')


def test_seed():
    rows = seed_rows()
    assert len(rows) == 44 and len({r[0] for r in rows}) == 44
    assert rows[0][0] == "SBGR" and all(len(r) == 6 for r in rows)


def test_catalog_layers_roundtrip(spark, scratch):
    silver = build_silver(f1_bronze(spark), load_airport_seed(spark))
    dbs = catalog.create_layers(spark, scratch, prefix="t_")
    table = catalog.materialise_silver(silver, dbs["silver"], f"{scratch}/silver")
    views = catalog.create_gold_views(spark, dbs["gold"], table)
    assert spark.table(table).count() == 12          # NULL-date rows come back
    assert spark.table(table).filter("ano IS NULL").count() == 4
    vol = spark.table(views[1])
    assert vol.count() == 5
    ranking = spark.table(views[2])
    assert "ranking_volume_em_voo" in ranking.columns
    p = spark.table(table).filter("ano = 2025").select("rota")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in p


def test_clustering_decision(spark, scratch):
    """Month-aligned input is written without a shuffle; scattered input is rebalanced."""
    from pyspark.sql import functions as F

    days = spark.range(0, 24 * 30).select(
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")),
                      "dd/MM/yyyy").alias("dt_referencia"))
    silver = build_silver(conform_bronze(days.withColumn("sg_icao_origem", F.lit("SBGR"))),
                          load_airport_seed(spark))
    aligned = silver.repartitionByRange(24, "dt_referencia_ts")
    scattered = silver.repartition(4)
    # aligned: ~30 rows per (task, month); scattered: 720 rows over 4 x 24 pairs
    assert catalog.rows_per_output_file(aligned) > 2 * catalog.rows_per_output_file(scattered)
    assert catalog.rows_per_output_file(scattered) < catalog.MIN_ROWS_PER_FILE
    dbs = catalog.create_layers(spark, scratch, prefix="c_")
    t = catalog.materialise_silver(scattered, dbs["silver"], f"{scratch}/s1")
    assert spark.table(t).count() == 720


def test_scale_settings_for_100_tb():
    from aerolake.session import scale_settings

    s = scale_settings(100 * 1024**4, executors=1000, cores_per_executor=8)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600          # 100 TB / 256 MB
    assert s["spark.sql.files.maxPartitionBytes"] == str(256 * 1024**2)
    small = scale_settings(10 * 1024**3, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120          # 3 waves of 40 cores


def test_load_reconciliation_flags_mismatch(spark):
    from aerolake.operators.quality import load_reconciliation

    expected = spark.createDataFrame([("a.parquet", 3), ("b.parquet", 1)], "source_file string, rows bigint")
    loaded = spark.createDataFrame([("a.parquet",), ("a.parquet",), ("b.parquet",), ("c.parquet",)],
                                   "source_file string")
    got = {r.source_file: (r.source_rows, r.loaded_rows, r.reconciled)
           for r in load_reconciliation(expected, loaded).collect()}
    assert got == {"a.parquet": (3, 2, False), "b.parquet": (1, 1, True), "c.parquet": (0, 1, False)}


def test_consolidate_and_sample(spark, scratch):
    from aerolake.sources.parquet import consolidate, sample_rows

    spark.createDataFrame([("1", "x")], "k string, a string").write.parquet(f"{scratch}/f1")
    spark.createDataFrame([("2", "y"), ("3", "z")], "k string, b string").write.parquet(f"{scratch}/f2")
    both = consolidate(spark, [f"{scratch}/f1", f"{scratch}/f2"])
    rows = {r.k: (r.a, r.b) for r in both.collect()}
    assert rows == {"1": ("x", None), "2": (None, "y"), "3": (None, "z")}
    assert "source_file" in both.columns
    sample = sample_rows(both, f"{scratch}/sample", n=2)
    assert sample.count() == 2
    again = sample_rows(both, f"{scratch}/sample", n=1)       # replace mode
    assert again.count() == 1


def test_content_reconciliation_flags_swapped_values(spark):
    """Equal rows in any order agree; a value moved to another row, column or file does not."""
    from aerolake.operators.quality import content_reconciliation

    shape = "a string, b string, source_file string"
    source = [("1", "x", "f"), ("2", "y", "f"), ("2", "y", "f"), (None, "z", "g"), ("7", None, "h"), ("8", "8", "i")]
    loaded = [("2", "y", "f"), ("1", "x", "f"), ("2", "y", "f"), ("z", None, "g"), ("7", None, "h"), ("8", "8", "k")]
    got = {r.source_file: (r.source_rows, r.loaded_rows, r.reconciled) for r in content_reconciliation(
        spark.createDataFrame(source, shape), spark.createDataFrame(loaded, shape), ["a", "b"]).collect()}
    assert got == {"f": (3, 3, True), "g": (1, 1, False), "h": (1, 1, True), "i": (1, 0, False),
                   "k": (0, 1, False)}
    swapped = [("1", "y", "f"), ("2", "x", "f"), ("2", "y", "f")]
    (row,) = content_reconciliation(spark.createDataFrame(source[:3], shape),
                                    spark.createDataFrame(swapped, shape), ["a", "b"]).collect()
    assert not row.reconciled
