"""What jobs shuffle, sort and keep: narrow flight rows, no sort or clustering without need."""

import re

from pyspark.sql import functions as F

from aerolake.operators.joins import TABLE_BROADCAST_MAX_BYTES
from aerolake.operators.silver import build_silver, conform_bronze
from aerolake.session import OPEN_PARTITIONS_CONF, open_partitions
from aerolake.sources import catalog
from aerolake.sources.adapter import airports_from_tables, flights_from_tables


def days(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    return conform_bronze(spark.range(0, 24 * 30).select(F.date_format(day, "dd/MM/yyyy").alias("dt_referencia"),
                                                         day.alias("day")))


def test_input_in_month_order_is_not_clustered(spark):
    """It has few rows a file, but clustering would not leave fewer files."""
    by_month = days(spark).withColumn("m", F.substring("dt_referencia", 4, 7)).repartition(3, "m")
    assert catalog.rows_per_output_file(by_month) < catalog.MIN_ROWS_PER_FILE
    assert not catalog.needs_clustering(by_month)
    assert catalog.needs_clustering(days(spark).repartition(4))


def test_flights_are_wide_only_after_the_joins(spark, scratch):
    from aerolake.sources.adapter import flight_keys, flight_rows

    rows = {
        "region": ("r_regionkey int, r_name string", [(1, "EUROPE"), (2, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(3, "FRANCE", 1), (4, "JAPAN", 2)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double",
                     [(1, "a", 3, "AUTO", -1.0), (2, "b", 9, "AUTO", 1.0)]),
        "supplier": ("s_suppkey bigint, s_nationkey int", [(7, 4), (8, 4), (9, None)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string, "
                   "o_orderstatus string", [(10, 1, None, "1-URGENT", "F"), (11, 2, None, "5-LOW", "O")]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp",
                     [(10, 5, s, n, 2.0, 1234.5, 0.1, "N", "F", None) for n, s in enumerate((7, 8, 9), 1)]
                     + [(11, 5, 8, 1, 2.0, 1.0, 0.1, "N", "F", None)])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{scratch}/{name}.parquet")
    keys = flight_keys(spark, scratch)
    assert not {"sg_icao_origem", "nm_regiao_destino"} & set(keys.columns) and len(keys.columns) < 25
    keys.write.parquet(f"{scratch}/kept")
    got = {(r.id_combinada, r.sg_icao_origem, r.nm_pais_origem, r.sg_icao_destino, r.nm_pais_destino,
            r.ds_tipo_empresa, r.kg_carga_paga)
           for r in flight_rows(spark, scratch, spark.read.parquet(f"{scratch}/kept")).collect()}
    # a nation that is unknown or absent leaves no flight; supplier 7 has no destination code
    assert got == {("10-1", "SB03", "FRANCE", None, "JAPAN", "ESTRANGEIRA", "1.234,50"),
                   ("10-2", "SB03", "FRANCE", "SB04", "JAPAN", "ESTRANGEIRA", "1.234,50")}


def test_partitioned_write_with_open_partitions(spark, scratch):
    """Every row lands in its partition, also with more partitions than are kept open; the
    session's setting is back afterwards, after an error too."""
    before = spark.conf.get(OPEN_PARTITIONS_CONF)
    with open_partitions(spark, 4):
        spark.range(0, 1000, 1, 2).withColumn("p", F.col("id") % 20).write.partitionBy("p").parquet(f"{scratch}/out")
    try:
        with open_partitions(spark):
            raise ValueError("stop")
    except ValueError:
        pass
    assert spark.conf.get(OPEN_PARTITIONS_CONF) == before
    out = spark.read.parquet(f"{scratch}/out")
    assert (out.count(), out.agg(F.sum("id")).first()[0], out.where("id % 20 <> p").count()) == (1000, 499500, 0)


def small_tables(spark, folder):
    rows = {
        "region": ("r_regionkey int, r_name string", [(1, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(3, "FRANCE", 1)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double",
                     [(1, "a", 3, "auto", -1.0), (2, "b", 3, None, 1.0)]),
        "supplier": ("s_suppkey bigint, s_nationkey int", [(8, 3)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string, "
                   "o_orderstatus string", [(10, 1, None, "1-URGENT", "F"), (11, 2, None, "5-LOW", "O")]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp",
                     [(10, 5, 8, 1, 2.0, 1234.5, 0.1, "N", "F", None), (11, 5, 8, 2, None, None, None, "N", "F", None)])}
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")


def test_methods_of_silver_are_small_enough_to_be_compiled(spark, scratch, capsys):
    """The JVM compiles no method above 8,000 bytes; it interprets them, row by row. With
    broadcast and with sorted joins; the values of the measures are the same."""
    small_tables(spark, scratch)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    airports = airports_from_tables(spark, scratch)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # the whole plan is known at once
        for most in (TABLE_BROADCAST_MAX_BYTES, 0):
            silver = build_silver(flights_from_tables(spark, scratch, most), airports)
            capsys.readouterr()
            silver.explain("codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 7500
            got = {(r.id_combinada, r.sg_empresa_iata, r.kg_bagagem_livre, r.kg_bagagem_excesso, r.kg_carga_paga,
                    r.kg_carga_gratis, r.kg_correio, r.nr_passag_pagos) for r in silver.collect()}
            assert got == {("10-1", "AU", 2.0, 10.0, 1234.5, None, 1100.5, 10),
                           ("11-2", None, None, None, None, 2.5, 1200.5, 20)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_silver_is_clustered_as_narrow_rows(spark, scratch):
    """Bronze given as narrow rows is clustered before its texts are made; rows are the same."""
    from tests.test_plans import plan

    keys = days(spark).select("dt_referencia").repartition(4)
    seen = []

    def widen(rows):
        seen.append(rows)
        return conform_bronze(rows.withColumn("sg_icao_origem", F.lit("SB03")))

    airports = spark.createDataFrame([("SB03", "a", "b", "c", "d", "e")],
                                     "icao_aerodromo string, nome_aeroporto string, cidade string, "
                                     "estado string, uf string, regiao string")
    dbs = catalog.create_layers(spark, scratch, prefix="n_")
    table = catalog.materialise_silver_from_bronze(keys, airports, dbs["silver"], f"{scratch}/silver", widen=widen)
    (rows,) = seen
    assert rows.columns == ["dt_referencia"] and "REBALANCE_PARTITIONS_BY_COL" in plan(rows)
    assert rows.select(F.substring("dt_referencia", 4, 7).alias("m"), F.spark_partition_id().alias("p")).distinct() \
        .groupBy("m").count().where("count > 1").isEmpty()  # a month is together
    columns = ["dt_referencia", "ano", "mes", "nome_mes", "sg_icao_origem", "origem_cidade"]
    plain = build_silver(widen(keys), airports).select(columns)
    got = spark.table(table).select(columns)
    assert got.count() == 720 and got.exceptAll(plain).isEmpty()


def test_catalog_layers_gives_narrow_rows(spark, scratch, monkeypatch):
    """What the query has clustered are table columns, not the texts of bronze; its view has all flights."""
    from aerolake.plans import ingest_queries

    small_tables(spark, scratch)
    orders = spark.read.parquet(f"{scratch}/orders.parquet").withColumn("o_orderdate", F.lit("2024-02-29").cast("timestamp"))
    orders.localCheckpoint().write.mode("overwrite").parquet(f"{scratch}/orders.parquet")
    given, write = [], catalog.materialise_silver_from_bronze

    def noted(bronze, *args, **kw):
        given.append(bronze)
        return write(bronze, *args, **kw)

    monkeypatch.setattr(catalog, "materialise_silver_from_bronze", noted)
    got = ingest_queries.q_catalog_layers(spark, scratch).collect()
    (bronze,) = given
    assert len(bronze.columns) < 25 and not {"nm_pais_origem", "id_combinada"} & set(bronze.columns)
    assert [(r.ano, r.mes, r.total_voos) for r in got] == [(2024, 2, 2)]


def test_dates_are_not_parsed_by_pattern(spark):
    """A guarded date and its names are what a parse by pattern gives, for every day and none."""
    from aerolake.functions.dates import DATE_TEXT_PATTERN, guarded_date, pg_day_name, pg_month_name

    years = spark.createDataFrame([(0,), (4,), (1900,), (2024,), (2025,), (9999,)], "y int")
    texts = (spark.range(0, 33).selectExpr("id AS d").crossJoin(spark.range(0, 14).selectExpr("id AS m"))
             .crossJoin(years).select(F.format_string("%02d/%02d/%04d", "d", "m", "y").alias("t")))
    odd = [(None,), ("",), ("01/01/2024\n",), (" 01/01/2024",), ("1/1/2024",), ("2024-01-01",), ("01/01/20245",)]
    texts = texts.unionByName(spark.createDataFrame(odd, "t string")).localCheckpoint()
    old = F.when(F.col("t").rlike(DATE_TEXT_PATTERN), F.try_to_date("t", "dd/MM/yyyy"))
    new = guarded_date("t")
    day = F.col("d").cast("string").alias("d")  # Python has no year 0
    by_pattern = texts.select("t", old.alias("d")).select("t", day, F.rpad(F.date_format("d", "MMMM"), 9, " "),
                                                         F.rpad(F.date_format("d", "EEEE"), 9, " "))
    by_parts = texts.select("t", new.alias("d")).select("t", day, pg_month_name("d"), pg_day_name("d"))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(key, by_parts.collect())) == sorted(map(key, by_pattern.collect()))
    assert by_parts.where("d IS NOT NULL").count() == 3 * 366 + 3 * 365
    assert "gettimestamp" not in by_parts._jdf.queryExecution().optimizedPlan().toString().lower()
