"""Flights and airports derived from the driver's TPC-H-style tables.

The test tables carry no flights, so each lineitem becomes one flight stage:

==========================  ===============================================
flight column               derived from
==========================  ===============================================
id_combinada                ``l_orderkey || '-' || l_linenumber``
airline, line type, DI      customer, order and line columns as text
sg_empresa_icao (airline)   customer market segment
nr_voo / nr_etapa           order key / line number
dt_referencia (text)        order date as ``DD/MM/YYYY``; line 7 of an order
                            carries the legacy ISO text and every tenth line 6 the
                            31st of February, which the guard rejects
dt_partida_real             ship date when the return flag is not ``N``
dt_chegada_real             ship date when the return flag is ``A``
origin (icao, uf, region,   customer nation: ``'SB' || lpad(nation, 2, '0')``,
country)                    ``'U' || lpad(nation, 2, '0')``, region, nation name
destination                 same from the supplier nation; one supplier in 50 has
                            no destination code
load measures               line number, quantity, discount and price as text, with
                            ``12.0``, ``23,0``, ``5.0`` and ``1.234,56`` shapes
source_file                 file name of the lineitem scan (``_metadata``)
==========================  ===============================================

The airport dimension is nation x region, one airport per nation, covering
every region but MIDDLE EAST, so the silver LEFT joins also see misses.

Join order and strategy (fact-sized shuffles at scale: 2, not 3):

1. orders x customers on the customer key;
2. lineitem x (orders x customers) on the order key;
3. x suppliers on the supplier key;
4. x nation x region for each endpoint (25 rows; probed, broadcast), after all shuffles, so
   that what they carry is a nation key and not the eight texts of an endpoint.

Steps 1-3 broadcast the smaller side only when the stored size of the table
that bounds it (customer, orders, supplier) is small (file metadata only); otherwise they
are sort-merge joins, hinted so the fact side is never chosen for broadcast,
and AQE splits a skewed key (one customer or order holding a large share).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.joins import (
    TABLE_BROADCAST_MAX_BYTES,
    bounded_broadcast,
    join_with_checked_side,
)
from aerolake.operators.partitioning import spread_small_scan
from aerolake.operators.silver import conform_bronze
from aerolake.schema import SOURCE_FILE

# Fixed values of the mapping.
ICAO_PREFIX = "SB"
IATA_PREFIX = "I"
UF_PREFIX = "U"
UNCOVERED_REGION = "MIDDLE EAST"
LEGACY_DATE_LINE = 7
IMPOSSIBLE_DATE_LINE = 6
SUPPLIERS_WITHOUT_CODE = (50, 7)

# Columns of an endpoint, in the order of the record; the code comes first.
ENDPOINT = ("sg_icao", "sg_iata", "nm_aerodromo", "nm_municipio", "sg_uf", "nm_regiao", "nm_pais",
            "nm_continente")

# Row cap of the probe that allows broadcasting the (fixed-size) geography.
GEOGRAPHY_MAX_ROWS = 10_000


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _code(prefix: str, key: Column) -> Column:
    """At least two digits; a longer key keeps all of its own."""
    digits = key.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(2), F.length(digits)), F.lit("0")))


def nation_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation key, nation name, region name); both inputs are tiny, probed, broadcast."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = nation.join(bounded_broadcast(region, GEOGRAPHY_MAX_ROWS),
                         F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", "n_name", "r_name")


def airports_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed-shaped airport dimension (one airport per covered nation)."""
    geo = nation_geography(spark, sf_dir)
    return geo.filter(F.col("r_name") != UNCOVERED_REGION).select(
        _code(ICAO_PREFIX, F.col("n_nationkey")).alias("icao_aerodromo"),
        F.concat(F.lit("AIRPORT "), F.col("n_name")).alias("nome_aeroporto"),
        F.col("n_name").alias("cidade"),
        F.col("r_name").alias("estado"),
        _code(UF_PREFIX, F.col("n_nationkey")).alias("uf"),
        F.col("r_name").alias("regiao"),
    )


def _endpoint(geo: DataFrame, key: str, role: str) -> DataFrame:
    return geo.select(
        F.col("n_nationkey").alias(key),
        _code(ICAO_PREFIX, F.col("n_nationkey")).alias(f"sg_icao_{role}"),
        _code(IATA_PREFIX, F.col("n_nationkey")).alias(f"sg_iata_{role}"),
        F.concat(F.lit("AERÓDROMO "), F.col("n_name")).alias(f"nm_aerodromo_{role}"),
        F.concat_ws(" / ", "n_name", "r_name").alias(f"nm_municipio_{role}"),
        _code(UF_PREFIX, F.col("n_nationkey")).alias(f"sg_uf_{role}"),
        F.col("r_name").alias(f"nm_regiao_{role}"),
        F.col("n_name").alias(f"nm_pais_{role}"),
        F.col("r_name").alias(f"nm_continente_{role}"),
    )


def _text(expr: Column) -> Column:
    return expr.cast("string")


def _hour(shift: int) -> Column:
    return F.concat(F.lpad(_text((F.col("l_orderkey") + shift) % 24), 2, "0"), F.lit(":30"))


def _kind(same: Column) -> Column:
    return F.when(same, F.lit("DOMÉSTICA")).otherwise(F.lit("INTERNACIONAL"))


def _day_text(ts: Column, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(ts, pattern)


def flight_keys(spark: SparkSession, sf_dir: str,
                max_broadcast_bytes: int = TABLE_BROADCAST_MAX_BYTES) -> DataFrame:
    """One narrow row per flight: table columns as stored and a short code, endpoints by their
    nation key.

    What a job shuffles, sorts or keeps of the flights is this row; the texts of
    ``flight_rows`` are several times as wide.
    """
    customers = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_name", "c_acctbal",
        # once a customer: changing case costs more than the two letters do in the joins
        F.upper(F.substring("c_mktsegment", 1, 2)).alias("sg_empresa_iata"))
    suppliers = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders_c = join_with_checked_side(
        read_table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"),
        customers,
        F.col("o_custkey") == F.col("c_custkey"), table_path(sf_dir, "customer"),
        max_broadcast_bytes,
    ).drop("o_custkey")
    items = spread_small_scan(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
    ), table_path(sf_dir, "lineitem"))
    joined = join_with_checked_side(
        items, orders_c, F.col("l_orderkey") == F.col("o_orderkey"), table_path(sf_dir, "orders"),
        max_broadcast_bytes,
    )
    return join_with_checked_side(
        joined, suppliers, F.col("l_suppkey") == F.col("s_suppkey"), table_path(sf_dir, "supplier"),
        max_broadcast_bytes,
    ).drop("o_orderkey", "s_suppkey")


def reference_date() -> Column:
    """``dt_referencia`` of a flight, over the columns of ``flight_keys``."""
    line = F.col("l_linenumber")
    return (F.when(line == LEGACY_DATE_LINE, _day_text(F.col("o_orderdate"), "yyyy-MM-dd"))
            .when((line == IMPOSSIBLE_DATE_LINE) & (F.col("l_orderkey") % 10 == 3),
                  F.concat(F.lit("31/02/"), _day_text(F.col("o_orderdate"), "yyyy")))
            .otherwise(_day_text(F.col("o_orderdate"))))


def flights_from_tables(spark: SparkSession, sf_dir: str,
                        max_broadcast_bytes: int = TABLE_BROADCAST_MAX_BYTES) -> DataFrame:
    """Bronze-shaped flight rows (all STRING, 92 columns + ``source_file``)."""
    return flight_rows(spark, sf_dir, flight_keys(spark, sf_dir, max_broadcast_bytes))


def flight_rows(spark: SparkSession, sf_dir: str, keys: DataFrame) -> DataFrame:
    """The bronze-shaped rows of ``flight_keys`` (kept or dealt out anew in between)."""
    geo = bounded_broadcast(nation_geography(spark, sf_dir), GEOGRAPHY_MAX_ROWS)
    joined = (
        keys.join(_endpoint(geo, "c_nationkey", "origem"), "c_nationkey")
        .join(_endpoint(geo, "s_nationkey", "destino"), "s_nationkey")
        .withColumns({
            "id_empresa": _text(F.col("c_custkey")), "nm_empresa": F.col("c_name"),
            "sg_empresa_icao": F.col("c_mktsegment"),
            "ds_tipo_empresa": F.when(F.col("c_acctbal") < 0, F.lit("ESTRANGEIRA")).otherwise(F.lit("NACIONAL"))})
    )
    # the ship date text feeds both departure and arrival: format it once
    joined = joined.withColumn("_ship_text", _day_text(F.col("l_shipdate")))
    line, price = F.col("l_linenumber"), F.col("l_extendedprice").cast("decimal(18,2)")
    of, code = SUPPLIERS_WITHOUT_CODE
    flights = joined.select(
        F.concat_ws("-", _text(F.col("l_orderkey")), _text(line)).alias("id_combinada"),
        "id_empresa", "sg_empresa_icao", "sg_empresa_iata", "nm_empresa",
        F.col("nm_pais_origem").alias("nm_pais"), "ds_tipo_empresa",
        _text(F.col("l_orderkey")).alias("nr_voo"),
        _text(F.col("l_orderkey") % 97).alias("nr_singular"),
        _text(F.col("l_partkey")).alias("id_di"),
        F.col("l_returnflag").alias("cd_di"),
        F.when(F.col("l_linestatus") == "F", "REGULAR").when(F.col("l_linestatus") == "O", "EXTRA")
         .alias("ds_di"),
        F.col("l_linestatus").alias("ds_grupo_di"),
        _text(line % 3).alias("id_tipo_linha"),
        F.substring("o_orderpriority", 1, 1).alias("cd_tipo_linha"),
        F.col("o_orderpriority").alias("ds_tipo_linha"),
        _kind(F.col("nm_regiao_origem") == F.col("nm_regiao_destino")).alias("ds_natureza_tipo_linha"),
        F.col("o_orderstatus").alias("ds_servico_tipo_linha"),
        _kind(F.col("nm_pais_origem") == F.col("nm_pais_destino")).alias("ds_natureza_etapa"),
        reference_date().alias("dt_referencia"),
        _hour(0).alias("hr_partida_real"),
        F.when(F.col("l_returnflag") != "N", F.col("_ship_text")).alias("dt_partida_real"),
        _hour(1).alias("hr_chegada_real"),
        F.when(F.col("l_returnflag") == "A", F.col("_ship_text")).alias("dt_chegada_real"),
        *(f"{c}_origem" for c in ENDPOINT),
        _text(line).alias("nr_etapa"),
        F.when(~F.coalesce(F.col("l_suppkey") % of == code, F.lit(False)),
               F.col("sg_icao_destino")).alias("sg_icao_destino"),
        *(f"{c}_destino" for c in ENDPOINT[1:]),
        _text(line - 1).alias("nr_escala_destino"),
        F.concat(_text(line * 10), F.lit(".0")).alias("nr_passag_pagos"),
        _text(line).alias("nr_passag_gratis"),
        F.replace(_text(F.col("l_quantity").cast("decimal(18,1)")), F.lit("."), F.lit(","))
         .alias("kg_bagagem_livre"),
        _text((F.col("l_discount") * 100).cast("decimal(18,1)")).alias("kg_bagagem_excesso"),
        F.translate(F.format_number(price, 2), ",.", ".,").alias("kg_carga_paga"),
        F.when(line % 2 == 0, F.concat(_text(line), F.lit(",5"))).alias("kg_carga_gratis"),
        F.concat(F.lit("1."), F.lpad(_text(line * 100), 3, "0"), F.lit(",5")).alias("kg_correio"),
        SOURCE_FILE,
    )
    return conform_bronze(flights)


def silver_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolake.operators.silver import build_silver

    return build_silver(flights_from_tables(spark, sf_dir), airports_from_tables(spark, sf_dir))
