"""Registered queries over the driver tables: callables ``(spark, sf_dir) -> DataFrame``.

Every query runs over the whole tables; silver is the lazy plan of M1 over the
adapter, so Catalyst prunes it to the columns each query needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.operators import gold, quality
from aerolake.operators.silver import build_silver
from aerolake.session import scratch_dir, session_key, table_version
from aerolake.sources.adapter import airports_from_tables, flights_from_tables

Query = Callable[[SparkSession, str], DataFrame]


_LAYERS: dict[tuple, tuple[DataFrame, DataFrame, DataFrame]] = {}


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bronze, airports, silver) plans over ``sf_dir``; built once per session and
    version of the folder's files.

    DataFrames are immutable logical plans, so reusing them across queries is
    safe and saves rebuilding a ~100-column plan through py4j every time.
    """
    key = (session_key(spark), sf_dir, table_version(spark, sf_dir))
    if key not in _LAYERS:
        bronze = flights_from_tables(spark, sf_dir)
        airports = airports_from_tables(spark, sf_dir)
        _LAYERS[key] = (bronze, airports, build_silver(bronze, airports))
    return _LAYERS[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layers(spark, sf_dir)[2]


def q_silver_flights(spark, sf_dir):
    return silver(spark, sf_dir)


def q_date_guard(spark, sf_dir):
    return silver(spark, sf_dir).select("id_combinada", "dt_referencia", "dt_referencia_ts")


def q_calendar_parts(spark, sf_dir):
    return silver(spark, sf_dir).select(
        "id_combinada", "dt_referencia_ts", "ano", "mes", "dia", "trimestre",
        "dia_semana_num", "nome_mes", "nome_dia_semana")


def q_flight_status(spark, sf_dir):
    return silver(spark, sf_dir).select(
        "id_combinada", "dt_partida_real", "dt_chegada_real", "flag_situacao")


def q_route_key(spark, sf_dir):
    return silver(spark, sf_dir).select("id_combinada", "sg_icao_origem", "sg_icao_destino", "rota")


def q_airport_enrichment(spark, sf_dir):
    s = silver(spark, sf_dir)
    return s.select("id_combinada", "sg_icao_origem", "sg_icao_destino",
                    *[c for c in s.columns if c.startswith(("origem_", "destino_"))])


def q_gold_punctuality(spark, sf_dir):
    return gold.gold_punctuality(spark, silver(spark, sf_dir))


def q_gold_volume_by_period(spark, sf_dir):
    return gold.gold_volume_by_period(spark, silver(spark, sf_dir))


def q_gold_route_ranking(spark, sf_dir):
    return gold.gold_route_ranking(spark, silver(spark, sf_dir))


def q_route_ranking_top10(spark, sf_dir):
    return gold.gold_route_ranking(spark, silver(spark, sf_dir), top_k=10)


def q_dq_not_null(spark, sf_dir):
    return quality.not_null(silver(spark, sf_dir), "silver_voos", quality.SILVER_NOT_NULL)


def q_dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(silver(spark, sf_dir), "silver_voos", quality.STATUS_COLUMN)


def q_dq_declared_tests(spark, sf_dir):
    """The declared tests on a written silver table, as the workflow runs them: the joins
    run once, and each model scans the columns it needs."""
    _, airports, s = _layers(spark, sf_dir)
    path = scratch_dir(spark, "tested-silver")
    s.write.parquet(path)
    s = spark.read.parquet(path)
    return quality.declared_tests(
        s, airports,
        gold.gold_punctuality(spark, s),
        gold.gold_volume_by_period(spark, s),
        gold.gold_route_ranking(spark, s),
    )


def q_dq_row_reconciliation(spark, sf_dir):
    """Q7: rows of bronze and of the silver table as it was written."""
    bronze, _, s = _layers(spark, sf_dir)
    path = scratch_dir(spark, "reconciled-silver")
    s.write.parquet(path)
    return quality.row_reconciliation(bronze, spark.read.parquet(path))


def q_route_ranking_order(spark, sf_dir):
    """O1: where each rank stands in the ordered result: its first and last position.

    The result is written as it comes, each row with its task and place there; a place
    in the whole is that place and the rows of all tasks before (one number a task).
    """
    ranked = gold.gold_route_ranking(spark, silver(spark, sf_dir), ordered=True)
    path = scratch_dir(spark, "ordered-ranking")
    place = F.monotonically_increasing_id()
    ranked.select(F.col("ranking_volume_em_voo").alias("rank"), place.alias("place")).write.parquet(path)
    rows = spark.read.parquet(path).select(
        "rank", F.shiftright("place", 33).alias("task"), F.col("place").bitwiseAND((1 << 33) - 1).alias("at"))
    tasks = rows.groupBy("task").agg(F.count(F.lit(1)).alias("n"))
    before = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    position = F.col("before") + F.col("at") + 1
    return rows.join(F.broadcast(before), "task").groupBy("rank").agg(
        F.min(position).alias("first_position"), F.max(position).alias("last_position"),
        F.count(F.lit(1)).alias("rows"))


def q_dq_null_routes(spark, sf_dir):
    return quality.null_routes(silver(spark, sf_dir))


def q_dq_status_distribution(spark, sf_dir):
    return quality.status_distribution(silver(spark, sf_dir))


def q_dq_enrichment_coverage(spark, sf_dir):
    return quality.enrichment_coverage(silver(spark, sf_dir))


def q_dq_column_catalogue(spark, sf_dir):
    return quality.column_catalogue(silver(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "silver_flights": q_silver_flights,
    "date_guard": q_date_guard,
    "calendar_parts": q_calendar_parts,
    "flight_status": q_flight_status,
    "route_key": q_route_key,
    "airport_enrichment": q_airport_enrichment,
    "gold_punctuality": q_gold_punctuality,
    "gold_volume_by_period": q_gold_volume_by_period,
    "route_ranking_order": q_route_ranking_order,
    "gold_route_ranking": q_gold_route_ranking,
    "route_ranking_top10": q_route_ranking_top10,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_declared_tests": q_dq_declared_tests,
    "dq_row_reconciliation": q_dq_row_reconciliation,
    "dq_null_routes": q_dq_null_routes,
    "dq_status_distribution": q_dq_status_distribution,
    "dq_enrichment_coverage": q_dq_enrichment_coverage,
    "dq_column_catalogue": q_dq_column_catalogue,
}
