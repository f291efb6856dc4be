"""SURVEY §5 (d): properties of the models over whole driver tables (sf0.001)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.operators import gold
from aerolake.operators.silver import build_silver, lost_measures
from aerolake.plans import queries as Q
from aerolake.schema import BRONZE_SCHEMA, SILVER_MEASURE_TYPES
from aerolake.sources.seed import load_airport_seed

SF = "/root/testdata/sf0.001"


def test_silver_count_equals_bronze(spark):
    bronze, _, silver = Q._layers(spark, SF)
    assert bronze.count() == silver.count() == 6000


def test_status_counts_and_percentages(spark):
    p = Q.q_gold_punctuality(spark, SF)
    bad = p.filter(
        (F.col("voos_realizados") + F.col("voos_em_voo") + F.col("voos_programados") != F.col("total_voos"))
        | (F.abs(F.coalesce("taxa_realizacao_pct", F.lit(0.0)) + F.coalesce("taxa_em_voo_pct", F.lit(0.0))
                 + F.coalesce("taxa_programado_pct", F.lit(0.0)) - 100.0) > 0.2))
    assert bad.count() == 0
    assert p.agg(F.sum("total_voos")).first()[0] == 6000


def test_first_month_per_region_has_no_previous(spark):
    v = Q.q_gold_volume_by_period(spark, SF)
    w = Window.partitionBy("nm_regiao_origem").orderBy("ano", "mes")
    first = v.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    assert first.filter(F.col("total_voos_mes_anterior").isNotNull()).count() == 0
    assert first.count() == v.select("nm_regiao_origem").distinct().count()


def test_rank_one_exists_and_types(spark):
    r = Q.q_gold_route_ranking(spark, SF)
    assert r.filter("ranking_volume_em_voo = 1").count() >= 1
    assert r.filter("total_voos < 30").count() == 0
    types = dict(r.dtypes)
    for c in ("total_voos", "voos_em_voo", "voos_realizados", "ranking_volume_em_voo"):
        assert types[c] == "bigint"
    assert types["taxa_em_voo_pct"] == "double"
    v = dict(Q.q_gold_volume_by_period(spark, SF).dtypes)
    assert v["ano"] == "int" and v["qtd_rotas_ativas"] == "bigint" and v["variacao_pct_mes_anterior"] == "double"


def test_measure_casts(spark):
    """Thousands points only before a comma, whole numbers with a zero fraction, and a
    count of the values that are no numbers."""
    names = BRONZE_SCHEMA.fieldNames()
    row = dict.fromkeys(names)
    row.update(nr_passag_pagos="12.0", nr_passag_gratis="x", kg_carga_paga="1.234,5",
               kg_correio="2.25", kg_carga_gratis="1.234.567,5", kg_bagagem_livre="1.234")
    other = dict.fromkeys(names)
    other.update(nr_passag_pagos="12.5", nr_passag_gratis="9007199254740993")
    bronze = spark.createDataFrame([tuple(r[n] for n in names) for r in (row, other)], BRONZE_SCHEMA)
    s, t = build_silver(bronze, load_airport_seed(spark)).orderBy(F.desc("kg_correio")).collect()
    assert s.nr_passag_pagos == 12 and s.nr_passag_gratis is None
    assert s.kg_carga_paga == 1234.5 and s.kg_correio == 2.25
    assert s.kg_carga_gratis == 1234567.5 and s.kg_bagagem_livre == 1.234
    assert t.nr_passag_pagos is None and t.nr_passag_gratis == 9007199254740993
    lost = {r.column_name: r.lost for r in lost_measures(bronze).collect()}
    assert lost == {**dict.fromkeys(SILVER_MEASURE_TYPES, 0), "nr_passag_gratis": 1, "nr_passag_pagos": 1}


def test_required_columns(spark):
    """Names are matched without regard to case; an absent column raises."""
    names = BRONZE_SCHEMA.fieldNames()
    upper = spark.createDataFrame([tuple("1" for _ in names)], BRONZE_SCHEMA).toDF(
        *(n.upper() for n in names))
    assert build_silver(upper, load_airport_seed(spark)).first().nr_voo == "1"
    with pytest.raises(ValueError, match="nr_voo"):
        build_silver(upper.drop("NR_VOO"), load_airport_seed(spark))


def test_top_k_is_a_filter_of_the_full_ranking(spark):
    full = Q.q_gold_route_ranking(spark, SF)
    top = gold.gold_route_ranking(spark, Q.silver(spark, SF), top_k=3)
    assert sorted(map(str, top.collect())) == sorted(
        map(str, full.filter("ranking_volume_em_voo <= 3").collect()))
