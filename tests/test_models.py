"""M1-M4 golden values on the 12-row fixture and the ranking fixture; properties."""

from pyspark.sql import functions as F

from aerolake.operators import gold, quality
from aerolake.operators.silver import build_silver
from aerolake.schema import SILVER_COLUMNS
from aerolake.sources.seed import load_airport_seed
from tests.fixtures import f1_bronze, f6_silver


def silver_f1(spark):
    return build_silver(f1_bronze(spark), load_airport_seed(spark))


def test_silver_shape_and_rows(spark):
    s = silver_f1(spark)
    assert tuple(s.columns) == SILVER_COLUMNS and len(SILVER_COLUMNS) == 70
    assert s.count() == 12
    r = {x.id_combinada: x for x in s.collect()}
    assert r["1"].flag_situacao == "realizado" and r["1"].dia_semana_num == 0
    assert r["1"].nome_mes == "January  " and r["1"].trimestre == 1
    assert r["1"].origem_cidade == "Guarulhos" and r["1"].destino_cidade == "São Paulo"
    assert r["2"].flag_situacao == "em_voo"
    assert r["3"].flag_situacao == "programado"
    assert r["4"].flag_situacao == "realizado"
    assert r["5"].origem_cidade is None and r["5"].destino_cidade == "Rio de Janeiro"
    assert r["6"].rota is None
    for k in ("7", "8", "9", "10"):
        assert r[k].dt_referencia_ts is None and r[k].ano is None
    assert r["10"].flag_situacao == "programado"
    assert r["12"].dia_semana_num == 4 and str(r["12"].dt_referencia_ts) == "2024-02-29"
    assert dict(s.dtypes)["dt_referencia_ts"] == "date"


def test_volume_by_period_golden(spark):
    v = gold.gold_volume_by_period(spark, silver_f1(spark))
    got = sorted((r.ano, r.mes, r.total_voos, r.qtd_empresas_ativas, r.qtd_rotas_ativas,
                  r.total_voos_mes_anterior, r.variacao_pct_mes_anterior) for r in v.collect())
    assert got == [
        (2024, 2, 1, 1, 1, None, None),
        (2024, 12, 1, 0, 1, 1, 0.0),
        (2025, 1, 4, 2, 2, 1, 300.0),
        (2025, 2, 1, 1, 1, 4, -75.0),
        (2025, 4, 1, 1, 1, 1, 0.0),     # previous *existing* month (March is missing)
    ]
    assert all(r.nm_regiao_origem is None for r in v.collect())


def test_punctuality_keeps_undated_rows(spark):
    p = gold.gold_punctuality(spark, silver_f1(spark))
    total = p.agg(F.sum("total_voos")).first()[0]
    assert total == 12                      # rows 7-10 kept (ano NULL group)
    for r in p.collect():
        assert r.voos_realizados + r.voos_em_voo + r.voos_programados == r.total_voos
        s = (r.taxa_realizacao_pct or 0) + (r.taxa_em_voo_pct or 0) + (r.taxa_programado_pct or 0)
        assert abs(s - 100.0) <= 0.2


def test_route_ranking_threshold_and_ties(spark):
    r = gold.gold_route_ranking(spark, f6_silver(spark), min_volume=30)
    got = sorted((x.rota, x.total_voos, x.voos_em_voo, x.ranking_volume_em_voo, x.taxa_em_voo_pct)
                 for x in r.collect())
    assert got == [("C -> D", 30, 10, 1, 33.3), ("E -> F", 31, 10, 1, 32.3), ("G -> H", 33, 8, 3, 24.2)]
    assert dict(r.dtypes)["ranking_volume_em_voo"] == "bigint"
    top1 = gold.gold_route_ranking(spark, f6_silver(spark), top_k=1)
    assert sorted(x.rota for x in top1.collect()) == ["C -> D", "E -> F"]


def test_route_ranking_matches_window_rank(spark):
    """The histogram rank equals rank() OVER (ORDER BY voos_em_voo DESC)."""
    base = spark.range(200).select(
        F.concat(F.lit("R"), F.col("id").cast("string")).alias("rota"), (F.col("id") % 13).alias("k"))
    arrived = base.select("rota", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("i"),
                          F.lit("realizado").alias("flag_situacao"))
    in_air = base.filter("k > 0").select(
        "rota", F.explode(F.sequence(F.lit(1), F.col("k").cast("int"))).alias("i"),
        F.lit("em_voo").alias("flag_situacao"))
    nulls = [F.lit(None).cast("string").alias(c) for c in gold.RANKING_KEYS[1:]]
    silver = arrived.unionByName(in_air).select("rota", *nulls, "flag_situacao")
    ours = gold.gold_route_ranking(spark, silver)
    ref = spark.sql(
        "SELECT rota, CAST(rank() OVER (ORDER BY n DESC) AS BIGINT) AS rk FROM ("
        " SELECT rota, count_if(flag_situacao = 'em_voo') AS n FROM {s} GROUP BY rota)", s=silver)
    got = sorted((r.rota, r.ranking_volume_em_voo) for r in ours.collect())
    assert len(got) == 200
    assert got == sorted((r.rota, r.rk) for r in ref.collect())


def test_quality_on_fixture(spark):
    s = silver_f1(spark)
    nn = {r.column_name: r.failures for r in quality.not_null(s, "silver_voos", quality.SILVER_NOT_NULL).collect()}
    assert nn["rota"] == 1 and nn["sg_empresa_icao"] == 1 and nn["dt_referencia_ts"] == 4
    assert nn["flag_situacao"] == 0
    dist = {r.flag_situacao: r.total for r in quality.status_distribution(s).collect()}
    assert sum(dist.values()) == 12
    rec = quality.row_reconciliation(f1_bronze(spark), s).first()
    assert rec.bronze_rows == rec.silver_rows == 12 and rec.rows_match
    cov = quality.enrichment_coverage(s).first()
    assert cov.total_voos == 12 and cov.voos_origem_enriquecida == 10


def test_strict_mode_raises(spark):
    import pytest
    report = quality.not_null(silver_f1(spark), "silver_voos", ("rota", "nr_voo"))
    with pytest.raises(AssertionError, match="rota not_null: 1"):
        quality.enforce(report)
    ok = quality.not_null(silver_f1(spark), "silver_voos", ("nr_voo",))
    assert quality.enforce(ok) is ok


def test_clustered_silver_has_the_same_rows(spark):
    plain = build_silver(f1_bronze(spark), load_airport_seed(spark))
    clustered = build_silver(f1_bronze(spark), load_airport_seed(spark), cluster_by_month=True)
    assert clustered.columns == plain.columns
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(plain.collect(), key=key) == sorted(clustered.collect(), key=key)
    from tests.test_plans import plan
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(clustered)
