"""M2-M4: the three gold models, written once as Spark SQL over ``{silver}``.

The same text runs two ways:

* ``gold_*(silver_df)`` -> ``spark.sql(TEXT, silver=silver_df)`` (a DataFrame);
* ``create_gold_views`` -> ``CREATE OR REPLACE VIEW gold.x AS TEXT`` over the
  silver table, so every read of the view is re-planned by Catalyst and AQE.

Plan notes (checked with ``explain("formatted")``):

* every aggregate is partial (map side) + final, so a hot key is pre-combined
  before the shuffle;
* the two distinct counts of the volume model are planned with ``Expand``; the
  shuffle is on (group keys, distinct value), so a hot group is still spread;
* the month-on-month ``lag`` runs over the monthly aggregate (rows per region
  are bounded by the number of months);
* the global route rank does *not* send all routes to one task. rank(v) is
  1 + the number of routes with a larger in-flight count, so it is computed
  over the histogram of distinct counts. If N flights qualify, the distinct
  counts d_1 < ... < d_D satisfy D(D-1)/2 <= N, so the histogram has at most
  1 + sqrt(2N) rows (about 1.4M rows for 10^12 flights): a proven bound for
  both the single ordered window over it and its broadcast back to the routes;
* both ranking branches use the same route aggregate (arrived = total minus
  in flight), so its shuffle is computed once and reused (``ReusedExchange``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.schema import STATUS_ARRIVED, STATUS_IN_FLIGHT, STATUS_SCHEDULED

DEFAULT_MIN_VOLUME = 30


def pct_sql(numerator: str, denominator: str, digits: int = 1) -> str:
    """SQL of the safe percentage: DOUBLE arithmetic, NULL when the base is 0/NULL."""
    return f"round(100.0D * ({numerator}) / nullif({denominator}, 0), {int(digits)})"


PUNCTUALITY_KEYS = (
    "sg_empresa_icao", "sg_icao_origem", "origem_cidade", "origem_estado",
    "nm_regiao_origem", "sg_icao_destino", "destino_cidade", "destino_estado",
    "nm_regiao_destino", "rota", "ano", "mes",
)
VOLUME_KEYS = ("ano", "mes", "nome_mes", "trimestre", "nm_regiao_origem")
RANKING_KEYS = (
    "rota", "sg_icao_origem", "origem_cidade", "sg_uf_origem",
    "sg_icao_destino", "destino_cidade", "sg_uf_destino",
)

_A, _F, _S = STATUS_ARRIVED, STATUS_IN_FLIGHT, STATUS_SCHEDULED

PUNCTUALITY_SQL = f"""
WITH group_counts AS (
  SELECT {", ".join(PUNCTUALITY_KEYS)},
         count(*) AS total_voos,
         count_if(flag_situacao = '{_A}') AS voos_realizados,
         count_if(flag_situacao = '{_F}') AS voos_em_voo,
         count_if(flag_situacao = '{_S}') AS voos_programados
  FROM {{silver}}
  WHERE flag_situacao IS NOT NULL
  GROUP BY {", ".join(PUNCTUALITY_KEYS)}
)
SELECT *,
       {pct_sql("voos_realizados", "total_voos")} AS taxa_realizacao_pct,
       {pct_sql("voos_em_voo", "total_voos")} AS taxa_em_voo_pct,
       {pct_sql("voos_programados", "total_voos")} AS taxa_programado_pct
FROM group_counts
"""

VOLUME_SQL = f"""
WITH monthly_counts AS (
  SELECT {", ".join(VOLUME_KEYS)},
         count(*) AS total_voos,
         count_if(flag_situacao = '{_A}') AS voos_realizados,
         count_if(flag_situacao = '{_F}') AS voos_em_voo,
         count_if(flag_situacao = '{_S}') AS voos_programados,
         count(DISTINCT sg_empresa_icao) AS qtd_empresas_ativas,
         count(DISTINCT rota) AS qtd_rotas_ativas
  FROM {{silver}}
  WHERE ano IS NOT NULL AND mes IS NOT NULL
  GROUP BY {", ".join(VOLUME_KEYS)}
),
with_previous_month AS (
  SELECT *,
         lag(total_voos) OVER (PARTITION BY nm_regiao_origem ORDER BY ano, mes)
           AS total_voos_mes_anterior
  FROM monthly_counts
)
SELECT *,
       {pct_sql("total_voos - total_voos_mes_anterior", "total_voos_mes_anterior")}
         AS variacao_pct_mes_anterior
FROM with_previous_month
"""


def ranking_sql(min_volume: int = DEFAULT_MIN_VOLUME, top_k: int | None = None,
                ordered: bool = False) -> str:
    """M4 text; ``top_k`` adds the consumer's ``rank <= k`` filter (O2)."""
    keys = ", ".join(RANKING_KEYS)
    top = f"WHERE r.ranking_volume_em_voo <= {int(top_k)}" if top_k is not None else ""
    order = "ORDER BY ranking_volume_em_voo" if ordered else ""
    # Every row kept is either arrived or in flight, so arrived = total - in flight.
    # Both branches below then need the same aggregate (count, in-flight count),
    # and the planner reuses its shuffle instead of aggregating the routes twice.
    return f"""
WITH route_counts AS (
  SELECT {keys},
         count(*) AS total_voos,
         count_if(flag_situacao = '{_F}') AS voos_em_voo
  FROM {{silver}}
  WHERE flag_situacao IN ('{_A}', '{_F}')
  GROUP BY {keys}
  HAVING count(*) >= {int(min_volume)}
),
rank_of_count AS (
  SELECT voos_em_voo,
         CAST(1 + coalesce(sum(n) OVER (ORDER BY voos_em_voo DESC
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS BIGINT) AS ranking_volume_em_voo
  FROM (SELECT voos_em_voo, count(*) AS n FROM route_counts GROUP BY voos_em_voo)
)
SELECT /*+ BROADCAST(r) */
       {", ".join("a." + k for k in RANKING_KEYS)},
       a.total_voos,
       a.voos_em_voo,
       a.total_voos - a.voos_em_voo AS voos_realizados,
       {pct_sql("a.voos_em_voo", "a.total_voos")} AS taxa_em_voo_pct,
       r.ranking_volume_em_voo
FROM route_counts a
JOIN rank_of_count r ON a.voos_em_voo = r.voos_em_voo
{top}
{order}
"""


def gold_punctuality(spark: SparkSession, silver: DataFrame) -> DataFrame:
    """M2: counts and completion rates by airline x route (with airports) x year x month."""
    return spark.sql(PUNCTUALITY_SQL, silver=silver)


def gold_volume_by_period(spark: SparkSession, silver: DataFrame) -> DataFrame:
    """M3: monthly volume by origin region with the previous existing month and % change."""
    return spark.sql(VOLUME_SQL, silver=silver)


def gold_route_ranking(spark: SparkSession, silver: DataFrame,
                       min_volume: int = DEFAULT_MIN_VOLUME, top_k: int | None = None,
                       ordered: bool = False) -> DataFrame:
    """M4: routes with >= ``min_volume`` departed flights ranked by flights not yet arrived."""
    return spark.sql(ranking_sql(min_volume, top_k, ordered), silver=silver)
