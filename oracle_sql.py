"""DuckDB formulations of the registered queries (the correctness oracle).

Written independently of the Spark code, in the shape of the original SQL
models (``SUM(CASE ...)``, ``rank() OVER``, ``strptime``), over the driver's
pre-registered views. Integer results are cast to BIGINT and percentages are
computed in DOUBLE so types line up with the Spark side.
"""

from __future__ import annotations

# Fixed values, written out here again so that a wrong list on the Spark side shows:
# columns of the flight record, the airport seed and the silver table, and the types of
# silver's load measures.
BRONZE_COLUMNS = """
    id_combinada id_empresa sg_empresa_icao sg_empresa_iata nm_empresa nm_pais ds_tipo_empresa
    ds_tipo_empresa_estrangeira nr_voo nr_singular id_di cd_di ds_di ds_di_etapa ds_grupo_di
    dt_referencia nr_ano_referencia nr_semestre_referencia nm_semestre_referencia
    nr_trimestre_referencia nm_trimestre_referencia nr_mes_referencia nm_mes_referencia
    nr_semana_referencia nm_dia_semana_referencia nr_dia_referencia nr_ano_mes_referencia
    id_tipo_linha cd_tipo_linha ds_tipo_linha ds_natureza_tipo_linha ds_servico_tipo_linha
    ds_natureza_etapa hr_partida_real dt_partida_real nr_ano_partida_real
    nr_semestre_partida_real nm_semestre_partida_real nr_trimestre_partida_real
    nm_trimestre_partida_real nr_mes_partida_real nm_mes_partida_real nr_semana_partida_real
    nm_dia_semana_partida_real nr_dia_partida_real nr_ano_mes_partida_real id_aerodromo_origem
    sg_icao_origem sg_iata_origem nm_aerodromo_origem nm_municipio_origem sg_uf_origem
    nm_regiao_origem nm_pais_origem nm_continente_origem nr_etapa hr_chegada_real
    dt_chegada_real nr_ano_chegada_real nr_semestre_chegada_real nm_semestre_chegada_real
    nr_trimestre_chegada_real nm_trimestre_chegada_real nr_mes_chegada_real nm_mes_chegada_real
    nr_semana_chegada_real nm_dia_semana_chegada_real nr_dia_chegada_real
    nr_ano_mes_chegada_real id_aerodromo_destino sg_icao_destino sg_iata_destino
    nm_aerodromo_destino nm_municipio_destino sg_uf_destino nm_regiao_destino nm_pais_destino
    nm_continente_destino nr_escala_destino cd_cotran ds_cotran nr_passag_pagos nr_passag_gratis
    kg_bagagem_livre kg_bagagem_excesso kg_carga_paga kg_carga_gratis kg_correio id_arquivo
    nm_arquivo nr_linha dt_sistema
""".split()
SEED_COLUMNS = """
    icao_aerodromo nome_aeroporto cidade estado uf regiao
""".split()
SILVER_COLUMNS = """
    id_combinada id_empresa sg_empresa_icao sg_empresa_iata nm_empresa nm_pais ds_tipo_empresa
    nr_voo nr_singular id_di cd_di ds_di ds_grupo_di id_tipo_linha cd_tipo_linha ds_tipo_linha
    ds_natureza_tipo_linha ds_servico_tipo_linha ds_natureza_etapa dt_referencia
    dt_referencia_ts ano mes dia trimestre dia_semana_num nome_mes nome_dia_semana
    hr_partida_real dt_partida_real hr_chegada_real dt_chegada_real sg_icao_origem
    sg_iata_origem nm_aerodromo_origem nm_municipio_origem sg_uf_origem nm_regiao_origem
    nm_pais_origem nm_continente_origem nr_etapa sg_icao_destino sg_iata_destino
    nm_aerodromo_destino nm_municipio_destino sg_uf_destino nm_regiao_destino nm_pais_destino
    nm_continente_destino nr_escala_destino nr_passag_pagos nr_passag_gratis kg_bagagem_livre
    kg_bagagem_excesso kg_carga_paga kg_carga_gratis kg_correio flag_situacao rota
    origem_nome_aeroporto origem_cidade origem_estado origem_uf_seed origem_regiao_seed
    destino_nome_aeroporto destino_cidade destino_estado destino_uf_seed destino_regiao_seed
    source_file
""".split()
SILVER_MEASURE_TYPES = {
    "nr_passag_pagos": "BIGINT", "nr_passag_gratis": "BIGINT", "kg_bagagem_livre": "DOUBLE",
    "kg_bagagem_excesso": "DOUBLE", "kg_carga_paga": "DOUBLE", "kg_carga_gratis": "DOUBLE",
    "kg_correio": "DOUBLE",
}


# Silver columns whose expression cannot be NULL.
NEVER_NULL = set("""
    id_combinada ds_tipo_empresa ds_natureza_tipo_linha ds_natureza_etapa nm_municipio_origem
    nm_municipio_destino flag_situacao source_file
""".split())


def _code(prefix: str, key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"'{prefix}' || lpad({text}, CAST(greatest(2, length({text})) AS INTEGER), '0')"


def _pct(num: str, den: str) -> str:
    return f"round(CAST(100.0 AS DOUBLE) * ({num}) / nullif({den}, 0), 1)"


def _varchar(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _hour(shift: int) -> str:
    return f"lpad(CAST((l.l_orderkey + {shift}) % 24 AS VARCHAR), 2, '0') || ':30'"


def _kind(same: str) -> str:
    return f"CASE WHEN {same} THEN 'DOMÉSTICA' ELSE 'INTERNACIONAL' END"


def _endpoint(role: str, key: str, geo: str) -> dict[str, str]:
    return {
        f"sg_icao_{role}": _code("SB", key),
        f"sg_iata_{role}": _code("I", key),
        f"nm_aerodromo_{role}": f"'AERÓDROMO ' || {geo}.n_name",
        f"nm_municipio_{role}": f"{geo}.n_name || ' / ' || {geo}.r_name",
        f"sg_uf_{role}": _code("U", key),
        f"nm_regiao_{role}": f"{geo}.r_name",
        f"nm_pais_{role}": f"{geo}.n_name",
        f"nm_continente_{role}": f"{geo}.r_name",
    }


_SUPPLIED = {
    **_endpoint("origem", "c.c_nationkey", "cg"),
    **_endpoint("destino", "s.s_nationkey", "sg"),
    "id_combinada": "CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)",
    "id_empresa": _varchar("c.c_custkey"),
    "sg_empresa_icao": "c.c_mktsegment",
    "sg_empresa_iata": "upper(substr(c.c_mktsegment, 1, 2))",
    "nm_empresa": "c.c_name",
    "nm_pais": "cg.n_name",
    "ds_tipo_empresa": "CASE WHEN c.c_acctbal < 0 THEN 'ESTRANGEIRA' ELSE 'NACIONAL' END",
    "nr_voo": _varchar("l.l_orderkey"),
    "nr_singular": _varchar("l.l_orderkey % 97"),
    "id_di": _varchar("l.l_partkey"),
    "cd_di": "l.l_returnflag",
    "ds_di": "CASE l.l_linestatus WHEN 'F' THEN 'REGULAR' WHEN 'O' THEN 'EXTRA' END",
    "ds_grupo_di": "l.l_linestatus",
    "id_tipo_linha": _varchar("l.l_linenumber % 3"),
    "cd_tipo_linha": "substr(o.o_orderpriority, 1, 1)",
    "ds_tipo_linha": "o.o_orderpriority",
    "ds_natureza_tipo_linha": _kind("cg.r_name = sg.r_name"),
    "ds_servico_tipo_linha": "o.o_orderstatus",
    "ds_natureza_etapa": _kind("cg.n_name = sg.n_name"),
    "dt_referencia": "CASE WHEN l.l_linenumber = 7 THEN strftime(o.o_orderdate, '%Y-%m-%d') "
                     "WHEN l.l_linenumber = 6 AND l.l_orderkey % 10 = 3 "
                     "THEN '31/02/' || strftime(o.o_orderdate, '%Y') "
                     "ELSE strftime(o.o_orderdate, '%d/%m/%Y') END",
    "hr_partida_real": _hour(0),
    "dt_partida_real": "CASE WHEN l.l_returnflag <> 'N' THEN strftime(l.l_shipdate, '%d/%m/%Y') END",
    "hr_chegada_real": _hour(1),
    "dt_chegada_real": "CASE WHEN l.l_returnflag = 'A' THEN strftime(l.l_shipdate, '%d/%m/%Y') END",
    "nr_etapa": _varchar("l.l_linenumber"),
    "sg_icao_destino": f"CASE WHEN l.l_suppkey % 50 = 7 THEN NULL ELSE {_code('SB', 's.s_nationkey')} END",
    "nr_escala_destino": _varchar("l.l_linenumber - 1"),
    "nr_passag_pagos": "CAST(l.l_linenumber * 10 AS VARCHAR) || '.0'",
    "nr_passag_gratis": _varchar("l.l_linenumber"),
    "kg_bagagem_livre": "replace(CAST(CAST(l.l_quantity AS DECIMAL(18,1)) AS VARCHAR), '.', ',')",
    "kg_bagagem_excesso": _varchar("CAST(l.l_discount * 100 AS DECIMAL(18,1))"),
    "kg_carga_paga": "translate(format('{:,.2f}', l.l_extendedprice), ',.', '.,')",
    "kg_carga_gratis": "CASE WHEN l.l_linenumber % 2 = 0 THEN CAST(l.l_linenumber AS VARCHAR) || ',5' END",
    "kg_correio": "'1.' || lpad(CAST(l.l_linenumber * 100 AS VARCHAR), 3, '0') || ',5'",
}

_bronze_select = ",\n    ".join(
    f"{_SUPPLIED.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in BRONZE_COLUMNS
)

_DERIVED = {
    "dt_referencia_ts": "b.dt_referencia_ts",
    "ano": "CAST(year(b.dt_referencia_ts) AS INTEGER)",
    "mes": "CAST(month(b.dt_referencia_ts) AS INTEGER)",
    "dia": "CAST(day(b.dt_referencia_ts) AS INTEGER)",
    "trimestre": "CAST(quarter(b.dt_referencia_ts) AS INTEGER)",
    "dia_semana_num": "CAST(dayofweek(b.dt_referencia_ts) AS INTEGER)",
    "nome_mes": "rpad(strftime(b.dt_referencia_ts, '%B'), 9, ' ')",
    "nome_dia_semana": "rpad(strftime(b.dt_referencia_ts, '%A'), 9, ' ')",
    "flag_situacao": "CASE WHEN b.dt_chegada_real IS NOT NULL THEN 'realizado' "
                     "WHEN b.dt_partida_real IS NOT NULL THEN 'em_voo' ELSE 'programado' END",
    "rota": "b.sg_icao_origem || ' -> ' || b.sg_icao_destino",
    "origem_nome_aeroporto": "ao.nome_aeroporto", "origem_cidade": "ao.cidade",
    "origem_estado": "ao.estado", "origem_uf_seed": "ao.uf", "origem_regiao_seed": "ao.regiao",
    "destino_nome_aeroporto": "ad.nome_aeroporto", "destino_cidade": "ad.cidade",
    "destino_estado": "ad.estado", "destino_uf_seed": "ad.uf", "destino_regiao_seed": "ad.regiao",
}


def _silver_expr(c: str) -> str:
    if c in _DERIVED:
        return f"{_DERIVED[c]} AS {c}"
    if c in SILVER_MEASURE_TYPES:
        # a point groups thousands only where a comma marks the decimals
        number = (f"TRY_CAST(CASE WHEN contains(b.{c}, ',') "
                  f"THEN replace(replace(b.{c}, '.', ''), ',', '.') ELSE b.{c} END AS DOUBLE)")
        if SILVER_MEASURE_TYPES[c] == "BIGINT":
            return f"CASE WHEN {number} = floor({number}) THEN CAST({number} AS BIGINT) END AS {c}"
        return f"{number} AS {c}"
    return f"b.{c} AS {c}"


_silver_select = ",\n    ".join(_silver_expr(c) for c in SILVER_COLUMNS)

BASE_CTES = f"""
geo AS (
  SELECT n.n_nationkey AS nk, n.n_name, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
airports AS (
  SELECT {_code("SB", "nk")} AS icao_aerodromo, 'AIRPORT ' || n_name AS nome_aeroporto,
         n_name AS cidade, r_name AS estado, {_code("U", "nk")} AS uf, r_name AS regiao
  FROM geo WHERE r_name <> 'MIDDLE EAST'
),
bronze AS (
  SELECT
    {_bronze_select},
    'lineitem.parquet' AS source_file
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN geo cg ON c.c_nationkey = cg.nk
  JOIN geo sg ON s.s_nationkey = sg.nk
),
bronze_dated AS (
  SELECT *,
    CASE WHEN regexp_full_match(dt_referencia, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')
         THEN CAST(try_strptime(dt_referencia, '%d/%m/%Y') AS DATE) END AS dt_referencia_ts
  FROM bronze
),
silver AS (
  SELECT
    {_silver_select}
  FROM bronze_dated b
  LEFT JOIN airports ao ON b.sg_icao_origem = ao.icao_aerodromo
  LEFT JOIN airports ad ON b.sg_icao_destino = ad.icao_aerodromo
)"""


def _with(body: str, extra_ctes: str = "") -> str:
    ctes = BASE_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def _sum_case(v: str) -> str:
    return f"CAST(SUM(CASE WHEN flag_situacao = '{v}' THEN 1 ELSE 0 END) AS BIGINT)"


GOLD_PUNCTUALITY_CTE = f"""
gold_pontualidade AS (
  SELECT *,
    {_pct("voos_realizados", "total_voos")} AS taxa_realizacao_pct,
    {_pct("voos_em_voo", "total_voos")} AS taxa_em_voo_pct,
    {_pct("voos_programados", "total_voos")} AS taxa_programado_pct
  FROM (
    SELECT sg_empresa_icao, sg_icao_origem, origem_cidade, origem_estado, nm_regiao_origem,
           sg_icao_destino, destino_cidade, destino_estado, nm_regiao_destino, rota, ano, mes,
           count(*) AS total_voos,
           {_sum_case("realizado")} AS voos_realizados,
           {_sum_case("em_voo")} AS voos_em_voo,
           {_sum_case("programado")} AS voos_programados
    FROM silver WHERE flag_situacao IS NOT NULL
    GROUP BY sg_empresa_icao, sg_icao_origem, origem_cidade, origem_estado, nm_regiao_origem,
             sg_icao_destino, destino_cidade, destino_estado, nm_regiao_destino, rota, ano, mes
  ) group_counts
)"""

GOLD_VOLUME_CTE = f"""
gold_volume_periodo AS (
  SELECT *,
    {_pct("total_voos - total_voos_mes_anterior", "total_voos_mes_anterior")} AS variacao_pct_mes_anterior
  FROM (
    SELECT *, lag(total_voos) OVER (PARTITION BY nm_regiao_origem ORDER BY ano, mes)
              AS total_voos_mes_anterior
    FROM (
      SELECT ano, mes, nome_mes, trimestre, nm_regiao_origem,
             count(*) AS total_voos,
             {_sum_case("realizado")} AS voos_realizados,
             {_sum_case("em_voo")} AS voos_em_voo,
             {_sum_case("programado")} AS voos_programados,
             count(DISTINCT sg_empresa_icao) AS qtd_empresas_ativas,
             count(DISTINCT rota) AS qtd_rotas_ativas
      FROM silver WHERE ano IS NOT NULL AND mes IS NOT NULL
      GROUP BY ano, mes, nome_mes, trimestre, nm_regiao_origem
    ) monthly_counts
  ) with_previous_month
)"""

GOLD_RANKING_CTE = f"""
gold_ranking_rotas_atrasadas AS (
  SELECT *,
    {_pct("voos_em_voo", "total_voos")} AS taxa_em_voo_pct,
    CAST(rank() OVER (ORDER BY voos_em_voo DESC) AS BIGINT) AS ranking_volume_em_voo
  FROM (
    SELECT rota, sg_icao_origem, origem_cidade, sg_uf_origem, sg_icao_destino, destino_cidade,
           sg_uf_destino,
           count(*) AS total_voos,
           {_sum_case("em_voo")} AS voos_em_voo,
           {_sum_case("realizado")} AS voos_realizados
    FROM silver WHERE flag_situacao IN ('realizado', 'em_voo')
    GROUP BY rota, sg_icao_origem, origem_cidade, sg_uf_origem, sg_icao_destino, destino_cidade,
             sg_uf_destino
    HAVING count(*) >= 30
  ) route_counts
)"""

ALL_GOLD = ",\n".join([GOLD_PUNCTUALITY_CTE, GOLD_VOLUME_CTE, GOLD_RANKING_CTE])


def _not_null_rows(model: str, table: str, columns) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {table}"
        for c in columns
    )


_ACCEPTED_ROW = (
    "SELECT 'silver_voos' AS model, 'flag_situacao' AS column_name, 'accepted_values' AS test, "
    "CAST(count(DISTINCT flag_situacao) FILTER (WHERE flag_situacao NOT IN "
    "('realizado', 'em_voo', 'programado')) AS BIGINT) AS failures FROM silver"
)
_UNIQUE_ROW = (
    "SELECT 'bronze_seed_aeroportos' AS model, 'icao_aerodromo' AS column_name, 'unique' AS test, "
    "CAST(count(*) AS BIGINT) AS failures FROM (SELECT icao_aerodromo FROM airports "
    "WHERE icao_aerodromo IS NOT NULL GROUP BY icao_aerodromo HAVING count(*) > 1) d"
)

_SILVER_NOT_NULL = ("sg_empresa_icao", "nr_voo", "sg_icao_origem", "sg_icao_destino",
                    "flag_situacao", "rota", "ano", "mes", "dia", "dt_referencia_ts")


_DECLARED = "\nUNION ALL\n".join([
    _not_null_rows("silver_voos", "silver", _SILVER_NOT_NULL),
    _ACCEPTED_ROW,
    _not_null_rows("gold_pontualidade", "gold_pontualidade", ["total_voos"]),
    _not_null_rows("gold_volume_periodo", "gold_volume_periodo", ["total_voos"]),
    _not_null_rows("gold_ranking_rotas_atrasadas", "gold_ranking_rotas_atrasadas",
                   ["ranking_volume_em_voo"]),
    _not_null_rows("bronze_seed_aeroportos", "airports", SEED_COLUMNS),
    _UNIQUE_ROW,
])


def _report(rows_sql: str) -> str:
    return f"SELECT model, column_name, test, failures, failures = 0 AS passed FROM (\n{rows_sql}\n) t"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_flights"] = _with("SELECT * FROM silver")
    q["date_guard"] = _with("SELECT id_combinada, dt_referencia, dt_referencia_ts FROM silver")
    q["calendar_parts"] = _with(
        "SELECT id_combinada, dt_referencia_ts, ano, mes, dia, trimestre, dia_semana_num, "
        "nome_mes, nome_dia_semana FROM silver")
    q["flight_status"] = _with(
        "SELECT id_combinada, dt_partida_real, dt_chegada_real, flag_situacao FROM silver")
    q["route_key"] = _with("SELECT id_combinada, sg_icao_origem, sg_icao_destino, rota FROM silver")
    q["airport_enrichment"] = _with(
        "SELECT id_combinada, sg_icao_origem, sg_icao_destino, origem_nome_aeroporto, "
        "origem_cidade, origem_estado, origem_uf_seed, origem_regiao_seed, destino_nome_aeroporto, "
        "destino_cidade, destino_estado, destino_uf_seed, destino_regiao_seed FROM silver")
    q["gold_punctuality"] = _with("SELECT * FROM gold_pontualidade", GOLD_PUNCTUALITY_CTE)
    q["gold_volume_by_period"] = _with("SELECT * FROM gold_volume_periodo", GOLD_VOLUME_CTE)
    q["gold_route_ranking"] = _with("SELECT * FROM gold_ranking_rotas_atrasadas", GOLD_RANKING_CTE)
    q["route_ranking_order"] = _with(
        "SELECT ranking_volume_em_voo AS rank, ranking_volume_em_voo AS first_position, "
        "ranking_volume_em_voo + count(*) - 1 AS last_position, count(*) AS rows "
        "FROM gold_ranking_rotas_atrasadas GROUP BY ranking_volume_em_voo", GOLD_RANKING_CTE)
    q["route_ranking_top10"] = _with(
        "SELECT * FROM gold_ranking_rotas_atrasadas WHERE ranking_volume_em_voo <= 10",
        GOLD_RANKING_CTE)
    q["dq_not_null"] = _with(_report(_not_null_rows("silver_voos", "silver", _SILVER_NOT_NULL)))
    q["dq_accepted_values"] = _with(_report(_ACCEPTED_ROW))
    q["dq_declared_tests"] = _with(_report(_DECLARED), ALL_GOLD)
    q["dq_row_reconciliation"] = _with(
        "SELECT bronze_rows, silver_rows, bronze_rows = silver_rows AS rows_match FROM "
        "(SELECT count(*) AS bronze_rows FROM bronze) b, (SELECT count(*) AS silver_rows FROM silver) s")
    q["dq_null_routes"] = _with(
        "SELECT count(*) AS total_voos, CAST(count(*) FILTER (WHERE rota IS NULL) AS BIGINT) "
        "AS voos_sem_rota FROM silver")
    q["dq_status_distribution"] = _with(
        "SELECT flag_situacao, total, " + _pct("total", "sum(total) OVER ()") + " AS share_pct "
        "FROM (SELECT flag_situacao, count(*) AS total FROM silver GROUP BY flag_situacao) t")
    q["dq_enrichment_coverage"] = _with(
        "SELECT total_voos, voos_origem_enriquecida, voos_destino_enriquecida, "
        + _pct("voos_origem_enriquecida", "total_voos") + " AS cobertura_origem_pct, "
        + _pct("voos_destino_enriquecida", "total_voos") + " AS cobertura_destino_pct FROM "
        "(SELECT count(*) AS total_voos, count(origem_cidade) AS voos_origem_enriquecida, "
        "count(destino_cidade) AS voos_destino_enriquecida FROM silver) t")
    return q


_GROUP = "coalesce(o_orderkey % 3, 2)"
# ISO-8859-1 text without control characters is windows-1252 text
_ENCODING = ("CASE coalesce(o_orderkey % 6, 5) WHEN 0 THEN 'UTF-8' WHEN 1 THEN 'windows-1252' "
             "WHEN 2 THEN 'UTF-16BE' WHEN 3 THEN 'windows-1252' WHEN 4 THEN 'IBM860' ELSE 'x-MacTurkish' END")
_PRIORITY_WORD = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'urgente' WHEN '2-HIGH' THEN 'alta' "
                  "WHEN '3-MEDIUM' THEN 'média' WHEN '4-NOT SPECIFIED' THEN 'não especificada' "
                  "WHEN '5-LOW' THEN 'baixa' END")


# characters of the text column where the least order has a field of 1 MB
_LONG = "CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 1000000 ELSE 1 END"


def ingest_oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ingest_text_roundtrip"] = (
        f"SELECT o_orderstatus, {_ENCODING} AS encoding, count(*) AS rows, "
        "CAST(sum(o_orderkey) AS BIGINT) AS key_sum, "
        "count(*) FILTER (WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')) AS notes, "
        "count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS media_rows, "
        "count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS quoted_rows, "
        f"CAST(sum(length({_PRIORITY_WORD})) AS BIGINT) AS word_chars "
        f"FROM orders GROUP BY o_orderstatus, {_ENCODING}")
    q["parquet_profile"] = (
        "SELECT CAST(count(*) AS BIGINT) AS total_rows, 6 AS columns, true AS all_valid FROM orders")
    q["ingest_unified_append"] = (
        "SELECT o_orderstatus, count(*) AS bronze_rows, count(DISTINCT o_orderkey) AS distinct_orders, "
        "CAST(0 AS BIGINT) AS second_run_rows FROM orders GROUP BY o_orderstatus")
    q["dq_load_reconciliation"] = (
        "SELECT count(*) AS source_rows, count(*) AS loaded_rows, true AS all_reconciled, "
        "CAST(1 AS BIGINT) AS files_with_swap FROM orders")
    texts = (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
        "o_orderstatus, strftime(o_orderdate, '%d/%m/%Y') AS dt_pedido, "
        f"{_PRIORITY_WORD} AS ds_prioridade, "
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'atenção; \"urgente\"' "
        "WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN NULL ELSE o_orderpriority END "
        "AS ds_observacao FROM orders")

    def kind(c: str) -> str:
        return (f"SELECT '{c}' AS column_name, CASE WHEN count({c}) = 0 THEN 'null' "
                f"WHEN count(TRY_CAST({c} AS BIGINT)) = count({c}) THEN 'bigint' "
                f"WHEN count(TRY_CAST(replace({c}, ',', '.') AS DOUBLE)) = count({c}) THEN 'double' "
                f"ELSE 'string' END AS inferred_type FROM t")

    cols = ("o_orderkey", "o_custkey", "o_orderstatus", "dt_pedido", "ds_prioridade", "ds_observacao")
    q["dq_type_profile"] = f"WITH t AS ({texts})\n" + "\nUNION ALL\n".join(kind(c) for c in cols)
    q["consolidate_files"] = (
        "SELECT o_orderstatus, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum "
        "FROM orders GROUP BY o_orderstatus")
    q["sample_rows"] = "SELECT count(*) AS sampled_rows FROM (SELECT * FROM orders LIMIT 100) s"
    # what is kept of each variant: status, texts and their length (rows are all or none)
    kept = [("extra_fields", None), ("extra_after_accent", None), ("extra_in_quoted_lines", None),
            ("accent_at_end", "6"), ("missing_fields", "1"), ("repeated_header", "7"),
            ("utf16_crlf", "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 2 END"),
            ("stray_quote", "10"), ("quoted_lines", "8"), ("long_quoted", _LONG), ("long_quoted_lines", _LONG),
            ("unclosed_quote", None)]
    q["ingest_text_edge_cases"] = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS variant, " + (
            "'failed' AS status, CAST(0 AS BIGINT) AS rows, CAST(NULL AS BIGINT) AS key_sum, "
            "CAST(0 AS BIGINT) AS texts, CAST(NULL AS BIGINT) AS text_chars" if chars is None else
            "'ok' AS status, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, "
            f"count({chars}) AS texts, CAST(sum({chars}) AS BIGINT) AS text_chars FROM orders")
        for name, chars in kept)
    published = f"SELECT *, {_GROUP} AS grp FROM orders"
    q["ingest_republished_file"] = (
        "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, "
        "CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(0 AS BIGINT) AS third_run_files "
        f"FROM ({published}) p")
    q["bronze_schema_drift"] = (
        "SELECT o_orderstatus, count(*) AS rows, "
        "count(CASE WHEN grp = 0 THEN o_orderdate END) AS dated_rows "
        f"FROM ({published}) p GROUP BY o_orderstatus")
    q["ingest_bad_republish"] = (
        f"SELECT CASE WHEN {_GROUP} = 1 THEN o_orderstatus ELSE '?' END AS o_orderstatus, "
        "count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, false AS stopped, "
        "CAST(0 AS BIGINT) AS loaded_with_bad_only, CAST(0 AS BIGINT) AS tried_again, true AS reported "
        "FROM orders GROUP BY 1")
    q["validate_parquet_set"] = "\nUNION ALL\n".join(
        [f"SELECT 'group{i}.parquet' AS source_file, count(*) AS rows, count(*) > 0 AS valid "
         f"FROM orders WHERE {_GROUP} = {i}" for i in range(3)]
        + [f"SELECT '{n}.parquet' AS source_file, CAST(0 AS BIGINT) AS rows, false AS valid"
           for n in ("empty", "bad", "damaged", "absent")])
    base = oracle_queries()
    q["seed_airports"] = _with("SELECT * FROM airports")
    n_files = "(SELECT count(DISTINCT coalesce(CAST(nr_voo AS BIGINT) % 12, 11)) FROM bronze)"
    n_rows = "(SELECT count(*) FROM bronze)"
    n_failed = f"(SELECT count(*) FROM (\n{_DECLARED}\n) d WHERE failures > 0)"
    q["workflow_stages"] = _with("\nUNION ALL\n".join(
        f"SELECT '{stage}' AS stage, {status} AS status, CAST({files} AS BIGINT) AS files, "
        f"CAST({rows} AS BIGINT) AS rows" for stage, status, files, rows in (
            ("list_inputs", "'ok'", n_files, "NULL"), ("extract", "'ok'", n_files, "NULL"),
            ("validate", "'ok'", n_files, "NULL"), ("load_bronze", "'ok'", n_files, n_rows),
            ("silver", "'ok'", "NULL", n_rows), ("gold", "'ok'", "3", "NULL"),
            ("tests", f"CASE WHEN {n_failed} = 0 THEN 'ok' ELSE 'failures' END", "NULL", n_failed))),
        ALL_GOLD)
    types = {"dt_referencia_ts": "date", "ano": "int", "mes": "int", "dia": "int", "trimestre": "int",
             "dia_semana_num": "int", **{c: t.lower() for c, t in SILVER_MEASURE_TYPES.items()}}
    q["dq_column_catalogue"] = _with("\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{types.get(c, 'string')}' AS data_type, "
        f"{str(c not in NEVER_NULL).lower()} AS nullable, count({c}) AS non_null FROM silver"
        for i, c in enumerate(SILVER_COLUMNS, 1)))
    # the file of a row: its month as written, whether or not that is a date
    file_month = ("CASE WHEN dt_referencia[3] = '/' THEN dt_referencia[7:10] || dt_referencia[4:5] "
                  "ELSE dt_referencia[1:4] || dt_referencia[6:7] END")
    q["silver_changed_months"] = _with(f"""
SELECT ano, mes, count(*) AS rows, count(CASE WHEN f = first THEN 1 END) AS changed,
  bool_or(f = first) AS rewritten
FROM (SELECT ano, mes, {file_month} AS f, min({file_month}) OVER () AS first FROM silver) s
GROUP BY ano, mes""")
    q["catalog_layers"] = base["gold_volume_by_period"]
    q["workflow_gold_volume"] = base["gold_volume_by_period"]
    q["workflow_declared_tests"] = base["dq_declared_tests"]
    return q
