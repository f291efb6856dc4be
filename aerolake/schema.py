"""Column catalogue of the three layers.

All names below are fixed values: they are the documented column names of
the flight-stage ("combinada") record, the airport seed and the silver
projection, and must stay exactly as written for results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: bronze flight-stage record, in documented order (92 columns).
BRONZE_COLUMNS: tuple[str, ...] = (
    # airline
    "id_combinada", "id_empresa", "sg_empresa_icao", "sg_empresa_iata", "nm_empresa",
    "nm_pais", "ds_tipo_empresa", "ds_tipo_empresa_estrangeira",
    # flight
    "nr_voo", "nr_singular", "id_di", "cd_di", "ds_di", "ds_di_etapa", "ds_grupo_di",
    # reference date
    "dt_referencia", "nr_ano_referencia", "nr_semestre_referencia", "nm_semestre_referencia",
    "nr_trimestre_referencia", "nm_trimestre_referencia", "nr_mes_referencia",
    "nm_mes_referencia", "nr_semana_referencia", "nm_dia_semana_referencia",
    "nr_dia_referencia", "nr_ano_mes_referencia",
    # line type
    "id_tipo_linha", "cd_tipo_linha", "ds_tipo_linha", "ds_natureza_tipo_linha",
    "ds_servico_tipo_linha", "ds_natureza_etapa",
    # departure
    "hr_partida_real", "dt_partida_real", "nr_ano_partida_real", "nr_semestre_partida_real",
    "nm_semestre_partida_real", "nr_trimestre_partida_real", "nm_trimestre_partida_real",
    "nr_mes_partida_real", "nm_mes_partida_real", "nr_semana_partida_real",
    "nm_dia_semana_partida_real", "nr_dia_partida_real", "nr_ano_mes_partida_real",
    # origin
    "id_aerodromo_origem", "sg_icao_origem", "sg_iata_origem", "nm_aerodromo_origem",
    "nm_municipio_origem", "sg_uf_origem", "nm_regiao_origem", "nm_pais_origem",
    "nm_continente_origem", "nr_etapa",
    # arrival
    "hr_chegada_real", "dt_chegada_real", "nr_ano_chegada_real", "nr_semestre_chegada_real",
    "nm_semestre_chegada_real", "nr_trimestre_chegada_real", "nm_trimestre_chegada_real",
    "nr_mes_chegada_real", "nm_mes_chegada_real", "nr_semana_chegada_real",
    "nm_dia_semana_chegada_real", "nr_dia_chegada_real", "nr_ano_mes_chegada_real",
    # destination
    "id_aerodromo_destino", "sg_icao_destino", "sg_iata_destino", "nm_aerodromo_destino",
    "nm_municipio_destino", "sg_uf_destino", "nm_regiao_destino", "nm_pais_destino",
    "nm_continente_destino", "nr_escala_destino",
    # transfer
    "cd_cotran", "ds_cotran",
    # load
    "nr_passag_pagos", "nr_passag_gratis", "kg_bagagem_livre", "kg_bagagem_excesso",
    "kg_carga_paga", "kg_carga_gratis", "kg_correio",
    # origin of record
    "id_arquivo", "nm_arquivo", "nr_linha", "dt_sistema",
)

# Lineage column added on load: the source file *name*.
SOURCE_FILE = "source_file"

BRONZE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS]
    + [T.StructField(SOURCE_FILE, T.StringType(), True)]
)

# --- Fixed values: airport seed columns (all STRING, NOT NULL, first one unique).
SEED_COLUMNS: tuple[str, ...] = (
    "icao_aerodromo", "nome_aeroporto", "cidade", "estado", "uf", "regiao",
)
SEED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SEED_COLUMNS])

# Seed column -> silver column suffix, for the origin/destination roles.
SEED_ROLE_COLUMNS: tuple[tuple[str, str], ...] = (
    ("nome_aeroporto", "nome_aeroporto"),
    ("cidade", "cidade"),
    ("estado", "estado"),
    ("uf", "uf_seed"),
    ("regiao", "regiao_seed"),
)

# --- Fixed values: silver projection, in output order (70 columns).
SILVER_COLUMNS: tuple[str, ...] = (
    "id_combinada", "id_empresa", "sg_empresa_icao", "sg_empresa_iata", "nm_empresa",
    "nm_pais", "ds_tipo_empresa", "nr_voo", "nr_singular", "id_di", "cd_di", "ds_di",
    "ds_grupo_di", "id_tipo_linha", "cd_tipo_linha", "ds_tipo_linha",
    "ds_natureza_tipo_linha", "ds_servico_tipo_linha", "ds_natureza_etapa",
    "dt_referencia", "dt_referencia_ts", "ano", "mes", "dia", "trimestre",
    "dia_semana_num", "nome_mes", "nome_dia_semana",
    "hr_partida_real", "dt_partida_real", "hr_chegada_real", "dt_chegada_real",
    "sg_icao_origem", "sg_iata_origem", "nm_aerodromo_origem", "nm_municipio_origem",
    "sg_uf_origem", "nm_regiao_origem", "nm_pais_origem", "nm_continente_origem",
    "nr_etapa",
    "sg_icao_destino", "sg_iata_destino", "nm_aerodromo_destino", "nm_municipio_destino",
    "sg_uf_destino", "nm_regiao_destino", "nm_pais_destino", "nm_continente_destino",
    "nr_escala_destino",
    "nr_passag_pagos", "nr_passag_gratis", "kg_bagagem_livre", "kg_bagagem_excesso",
    "kg_carga_paga", "kg_carga_gratis", "kg_correio",
    "flag_situacao", "rota",
    "origem_nome_aeroporto", "origem_cidade", "origem_estado", "origem_uf_seed",
    "origem_regiao_seed",
    "destino_nome_aeroporto", "destino_cidade", "destino_estado", "destino_uf_seed",
    "destino_regiao_seed",
    "source_file",
)

# Silver casts for the load measures; every other carried column keeps its
# bronze STRING value. Counts are whole numbers, weights may use a decimal comma.
SILVER_MEASURE_TYPES: dict[str, str] = {
    "nr_passag_pagos": "bigint",
    "nr_passag_gratis": "bigint",
    "kg_bagagem_livre": "double",
    "kg_bagagem_excesso": "double",
    "kg_carga_paga": "double",
    "kg_carga_gratis": "double",
    "kg_correio": "double",
}

# --- Fixed values: flight status labels.
STATUS_ARRIVED = "realizado"
STATUS_IN_FLIGHT = "em_voo"
STATUS_SCHEDULED = "programado"
STATUS_VALUES: tuple[str, ...] = (STATUS_ARRIVED, STATUS_IN_FLIGHT, STATUS_SCHEDULED)

# --- Fixed values: text tokens that the pandas CSV reader turns into NULL by default
# (public pandas behaviour); bronze normalises them the same way.
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
