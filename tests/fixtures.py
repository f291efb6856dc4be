"""Golden fixtures: the 12 flight rows (F1) and the ranking threshold rows."""

from aerolake.schema import BRONZE_SCHEMA

SET = "01/01/2025"

# (airline, origin, destination, dt_referencia, departure, arrival)
F1_ROWS = [
    ("GLO", "SBGR", "SBSP", "05/01/2025", SET, SET),
    ("GLO", "SBGR", "SBSP", "05/01/2025", SET, None),
    ("TAM", "SBGR", "SBSP", "05/02/2025", None, None),
    ("TAM", "SBGR", "SBSP", "05/04/2025", None, SET),
    ("TAM", "ZZZZ", "SBRJ", "05/01/2025", SET, SET),
    ("TAM", None, "SBRJ", "05/01/2025", SET, SET),
    ("AZU", "SBRJ", "SBBR", "2025-01-05", SET, SET),
    ("AZU", "SBRJ", "SBBR", "31/02/2025", SET, SET),
    ("AZU", "SBRJ", "SBBR", "05/01/2025\n", SET, SET),
    ("AZU", "SBRJ", "SBBR", None, None, None),
    (None, "SBCT", "SBPA", "31/12/2024", SET, None),
    ("AZU", "SBCT", "SBPA", "29/02/2024", SET, SET),
]


def f1_bronze(spark):
    names = BRONZE_SCHEMA.fieldNames()
    rows = []
    for i, (airline, o, d, ref, dep, arr) in enumerate(F1_ROWS, start=1):
        row = dict.fromkeys(names)
        row.update(id_combinada=str(i), sg_empresa_icao=airline, nr_voo=str(100 + i),
                   sg_icao_origem=o, sg_icao_destino=d, dt_referencia=ref,
                   dt_partida_real=dep, dt_chegada_real=arr, source_file="f1.parquet")
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def f6_silver(spark):
    """Routes with 29, 30, 31 qualifying flights, and ties on flights in the air."""
    rows = []

    def route(name, arrived, in_air, scheduled=0):
        for status, n in (("realizado", arrived), ("em_voo", in_air), ("programado", scheduled)):
            rows.extend([(name, "O", None, "U", "D", None, "V", status)] * n)

    route("A -> B", 19, 10, scheduled=5)   # 29 qualifying (scheduled do not count)
    route("C -> D", 20, 10)                # 30: tied for first
    route("E -> F", 21, 10)                # 31: tied for first
    route("G -> H", 25, 8)                 # 33: third
    return spark.createDataFrame(
        rows, "rota string, sg_icao_origem string, origem_cidade string, sg_uf_origem string, "
              "sg_icao_destino string, destino_cidade string, sg_uf_destino string, "
              "flag_situacao string")
