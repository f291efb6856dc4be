"""P4-P20 and traps T1-T6, T9 on tiny frames."""

import duckdb

from aerolake.functions import (
    calendar_parts,
    flight_status,
    guarded_date,
    normalise_na,
    pct,
    route_key,
)


def test_date_guard_traps(spark):
    rows = [("05/01/2025",), ("31/02/2025",), ("05/01/2025\n",), ("2025-01-05",), (None,),
            ("29/02/2024",), ("5/1/2025",), ("00/00/0000",)]
    df = spark.createDataFrame(rows, "t string").select("t", guarded_date("t").alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert str(got["05/01/2025"]) == "2025-01-05"
    assert got["31/02/2025"] is None            # T2: passes the pattern, not a date
    assert got["05/01/2025\n"] is None          # T1: \z, not $
    assert got["2025-01-05"] is None
    assert got[None] is None
    assert str(got["29/02/2024"]) == "2024-02-29"
    assert got["5/1/2025"] is None
    assert got["00/00/0000"] is None


def test_calendar_parts_postgres_semantics(spark):
    df = spark.createDataFrame([("05/01/2025",), ("29/02/2024",), ("01/09/2021",), (None,)], "t string")
    df = df.withColumn("d", guarded_date("t")).withColumns(calendar_parts("d"))
    r = {x.t: x for x in df.collect()}
    sunday = r["05/01/2025"]
    assert (sunday.ano, sunday.mes, sunday.dia, sunday.trimestre, sunday.dia_semana_num) == (2025, 1, 5, 1, 0)
    assert sunday.nome_mes == "January  " and sunday.nome_dia_semana == "Sunday   "   # T4
    assert r["29/02/2024"].dia_semana_num == 4 and r["29/02/2024"].nome_dia_semana == "Thursday "
    assert r["01/09/2021"].nome_mes == "September" and r["01/09/2021"].nome_dia_semana == "Wednesday"
    assert r[None].ano is None and r[None].nome_mes is None
    types = dict(df.dtypes)
    assert all(types[c] == "int" for c in ("ano", "mes", "dia", "trimestre", "dia_semana_num"))


def test_dow_matches_duckdb_for_a_year(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS d")
    got = sorted((str(r.d), r.dia_semana_num) for r in
                 days.select("d", calendar_parts("d")["dia_semana_num"].alias("dia_semana_num")).collect())
    want = sorted((str(d), w) for d, w in duckdb.sql(
        "SELECT d::DATE, dayofweek(d) FROM range(DATE '2024-01-01', DATE '2025-01-01', INTERVAL 1 DAY) t(d)"
    ).fetchall())
    assert got == want


def test_flight_status_and_route(spark):
    rows = [("a", "d", "SBGR", "SBSP"), (None, "d", "SBGR", None), (None, None, None, "SBRJ"),
            ("a", None, "X", "Y")]
    df = spark.createDataFrame(rows, "arr string, dep string, o string, d string")
    out = df.select(flight_status("arr", "dep").alias("s"), route_key("o", "d").alias("r")).collect()
    assert [r.s for r in out] == ["realizado", "em_voo", "programado", "realizado"]
    assert [r.r for r in out] == ["SBGR -> SBSP", None, None, "X -> Y"]   # T5: NULL propagates


def test_pct_rounding_matches_duckdb(spark):
    pairs = [(a, b) for b in range(0, 121) for a in range(0, b + 1)] + [(-3, 8), (5, 0), (None, 3)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = {(r.a, r.b): r.p for r in df.select("a", "b", pct("a", "b").alias("p")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(a BIGINT, b BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    want = {(a, b): p for a, b, p in con.execute(
        "SELECT a, b, round(CAST(100.0 AS DOUBLE) * a / nullif(b, 0), 1) FROM t").fetchall()}
    assert got == want
    assert got[(5, 0)] is None and got[(1, 3)] == 33.3 and got[(2, 3)] == 66.7


def test_na_tokens(spark):
    vals = ["NA", "NULL", "", "nan", "N/A", "x", "NaN", None, " NA"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = [r.n for r in df.select(normalise_na("v").alias("n")).collect()]
    assert out == [None, None, None, None, None, "x", None, None, " NA"]
