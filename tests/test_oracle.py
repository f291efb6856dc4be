"""Registered queries against their DuckDB oracle on the smallest driver tables."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem").split()
FAST = ["date_guard", "calendar_parts", "flight_status", "route_key", "airport_enrichment",
        "gold_punctuality", "gold_volume_by_period", "gold_route_ranking", "route_ranking_top10", "route_ranking_order",
        "dq_declared_tests", "dq_row_reconciliation", "dq_status_distribution",
        "dq_enrichment_coverage", "ingest_text_roundtrip", "ingest_unified_append",
        "workflow_gold_volume", "workflow_stages", "workflow_declared_tests", "dq_type_profile",
        "dq_load_reconciliation", "catalog_layers", "silver_flights", "dq_column_catalogue",
        "ingest_text_edge_cases", "ingest_republished_file", "ingest_bad_republish", "silver_changed_months", "bronze_schema_drift",
        "validate_parquet_set", "seed_airports", "consolidate_files", "parquet_profile"]


def norm(row):
    out = []
    for v in row:
        if isinstance(v, float):
            v = round(v, 6)
        if isinstance(v, dt.datetime):
            v = v.replace(tzinfo=None)
        out.append((v is None, str(v)))
    return tuple(out)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    want = sorted(norm(tuple(r[i] for i in idx)) for r in rel.fetchall())
    got = sorted(norm(tuple(r)) for r in df.collect())
    assert got == want


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert not [k for k in set(q) - set(o) if k not in entry.LLM_QUERIES]


def test_no_silver_column_is_null_everywhere(spark):
    s = entry.queries()["silver_flights"](spark, SF)
    counts = s.agg(*(F.count(c).alias(c) for c in s.columns)).first().asDict()
    assert not [c for c, n in counts.items() if n == 0]
