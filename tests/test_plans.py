"""Plan shape: what must (not) be in the physical plans at any scale."""

import io
from contextlib import redirect_stdout

from aerolake.plans import queries as Q
from aerolake.sources.adapter import flights_from_tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_silver_is_narrow_after_the_adapter(spark):
    p = plan(Q.silver(spark, SF))
    assert p.count("BroadcastHashJoin") >= 2          # origin and destination airports
    assert "Exchange SinglePartition" not in p
    assert "BroadcastExchange" in p
    # the fact side is never the broadcast side
    scan_of_lineitem_broadcast = "lineitem.parquet" in p.split("BroadcastExchange")[-1][:200]
    assert not scan_of_lineitem_broadcast


def test_scans_are_pruned_and_filtered(spark):
    p = plan(flights_from_tables(spark, SF).select("sg_icao_origem"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint" in p
    assert "l_extendedprice" not in p and "l_discount" not in p
    assert "PushedFilters: [IsNotNull(l_orderkey)" in p


def test_ranking_has_no_single_partition_over_routes(spark):
    p = plan(Q.q_gold_route_ranking(spark, SF))
    # the only global window is over the histogram of distinct in-flight counts
    assert p.count("Window") == 1 or "Window (" in p
    assert "BroadcastHashJoin" in p


def test_aggregates_are_partial_then_final(spark):
    p = plan(Q.q_gold_punctuality(spark, SF))
    assert "partial_count" in p


def test_size_check_fallback_gives_same_rows(spark):
    """Above the size cap the adapter joins shuffle (sort-merge) with identical results."""
    from pyspark.sql import functions as F

    small = flights_from_tables(spark, SF)
    big = flights_from_tables(spark, SF, max_broadcast_bytes=0)
    p_small, p_big = plan(small), plan(big)
    assert "SortMergeJoin" not in p_small
    assert p_big.count("SortMergeJoin") == 6     # 3 joins; formatted plans name each node twice
    cols = ["id_combinada", "sg_empresa_icao", "dt_referencia", "sg_icao_origem", "sg_icao_destino"]
    h = lambda df: df.select(F.sum(F.pmod(F.xxhash64(*cols), F.lit(1000003))).alias("h"),
                             F.count("*").alias("n")).first()
    assert h(small) == h(big)


def test_ranking_aggregates_routes_once(spark):
    """Both branches of the rank share one route aggregate (the shuffle is reused)."""
    df = Q.q_gold_route_ranking(spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_silver_from_bronze_has_no_shuffle(spark, scratch):
    from aerolake.operators.silver import build_silver
    from aerolake.sources.seed import load_airport_seed
    from tests.fixtures import f1_bronze

    f1_bronze(spark).write.parquet(f"{scratch}/bronze")
    p = plan(build_silver(spark.read.parquet(f"{scratch}/bronze"), load_airport_seed(spark)))
    assert "Exchange hashpartitioning" not in p and "Exchange SinglePartition" not in p
    assert p.count("BroadcastHashJoin") >= 2


def test_volume_view_prunes_partitions_and_columns(spark, scratch):
    from aerolake.sources import catalog
    from aerolake.sources.seed import load_airport_seed
    from tests.fixtures import f1_bronze

    dbs = catalog.create_layers(spark, scratch, prefix="pp_")
    table = catalog.materialise_silver_from_bronze(f1_bronze(spark), load_airport_seed(spark),
                                                   dbs["silver"], f"{scratch}/silver")
    views = catalog.create_gold_views(spark, dbs["gold"], table)
    p = plan(spark.table(views[1]))
    assert "PartitionFilters: [isnotnull(ano" in p
    read_schema = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert "origem_cidade" not in read_schema and "dt_referencia" not in read_schema
