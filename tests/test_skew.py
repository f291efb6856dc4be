"""Hot keys: one order key holds half of the fact rows."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from aerolake.operators import gold
from aerolake.operators.joins import join_with_checked_side
from aerolake.sources.adapter import read_table, table_path

SF = "/root/testdata/sf0.001"

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def final_plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_order_key_join_is_split_and_whole(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        items = read_table(spark, SF, "lineitem").select("l_orderkey", "l_linenumber")
        hot_key = items.agg(F.min("l_orderkey")).first()[0]
        # the hot copy gives one order key as many rows as all others together
        hot = items.select(F.lit(hot_key).alias("l_orderkey"), "l_linenumber")
        fact = items.unionByName(hot)
        orders = read_table(spark, SF, "orders").select("o_orderkey", "o_custkey")
        joined = join_with_checked_side(fact, orders, F.col("l_orderkey") == F.col("o_orderkey"),
                                        table_path(SF, "orders"), max_bytes=0)
        n = joined.count()
        assert n == 2 * items.count()                       # nothing dropped or capped
        grouped = joined.groupBy("o_custkey").count()
        grouped.collect()
        joined.collect()
        assert "SortMergeJoin(skew=true)" in final_plan(joined)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_route_aggregates_exactly(spark):
    """A route with a third of all flights: partial aggregation keeps counts exact."""
    base = spark.range(3000).select(
        F.concat(F.lit("R"), (F.col("id") % 50).cast("string")).alias("rota"),
        F.when(F.col("id") % 3 == 0, "em_voo").otherwise("realizado").alias("flag_situacao"))
    hot = spark.range(1500).select(F.lit("HOT").alias("rota"), F.lit("em_voo").alias("flag_situacao"))
    nulls = [F.lit(None).cast("string").alias(c) for c in gold.RANKING_KEYS[1:]]
    silver = base.unionByName(hot).select("rota", *nulls, "flag_situacao")
    r = {x.rota: x for x in gold.gold_route_ranking(spark, silver).collect()}
    assert r["HOT"].total_voos == 1500 and r["HOT"].ranking_volume_em_voo == 1
    assert sum(x.total_voos for x in r.values()) == 4500
