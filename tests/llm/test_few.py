"""Few labels and bucket rows stay where they are: one exchange a round, tasks by cores."""

import pytest
from pyspark.sql import functions as F

from aerolake.llm import common, components


def _edges(spark):
    rows = [(b"b", b"a"), (b"c", b"b"), (b"d", b"c"), (b"e", b"d"), (b"y", b"x"), (b"z", b"x")]
    return spark.createDataFrame(rows, "a binary, b binary")


@pytest.mark.parametrize("bound", [1 << 16, 0])
def test_labels_of_few_and_many_nodes(spark, monkeypatch, bound):
    monkeypatch.setattr(components, "BROADCAST_KEYS", bound)
    got = {(bytes(r.node), bytes(r.label)) for r in
           components.connected_components(_edges(spark)).collect()}
    assert got == {(n, b"a") for n in (b"a", b"b", b"c", b"d", b"e")} | {
        (n, b"x") for n in (b"x", b"y", b"z")}


def test_few_rows_are_written_by_few_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(2000).groupBy((F.col("id") % 500).alias("k")).count()
        kept = common.materialise(rows, "few-test", few=True)
        assert kept.count() == 500
        assert len(kept.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
