"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import BROADCAST_KEYS, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the least node of its component.

    Each round takes the least label among a node and its neighbours, and from the second
    round on the label of that label, so rounds grow slowly with the longest chain. Few
    labels are broadcast; else a node with many links meets its label in a join of two
    exchanged tables, so it is split at run time. Minima are taken map-side first.
    """
    both = materialise(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))),
        "links")
    labels = materialise(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("label")), "labels")
    few = labels.count() <= BROADCAST_KEYS  # rounds keep the nodes
    at_hand = F.broadcast if few else (lambda df: df)
    # a node is its own neighbour too, so that its label meets the others' in one aggregate
    near = both.unionByName(labels.select("node", F.col("node").alias("other")))
    rounds = 0
    while True:
        step = materialise(
            near.join(at_hand(labels.select(F.col("node").alias("other"), "label")), "other")
            .groupBy("node").agg(F.min("label").alias("label"),
                                 F.max(F.when(F.col("node") == F.col("other"), F.col("label")))
                                 .alias("old")), "labels", few)
        if not step.where("old != label").limit(1).count():
            return step.select("node", "label")
        labels, rounds = step.select("node", "label"), rounds + 1
        if rounds > 1:  # short chains end before labels of labels pay
            root = labels.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = materialise(labels.join(at_hand(root), "label")
                                 .select("node", F.col("root").alias("label")), "labels", few)
