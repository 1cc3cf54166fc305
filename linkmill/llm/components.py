"""Connected components of undirected edges, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.plans.lineage import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of ``edges(a, b)``.

    Each round every node takes the smallest label among its own and its
    neighbours', then the label of that label, so paths halve as labels move.
    Labels are written after each round; the last round changes none.
    Self-loops, repeated edges and no edges at all are fine.
    """
    both = stored(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(edges.select("b", "a"))
        .distinct(),
        "edges",
    )
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other")
        low = near.groupBy("node").agg(F.min("component").alias("near"))
        moved = labels.join(low, "node").select(
            "node",
            F.col("component").alias("was"),
            F.least("component", "near").alias("to"),
        )
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("far"))
        new = stored(
            moved.join(jump, "to").select("node", "was", F.least("to", "far").alias("component")),
            "labels",
        )
        labels = new.select("node", "component")
        if new.where("was != component").isEmpty():
            return labels
