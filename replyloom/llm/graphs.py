"""Connected components of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyloom.session import cut_counting


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    Each round takes the smallest label among a node's neighbours, then the label of that label, so that the
    number of rounds grows with the logarithm of a chain's length. Labels are one row per node, which lets
    Spark split the join side of a node with very many links. Without links the result is empty.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = both.groupBy("a").agg(F.least("a", F.min("b")).alias("label"))
    labels, changed = cut_counting(nodes.select(F.col("a").alias("node"), "label"), F.lit(True))
    while changed:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = lower.join(target, "label").select("node", "old", F.least("label", "next").alias("label"))
        labels, changed = cut_counting(moved, F.col("label") != F.col("old"))
        labels = labels.select("node", "label")
    return labels.withColumnRenamed("label", "component")
