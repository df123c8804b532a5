"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for nodes in links.

    Each round takes the smallest label of all neighbours, then the label of that
    label, so the rounds grow with the logarithm of the longest path.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    labels = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label", F.lit(False).alias("own"))
        near = near.union(labels.select("node", "label", F.lit(True)))
        lower = near.groupBy("node").agg(F.max(F.when(F.col("own"), F.col("label"))).alias("was"), F.min("label").alias("label"))
        # A label is a node, so its own label is at most as large.
        over = lower.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = lower.join(over, "label").select("node", "was", F.least("label", "far").alias("label"))
        jumped = written(jumped, "labels")
        changed = not jumped.where("label <> was").isEmpty()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
