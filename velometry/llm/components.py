"""Connected components by label propagation, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.llm.common import null_safe_join, stored


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the ``a, b`` edges: its smallest reachable node.

    Each round every node takes the smallest label among its neighbours, and then
    the label of its label, so that labels travel twice as far each time.  A round is
    stored; adaptive execution spreads a hub with many edges.
    """
    both = stored(edges.union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        .select("node", F.least("node", "label").alias("label"))
    )
    while True:
        near = null_safe_join(both, labels.select(F.col("node").alias("b"), "label"), ["b"])
        least = near.groupBy("a").agg(F.min("label").alias("near"))
        closer = labels.join(least, labels.node == least.a).select(
            "node", F.least("label", "near").alias("next"), F.col("label").alias("before")
        )
        targets = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        after = stored(
            null_safe_join(closer, targets, ["next"]).select(
                "node", F.least("next", "beyond").alias("label"), "before"
            )
        )
        moved = after.filter("label <> before").limit(1).count()
        labels = after.select("node", "label")
        if not moved:
            return labels.withColumnRenamed("label", "component")
