"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trendloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then that label's own label, so the rounds grow with the
    logarithm of the longest chain. Labels are staged between rounds; only the number of changes reaches the driver.
    """
    edges = stage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("of"), F.col("component").alias("far"))
        new = stage(
            lower.join(jump, F.col("low") == F.col("of"), "left").select(
                "node", F.least("low", F.coalesce("far", "low")).alias("new"), "component"
            )
        )
        changed = new.filter("new < component").limit(1).count()
        labels = new.select("node", F.col("new").alias("component"))
        if not changed:
            return labels
