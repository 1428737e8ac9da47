"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.sources.durable import durable


def connected(links: DataFrame) -> DataFrame:
    """``(node, component)`` for each end of the links ``(a, b)``; the component is its smallest node.

    Each round a node takes the smallest label among its neighbours', then
    that label's own label, so long chains close in a logarithmic number of
    rounds. Labels are summed per task before they meet, so a node with very
    many links is no burden; every round is written to the shared folder.
    """
    both = durable(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "links")
    labels = durable(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component")),
        "labels",
    )
    while True:
        around = (
            both.join(labels, both.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("around"))
            .join(labels, "node")
            .select("node", F.col("component").alias("old"), F.least("component", "around").alias("near"))
        )
        jump = labels.select(F.col("node").alias("near"), F.col("component").alias("far"))
        following = durable(
            around.join(jump, "near").select("node", F.least("near", "far").alias("component"), (F.col("old") != F.least("near", "far")).alias("moved")),
            "labels",
        )
        moved = following.where("moved").limit(1).count()
        labels = following.drop("moved")
        if not moved:
            return labels
