"""Connected components of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that links (a, b) reach, for every linked node.

    Every round takes the smallest label among the neighbours and then the label of the
    label, so the number of rounds grows with the logarithm of the longest path. Each is
    written to the shared folder; only the number of changed labels reaches the driver.
    """
    pairs = links.select("a", "b")
    both = durable(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = durable(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label"))
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("seen"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "seen").alias("label")
        )
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = lower.join(ahead, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")
        )
        stored = durable(jumped)
        labels = stored.select("node", "label")
        if stored.filter("old != label").isEmpty():
            return labels
