"""Session settings that suit the operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Window frames cost far more per byte than scans, so small shuffle partitions stay worth a
# task of their own. A window buffers one symbol: a century of daily bars stays in its
# in-memory buffer at this threshold. Skewed joins and rebalanced writes rely on adaptive execution.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.windowExec.buffer.in.memory.threshold": "32768",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
