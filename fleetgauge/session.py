"""Session settings the jobs rely on; a cluster sets its own sizes on top."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins and aggregations are re-planned from measured sizes: small sides are broadcast, skewed
    # partitions split and small ones merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffle partitions are merged or split towards this size, which fits executor memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Recording the Python line of every expression doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Times are zone-free; a fixed zone keeps text formatting the same on every machine.
    "spark.sql.session.timeZone": "UTC",
}


def build(app_name: str, **overrides: str) -> SparkSession:
    """A session with these settings; the master and all sizes come from the deployment."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
