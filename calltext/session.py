"""Spark session settings the package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps call times comparable with the source tables. Adaptive execution sizes the shuffles,
# splits skewed join partitions and turns a join into a broadcast once a side is known to be small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Probes and tokens multiply rows after the shuffle, so small shuffles keep more tasks too.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # CSV exports in Mac-Roman need a charset outside Spark's short default list.
    "spark.sql.legacy.javaCharsets": "true",
}


def get_session(app_name: str = "calltext", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. On a cluster leave ``master`` to spark-submit and give
    ``spark.checkpoint.dir`` a folder that every executor sees."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
