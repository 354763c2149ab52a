"""Session settings used by the tests and the benchmark; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where the plan above it then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # No Python call sites in error messages: recording them doubles the time to build a large plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # One pass over the messages per Arrow batch of this many rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def session(master: str = "local[8]", app: str = "sixfold", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators expect."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
