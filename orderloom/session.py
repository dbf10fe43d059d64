"""Session settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or plan quality; sizes are left to the cluster.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Tables are split by a few values; writers side by side need no sort for that.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # Plans are built from many column calls; none needs the line it was written on.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(name: str = "orderloom", cores: str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**JOB_CONF, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
