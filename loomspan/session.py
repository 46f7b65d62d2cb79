"""Session settings that every entry point of the library shares."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter's own settings hold instead."""
    builder = SparkSession.builder.master(master).appName("loomspan")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(partitions), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
