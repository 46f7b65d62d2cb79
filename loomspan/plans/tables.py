"""Reading the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Tasks to plan for: the session's shuffle partitions."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
