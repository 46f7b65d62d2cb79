"""Mention counts that run on a stream of sentences. The counts are plain sums, so a stream and a batch agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions.text import fold_alias


def alias_counts(sentences: DataFrame) -> DataFrame:
    """(alias, n) over all sentences so far; use with the complete or update output mode."""
    return sentences.select(F.explode("aliases").alias("a")).where("a is not null").groupBy(fold_alias("a").alias("alias")).agg(F.count("*").alias("n"))


def windowed_counts(sentences: DataFrame, time: str = "seen_at", every: str = "30 days", late: str = "7 days") -> DataFrame:
    """(start, source, n): sentences per window and source; rows later than the watermark don't count."""
    timed = sentences.where(F.col(time).isNotNull()).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, every).alias("w"), "source").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "source", "n")


def run_to_end(df: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """All rows a stream has now, as a table in memory: for tests and small reports."""
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
