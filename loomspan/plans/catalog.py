"""A list of queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspan.plans.tables import table


class Tables:
    """t.sentences is the table of that name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


class Catalog:
    def __init__(self) -> None:
        self.found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register f(tables) under its name, with its SQL."""

        def keep(f):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return f(Tables(spark, sf_dir))

            run.__name__, run.__doc__ = f.__name__, f.__doc__
            self.found[f.__name__] = run
            if sql:
                self.sql[f.__name__] = sql
            return f

        return keep
