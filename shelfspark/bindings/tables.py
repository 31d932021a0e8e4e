"""Reading the given tables, and collecting queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, split as the session's file settings say."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Registry:
    """Queries of one module with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(fn):
            @wraps(fn)
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                # the caller's session may have been made without this package
                spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
                return fn(spark, sf_dir)

            self.queries[name] = run
            if sql is not None:
                self.oracle[name] = sql
            return fn

        return register
