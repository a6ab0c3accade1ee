"""A query is a function (spark, sf_dir) -> DataFrame with the DuckDB SQL of the same rows, where SQL can express it."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Rows of a task whose work on each row is long.
ROWS_A_TASK = 10_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables by name: t.part is part.parquet of the folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """A table with its rows dealt out to as many tasks as their number asks for, where the work on a row is long: else a row group of a file, which may hold a million rows, is one task."""
        table = getattr(self, name)
        tasks = max(self.spark.sparkContext.defaultParallelism, math.ceil(table.count() / ROWS_A_TASK))
        return table.repartition(tasks)


def query(name: str, sql: str | None = None):
    """Registers a function of Tables under a name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return register
