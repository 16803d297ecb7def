"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, each: int = 20_000) -> DataFrame:
    """``rows`` over tasks of about ``each`` rows, at least one a core: for steps that take far longer than reading.

    Small tables are a few splits of one file, however long their rows take.
    """
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // each)))


def query(sql: str | None = None):
    """Register a query of (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
