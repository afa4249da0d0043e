"""Query registry: name -> Spark callable, name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskloom.sources.files import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with its oracle SQL if it has one."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLE[key] = sql
        return function

    return register


# Tables with long texts: regex and token work dominates, so it should use all cores.
TEXT_TABLES = {"documents", "pages"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(rows) if name in TEXT_TABLES else rows
