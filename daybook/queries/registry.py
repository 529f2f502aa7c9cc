"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def query(sql: str, name: str | None = None):
    """Register a function ``(spark, folder)`` under its own or another name, with the SQL for the same rows."""
    def register(function):
        QUERIES[name or function.__name__] = function
        SQL[name or function.__name__] = sql
        return function
    return register
