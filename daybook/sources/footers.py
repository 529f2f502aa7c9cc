"""Counts, least and greatest values of stored tables out of the Parquet footers: no row is read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.tables import TableStore, subfolders
from daybook.specs import TableSpec


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one whose Parquet scans push counts, minima and maxima down to the footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def from_footers(spark: SparkSession, path: str, schema: T.StructType, *aggregates: Column) -> DataFrame:
    """Aggregates over a Parquet folder: counts, and ``min`` or ``max`` of numbers and days (not of text or timestamps)."""
    return footer_session(spark).read.schema(schema).parquet(path).agg(*aggregates)


def stored_figures(store: TableStore, spec: TableSpec, day: str | None = None) -> DataFrame:
    """One row ``rows`` and, if a day column is given, ``oldest, newest``, of a stored table."""
    ends = [F.min(day).alias("oldest"), F.max(day).alias("newest")] if day else []
    return from_footers(store.spark, store.data_path(spec), spec.stored_schema, F.count(F.lit(1)).alias("rows"), *ends)


def newest_day(store: TableStore, spec: TableSpec, day: str) -> date | None:
    """The newest day of a stored table, for ``last_n_days(..., as_of=...)``: the scan then gets it as a literal."""
    if not subfolders(store.spark, store.data_path(spec)):
        return None
    return stored_figures(store, spec, day).first()["newest"]
