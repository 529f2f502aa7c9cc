"""Constraint and quality checks. Each is one aggregate over one scan of each input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import day_of
from daybook.operators.projection import CELLS, drop_null_key, key_is_set, project, quoted
from daybook.specs import TableSpec


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or are NULL, with the number of rows and the reason."""
    columns = [quoted(k) for k in key]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    reason = F.when(~key_is_set(*key), "null key").otherwise("repeated key")
    return counted.filter((F.col("row_count") > 1) | ~key_is_set(*key)).withColumn("reason", reason)


def fk_violations(child: DataFrame, parent: DataFrame, key: Sequence[tuple[str, str]]) -> DataFrame:
    """Child keys without a parent row, with the number of child rows. NULL references are allowed.

    Both sides are reduced to their distinct keys before they meet, so hot keys shrink before the join.
    """
    child_key = [c for c, _ in key]
    references = drop_null_key(child, *child_key).groupBy(*[quoted(c) for c in child_key]).agg(
        F.count(F.lit(1)).alias("row_count"))
    known = parent.select(*[quoted(p).alias(c) for c, p in key]).distinct()
    return references.join(known, child_key, "left_anti")


def coverage(raw: DataFrame, spec: TableSpec, source: str = "path", date_header: str | None = None) -> DataFrame:
    """Per spec column, the number of workbooks that have its header, out of all workbooks that could be read.

    Works on sheet rows (``cells`` map): one flag per header and workbook, merged on the map side. The parsed date
    column counts as found where ``date_header`` is.
    """
    columns = [replace(c, source=date_header) if date_header and c.source == "date" and c.type == "date" else c
               for c in spec.columns]
    flags = [F.max(F.map_contains_key(CELLS, c.source)).alias(f"has_{i}") for i, c in enumerate(columns)]
    read = raw.filter("error IS NULL") if "error" in raw.columns else raw
    per_book = read.groupBy(quoted(source)).agg(*flags)
    totals = per_book.agg(F.count(F.lit(1)).alias("workbooks"),
                          *[F.count_if(f"has_{i}").alias(f"found_{i}") for i in range(len(columns))])
    rows = F.array(*[
        F.struct(F.lit(c.name).alias("column_name"), F.lit(c.source).alias("header"),
                 F.col(f"found_{i}").alias("found"))
        for i, c in enumerate(columns)
    ])
    return totals.select("workbooks", F.explode(rows).alias("r")).select(
        F.lit(spec.name).alias("table_name"), "r.column_name", "r.header", "r.found", "workbooks",
        (F.col("r.found") < F.col("workbooks")).alias("incomplete"))


def verify_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Per required column: is it there, how many values are set, and which share of the rows."""
    wanted = list(columns)
    there = {c: c in df.columns for c in wanted}
    counts = [(F.count(quoted(c)) if there[c] else F.lit(0).cast("bigint")).alias(f"set_{i}")
              for i, c in enumerate(wanted)]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(there[c]).alias("present"), F.col(f"set_{i}").alias("filled"))
        for i, c in enumerate(wanted)
    ])
    share = F.when(F.col("total") > 0, F.col("filled") / F.col("total"))
    return totals.select("total", F.explode(rows).alias("r")).select(
        "r.column_name", "r.present", "r.filled", "total").withColumn("filled_share", F.round(share, 6))


def date_quality(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows with a valid date, and all rows, in one pass."""
    return df.agg(F.count(quoted(date)).alias("valid_dates"), F.count(F.lit(1)).alias("total_rows"))


def row_flow(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows on their way into one table: initial, removed for a NULL key, kept, and left after dedup.

    Two stacked aggregates (per distinct row, then overall) instead of one action per count.
    """
    typed = project(raw, spec)
    per_row = typed.groupBy(*[quoted(c) for c in spec.column_names]).agg(F.count(F.lit(1)).alias("copies"))
    valid = key_is_set(*spec.key)
    return per_row.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("initial_rows"),
        F.coalesce(F.sum(F.when(valid, F.col("copies"))), F.lit(0)).alias("kept_rows"),
        F.count_if(valid).alias("deduped_rows"),
    ).select(
        F.lit(spec.name).alias("table_name"), "initial_rows", "kept_rows",
        (F.col("initial_rows") - F.col("kept_rows")).alias("removed_rows"), "deduped_rows")


def threshold_alerts(df: DataFrame, metric: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows whose metric lies below ``low`` or above ``high``."""
    value = quoted(metric)
    below = F.lit(False) if low is None else value < F.lit(low)
    above = F.lit(False) if high is None else value > F.lit(high)
    return df.filter(below | above).withColumn("alert", F.when(below, "low").otherwise("high"))


def unusual_values(series: DataFrame, key: str, metric: str, previous: int, limit: float,
                   by: Sequence[str] = ()) -> DataFrame:
    """Days whose sum of ``metric`` lies more than ``limit`` deviations off the mean of the ``previous`` days.

    ``series`` may hold any number of rows per day (and per ``by`` group): they are summed up here, so a window partition
    is bounded by the calendar.
    """
    series = series.groupBy(day_of(quoted(key)).alias(key), *[quoted(c) for c in by]).agg(F.sum(quoted(metric)).alias(metric))
    order = Window.partitionBy(*[quoted(c) for c in by] or [F.lit(1)]).orderBy(quoted(key))
    before = order.rowsBetween(-previous, -1)
    value = quoted(metric)
    mean: Column = F.avg(value).over(before)
    spread: Column = F.stddev_samp(value).over(before)
    enough = F.count(value).over(before) == previous
    return (
        series.withColumn("mean_before", mean)
        .withColumn("score", F.when(enough & (spread > 0), (value - F.col("mean_before")) / spread))
        .filter(F.abs("score") > limit)
    )
