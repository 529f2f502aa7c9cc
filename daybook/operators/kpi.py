"""KPI questions on dated tables: filters, cards, trends, combined series and period reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_of, period_start
from daybook.operators.projection import quoted
from daybook.specs import Periods

AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def date_range(df: DataFrame, key: str, low: date, high: date, layout: Periods | None = None) -> DataFrame:
    """Rows from ``low`` to ``high``, both days included.

    Plain comparisons with literals, so they reach the scan. ``layout`` is the folder layout of the table, if
    it is kept by period; other folders are then not read.
    """
    out = df.filter((quoted(key) >= F.lit(low)) & (quoted(key) < F.lit(high + timedelta(days=1))))
    return out.filter(layout.between(low, high)) if layout else out


def period_filter(df: DataFrame, key: str, year: int, quarter: int | None = None, month: int | None = None,
                  layout: Periods | None = None) -> DataFrame:
    """Rows of one year, quarter or month, written as a date range so that it can be pushed down."""
    if quarter is not None and month is not None:
        raise ValueError("give a quarter or a month, not both")
    first, months = 1, 12
    if quarter is not None:
        first, months = 3 * quarter - 2, 3
    elif month is not None:
        first, months = month, 1
    after = first + months
    end = date(year, after, 1) if after <= 12 else date(year + 1, after - 12, 1)
    return date_range(df, key, date(year, first, 1), end - timedelta(days=1), layout)


def last_n_days(df: DataFrame, key: str, days: int = 30, as_of: date | None = None,
                layout: Periods | None = None) -> DataFrame:
    """The ``days`` days up to ``as_of`` (the newest day in the data if not given).

    The newest day is one scalar, computed once and then used like a literal in the scan. With a ``layout``
    it is looked up in the newest folder only.
    """
    if as_of is not None:
        return date_range(df, key, as_of - timedelta(days=days - 1), as_of, layout)
    first = F.date_sub(F.max(day_of(quoted(key))), days - 1)
    if layout is None:
        return df.filter(quoted(key) >= df.agg(first.alias("first")).scalar())
    folder = quoted(layout.column)
    newest = df.filter(folder == df.agg(F.max(folder).alias("newest")).scalar())
    return df.filter((quoted(key) >= newest.agg(first.alias("first")).scalar())
                     & (folder >= newest.agg(period_start(first, layout.grain).alias("first")).scalar()))


def _aggregate(how: str, column: str) -> Column:
    if how not in AGGREGATES:
        raise ValueError(f"unknown aggregate {how!r}, use one of {sorted(AGGREGATES)}")
    return AGGREGATES[how](quoted(column))


def kpi_cards(df: DataFrame, cards: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row, one column per card: ``{name: (aggregate, column)}``."""
    return df.agg(*[_aggregate(how, column).alias(name) for name, (how, column) in cards.items()])


def daily_series(df: DataFrame, key: str, measures: Mapping[str, tuple[str, str]], day: str = "day") -> DataFrame:
    """One row per day with the given measures, unordered."""
    return df.groupBy(day_of(quoted(key)).alias(day)).agg(
        *[_aggregate(how, column).alias(name) for name, (how, column) in measures.items()])


def daily_trend(df: DataFrame, key: str, measure: str, name: str | None = None, day: str = "day") -> DataFrame:
    """Sum of one measure per day, in day order."""
    return daily_series(df, key, {name or measure: ("sum", measure)}, day).orderBy(day)


def dual_series(df: DataFrame, key: str, first: str, second: str, day: str = "day") -> DataFrame:
    """Sums of two measures per day (bars and line), in day order."""
    return daily_series(df, key, {first: ("sum", first), second: ("sum", second)}, day).orderBy(day)


def trend_line(series: DataFrame, day: str, measure: str) -> DataFrame:
    """Least-squares line through a daily series: slope per day, intercept and fitted value per row.

    The line comes in as one scalar. It reads the same series, so give it one without an order: Spark then computes the
    exchange below both once.
    """
    x = F.datediff(quoted(day), F.lit(date(1970, 1, 1))).cast("double")
    y = quoted(measure).cast("double")
    line = series.agg(F.struct(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")).alias("line"))
    fitted = series.withColumn("line", line.scalar())
    return fitted.select(*[quoted(c) for c in series.columns], "line.slope", "line.intercept").withColumn(
        "fitted", F.col("intercept") + F.col("slope") * x)


def combine(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Two datasets side by side on their date. Spark picks the join by size."""
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join {how!r}")
    return left.join(right, key, how)


def clustered_series(left: DataFrame, left_key: str, left_measures: Mapping[str, tuple[str, str]],
                     right: DataFrame, right_key: str, right_measures: Mapping[str, tuple[str, str]],
                     how: str = "inner", day: str = "day") -> DataFrame:
    """Daily measures of two tables side by side. Each is summed up first, so no row is counted twice."""
    return combine(daily_series(left, left_key, left_measures, day),
                   daily_series(right, right_key, right_measures, day), day, how).orderBy(day)


def period_summary(df: DataFrame, key: str, grain: str, measures: Mapping[str, tuple[str, str]],
                   by: Sequence[str] = ()) -> DataFrame:
    """Weekly, monthly, quarterly or yearly report: one row per period."""
    groups = [period_start(quoted(key), grain).alias("period"), *[quoted(c) for c in by]]
    return df.groupBy(*groups).agg(
        *[_aggregate(how, column).alias(name) for name, (how, column) in measures.items()])


def period_summaries(df: DataFrame, key: str, grains: Sequence[str], measures: Mapping[str, tuple[str, str]],
                     by: Sequence[str] = ()) -> DataFrame:
    """Reports of several grains in one frame (``grain, period, ...``): summed up per day once, then rolled up.

    Means are carried as sum and count.
    """
    rest = [quoted(c) for c in by]
    parts = [_aggregate(how, column).alias(f"{name}_{how}") for name, (given, column) in measures.items()
             for how in (("sum", "count") if given == "avg" else (given,))]
    daily = df.groupBy(day_of(quoted(key)).alias("day"), *rest).agg(*parts)
    periods = F.explode(F.array(*[
        F.struct(F.lit(grain).alias("grain"), period_start(F.col("day"), grain).alias("period")) for grain in grains]))
    again = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    rolled = [(F.sum(f"{name}_sum") / F.sum(f"{name}_count") if how == "avg" else again[how](f"{name}_{how}")).alias(name)
              for name, (how, _) in measures.items()]
    return daily.withColumn("at", periods).groupBy("at.grain", "at.period", *rest).agg(*rolled)
