"""KPI questions: filters, cards, trends, combined series and period reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import date_parts
from daybook.operators.kpi import (
    clustered_series, combine, daily_series, daily_trend, date_range, dual_series, kpi_cards, last_n_days, period_filter, trend_line)
from daybook.operators.kpi import period_summaries as grain_summaries
from daybook.operators.projection import drop_null_key, project, to_raw
from daybook.operators.upsert import first_row
from daybook.plans.sheets import dirty_date_text
from daybook.queries.registry import load, query
from daybook.specs import Buckets, ColumnSpec, TableSpec

VOLUMES = TableSpec("volumes", (
    ColumnSpec("order_no", "bigint", "Order\nNo"),
    ColumnSpec("line_no", "int", "Zeile"),
    ColumnSpec("part_no", "bigint", "Teil"),
    ColumnSpec("ship_date", "date", "Datum"),
    ColumnSpec("quantity", "int", "Menge"),
), ("ship_date",), Buckets(("ship_date",), 16))


@query("""
    SELECT day, CAST(sum(quantity) AS BIGINT) AS quantity FROM (
        SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day,
               CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem WHERE l_orderkey % 4 <> 3)
    GROUP BY day
""")
def volume_per_day(spark, folder):
    """Volume per day out of an untyped sheet: land, map, cast, drop undated rows and copies, add up."""
    lines = load(spark, folder, "lineitem")
    sheet = to_raw(lines.select(
        F.col("l_orderkey").alias("Order\nNo"), F.col("l_linenumber").alias("Zeile"), F.col("l_partkey").alias("Teil"),
        dirty_date_text(F.col("l_orderkey"), F.col("l_shipdate")).alias("Datum"),
        F.concat(F.col("l_quantity").cast("int"), F.lit(".0")).alias("Menge")))
    typed = drop_null_key(project(sheet, VOLUMES), "ship_date").distinct()
    return daily_trend(typed, "ship_date", "quantity")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_quantity FROM lineitem
    WHERE l_shipdate BETWEEN DATE'1996-02-10' AND DATE'1997-03-31'
""", name="date_range")
def date_range_lines(spark, folder):
    return date_range(load(spark, folder, "lineitem"), "l_shipdate", date(1996, 2, 10), date(1997, 3, 31)).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("ship_date"), "l_quantity")


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, 'quarter' AS filter FROM orders
    WHERE year(o_orderdate) = 1998 AND quarter(o_orderdate) = 4
    UNION ALL
    SELECT o_orderkey, CAST(o_orderdate AS DATE), 'month' FROM orders
    WHERE year(o_orderdate) = 1999 AND month(o_orderdate) = 2
""", name="period_filter")
def period_filter_orders(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate"))
    quarter = period_filter(orders, "o_orderdate", 1998, quarter=4).withColumn("filter", F.lit("quarter"))
    month = period_filter(orders, "o_orderdate", 1999, month=2).withColumn("filter", F.lit("month"))
    return quarter.unionByName(month).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "filter")


@query("""
    SELECT event_id, CAST(ts AS DATE) AS day, event_type, value FROM events
    WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 7
""", name="last_7_days")
def last_7_days_events(spark, folder):
    return last_n_days(load(spark, folder, "events"), "ts", 7).select(
        "event_id", F.col("ts").cast("date").alias("day"), "event_type", "value")


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
    WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - 30
""", name="last_30_days")
def last_30_days_orders(spark, folder):
    return last_n_days(load(spark, folder, "orders"), "o_orderdate", 30).select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice")


SERIES_SQL = """
    WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue
               FROM orders GROUP BY 1),
         l AS (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
    SELECT day, orders, revenue, quantity FROM o {join} JOIN l USING (day)
"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(SERIES_SQL.format(join=""))
def combine_series(spark, folder):
    orders = daily_series(load(spark, folder, "orders"), "o_orderdate",
                          {"orders": ("count", "o_orderkey"), "revenue": ("sum", "o_totalprice")})
    lines = daily_series(load(spark, folder, "lineitem"), "l_shipdate", {"quantity": ("sum", "l_quantity")})
    return rounded(combine(orders, lines, "day"), "revenue")


@query(SERIES_SQL.format(join="FULL"), name="clustered_series")
def clustered_daily_series(spark, folder):
    return rounded(clustered_series(
        load(spark, folder, "orders"), "o_orderdate",
        {"orders": ("count", "o_orderkey"), "revenue": ("sum", "o_totalprice")},
        load(spark, folder, "lineitem"), "l_shipdate", {"quantity": ("sum", "l_quantity")}, how="full"), "revenue")


@query("""
    SELECT round(sum(l_extendedprice), 2) AS total_price, round(avg(l_discount), 6) AS average_discount,
           round(sum(l_quantity), 2) AS total_quantity FROM lineitem
""", name="kpi_cards")
def kpi_card_values(spark, folder):
    cards = kpi_cards(load(spark, folder, "lineitem"), {
        "total_price": ("sum", "l_extendedprice"), "average_discount": ("avg", "l_discount"),
        "total_quantity": ("sum", "l_quantity")})
    return rounded(cards, "total_price", "total_quantity").withColumn("average_discount",
                                                                      F.round("average_discount", 6))


@query("""
    SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1
""", name="daily_trend")
def daily_trend_lines(spark, folder):
    return daily_trend(load(spark, folder, "lineitem"), "l_shipdate", "l_quantity", "quantity")


@query("""
    WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1),
         f AS (SELECT regr_slope(orders, day - DATE'1970-01-01') AS slope,
                      regr_intercept(orders, day - DATE'1970-01-01') AS intercept FROM s)
    SELECT day, orders, round(slope, 8) AS slope, round(intercept, 6) AS intercept,
           round(intercept + slope * (day - DATE'1970-01-01'), 6) AS fitted FROM s, f
""", name="trend_line")
def trend_line_orders(spark, folder):
    series = daily_series(load(spark, folder, "orders"), "o_orderdate", {"orders": ("count", "o_orderkey")})
    return trend_line(series, "day", "orders").withColumns({
        "slope": F.round("slope", 8), "intercept": F.round("intercept", 6), "fitted": F.round("fitted", 6)})


@query("""
    SELECT CAST(ts AS DATE) AS day, round(sum(value), 2) AS value, CAST(sum(user_id) AS BIGINT) AS user_id
    FROM events GROUP BY 1
""", name="dual_series")
def dual_series_events(spark, folder):
    return rounded(dual_series(load(spark, folder, "events"), "ts", "value", "user_id"), "value")


@query("".join(f"""
    {'UNION ALL' if i else ''}
    SELECT '{grain}' AS grain, CAST(date_trunc('{grain}', o_orderdate) AS DATE) AS period, o_orderstatus,
           count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY ALL
""" for i, grain in enumerate(("week", "month", "quarter"))), name="period_summary")
def period_summaries(spark, folder):
    orders = load(spark, folder, "orders")
    measures = {"orders": ("count", "o_orderkey"), "revenue": ("sum", "o_totalprice")}
    grains = ("week", "month", "quarter")
    return rounded(grain_summaries(orders, "o_orderdate", grains, measures, ["o_orderstatus"]), "revenue")


@query("""
    SELECT year(d) AS year, quarter(d) AS quarter, month(d) AS month, weekofyear(d) AS week, count(*) AS orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY ALL
""", name="date_parts")
def orders_by_date_parts(spark, folder):
    day = F.col("o_orderdate").cast("date")
    parts = [column.cast("bigint").alias(name) for name, column in date_parts(day).items()]
    return load(spark, folder, "orders").groupBy(*parts).agg(F.count(F.lit(1)).alias("orders"))


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 1
""", name="first_row")
def first_order(spark, folder):
    return first_row(load(spark, folder, "orders"), "o_orderdate", "o_orderkey").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice")
