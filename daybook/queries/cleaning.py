"""Landing, casting, mapping, deduplication and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import decode_path, lenient_cast, parse_mixed_date
from daybook.operators.dedup import conflicting_keys, dedup_rows, latest_per_key
from daybook.operators.projection import conform, drop_null_key, fan_out, project, quarantine, to_raw
from daybook.operators.quality import (
    coverage, date_quality, fk_violations, pk_violations, row_flow, threshold_alerts, unusual_values, verify_columns)
from daybook.plans.sheets import as_given, dirty_date_text
from daybook.queries.registry import load, query
from daybook.specs import Buckets, ColumnSpec, TableSpec


def dated_orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders with their date as untidy text; a quarter of them has a week label instead."""
    orders = load(spark, folder, "orders")
    return orders.withColumn("date_text", dirty_date_text(F.col("o_orderkey"), F.col("o_orderdate")))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date
    FROM orders
""")
def mixed_date_parse(spark, folder):
    return dated_orders(spark, folder).select("o_orderkey", parse_mixed_date(F.col("date_text")).alias("order_date"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_orderkey % 7 <= 3 THEN CAST(l_quantity AS INTEGER) END AS quantity_int,
           CASE WHEN l_orderkey % 7 <= 2 THEN l_quantity
                WHEN l_orderkey % 7 = 3 THEN CAST(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.7' AS DOUBLE)
           END AS quantity_double,
           CASE WHEN l_orderkey % 7 <= 3 THEN CAST(trunc(l_extendedprice) AS INTEGER) END AS price_int,
           CASE WHEN l_orderkey % 7 <= 3 THEN l_extendedprice WHEN l_orderkey % 7 = 4 THEN 1000.0 END AS price_double
    FROM lineitem
""", name="lenient_cast")
def lenient_casts(spark, folder):
    form = F.col("l_orderkey") % 7
    whole = F.col("l_quantity").cast("int").cast("string")
    quantity = (F.when(form == 0, whole).when(form == 1, F.concat(whole, F.lit(".0")))
                .when(form == 2, F.concat(F.lit(" "), whole, F.lit(" "))).when(form == 3, F.concat(whole, F.lit(".7")))
                .when(form == 4, "1.234,5").when(form == 5, "abc").otherwise("NaN"))
    price = (F.when(form <= 3, F.col("l_extendedprice").cast("decimal(14,2)").cast("string"))
             .when(form == 4, "1e3").when(form == 5, "").otherwise("nan"))
    quantity, price = as_given(quantity), as_given(price)
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        lenient_cast(quantity, "int").alias("quantity_int"), lenient_cast(quantity, "double").alias("quantity_double"),
        lenient_cast(price, "int").alias("price_int"), lenient_cast(price, "double").alias("price_double"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS cents, c_mktsegment
    FROM customer
""")
def raw_landing(spark, folder):
    return to_raw(load(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"),
        "c_mktsegment"))


ORDER_SHEET = TableSpec("order_book", (
    ColumnSpec("order_no", "bigint", "Order\nNo"),
    ColumnSpec("customer_no", "int", "Kunde "),
    ColumnSpec("order_date", "date", "Datum"),
    ColumnSpec("total", "double", "Summe / Order.1"),
    ColumnSpec("priority", "string", "Prio"),
    ColumnSpec("pieces", "int", "Stück"),
), ("order_no",), Buckets(("order_no",), 16))


def order_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an all-text sheet with awkward headers; the sheet has no ``Stück`` column."""
    return to_raw(dated_orders(spark, folder).select(
        F.col("o_orderkey").alias("Order\nNo"), F.concat("o_custkey", F.lit(".0")).alias("Kunde "),
        F.col("date_text").alias("Datum"), F.col("o_totalprice").cast("decimal(14,2)").alias("Summe / Order.1"),
        F.col("o_orderpriority").alias("Prio")))


@query("""
    SELECT o_orderkey AS order_no, CAST(o_custkey AS INTEGER) AS customer_no,
           CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
           o_totalprice AS total, o_orderpriority AS priority, CAST(NULL AS INTEGER) AS pieces
    FROM orders
""")
def mapped_projection(spark, folder):
    return conform(project(order_sheet(spark, folder), ORDER_SHEET), ORDER_SHEET)


TYPED_LINES = TableSpec("typed_lines", (
    ColumnSpec("order_no", "bigint", "l_orderkey"),
    ColumnSpec("line_no", "int", "l_linenumber"),
    ColumnSpec("large", "bigint", "large"),
    ColumnSpec("cents", "int", "cents"),
    ColumnSpec("ratio", "double", "ratio"),
    ColumnSpec("label", "string", "large"),
), ("order_no", "line_no"), Buckets(("order_no", "line_no"), 16))


@query("""
    SELECT l_orderkey AS order_no, l_linenumber AS line_no, CAST(trunc(l_partkey * 1e6 + 0.5) AS BIGINT) AS large,
           CASE WHEN l_linenumber <> 2 THEN CAST(round(l_extendedprice * 100) AS INTEGER) END AS cents,
           CASE WHEN l_linenumber <> 1 THEN l_discount END AS ratio,
           CAST(l_partkey * 1000000 AS VARCHAR) || '.5' AS label
    FROM lineitem
""")
def typed_projection(spark, folder):
    """Typed numbers through the mapping: beyond 1e7, beyond the target type, NaN."""
    line = F.col("l_linenumber")
    typed = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 1e6 + 0.5).alias("large"),
        F.when(line == 2, 1e12).otherwise(F.round(F.col("l_extendedprice") * 100)).alias("cents"),
        F.when(line == 1, float("nan")).otherwise(F.col("l_discount")).alias("ratio"))
    return project(typed, TYPED_LINES)


LINE_SHEET = TableSpec("line_book", (
    ColumnSpec("order_no", "bigint", "Order\nNo"),
    ColumnSpec("line_no", "int", "Zeile"),
    ColumnSpec("part_no", "bigint", "Teil"),
    ColumnSpec("quantity", "int", "Menge"),
    ColumnSpec("price", "double", "Preis"),
), ("order_no", "line_no"), Buckets(("order_no", "line_no"), 16))


@query("""
    WITH sheet AS (SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT 'order_book' AS table_name, count(*) AS row_count, round(sum(total), 2) AS amount
    FROM (SELECT DISTINCT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice AS total FROM sheet)
    UNION ALL
    SELECT 'line_book', count(*), round(sum(price), 2)
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice AS price FROM sheet
                                           WHERE l_orderkey IS NOT NULL)
""")
def fan_out_orders(spark, folder):
    lines = to_raw(load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("Order\nNo"), F.col("l_linenumber").alias("Zeile"), F.col("l_partkey").alias("Teil"),
        F.col("l_quantity").cast("int").alias("Menge"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("Preis")))
    tables = fan_out(order_sheet(spark, folder).join(lines, "Order\nNo", "left"), [ORDER_SHEET, LINE_SHEET])
    parts = [tables[name].agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum(amount), 2).alias("amount"))
             .select(F.lit(name).alias("table_name"), "row_count", "amount")
             for name, amount in (("order_book", "total"), ("line_book", "price"))]
    return parts[0].unionByName(parts[1])


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE o_orderkey % 4 <> 3")
def null_key_filter(spark, folder):
    return drop_null_key(mixed_date_parse(spark, folder), "order_date")


@query("""
    SELECT o_orderkey, 'Werte aus KW' || weekofyear(o_orderdate) || ' ' || year(o_orderdate) AS date_text,
           'order_date is null' AS reason
    FROM orders WHERE o_orderkey % 4 = 3
""")
def null_key_quarantine(spark, folder):
    parsed = dated_orders(spark, folder).select(
        "o_orderkey", "date_text", parse_mixed_date(F.col("date_text")).alias("order_date"))
    return quarantine(parsed, "order_date").select("o_orderkey", "date_text", "reason")


@query("""
    SELECT 'book-' || l_suppkey AS path, min(l_linenumber) AS row_no, l_orderkey AS order_no, l_partkey AS part_no,
           CAST(l_quantity AS INTEGER) AS quantity
    FROM lineitem GROUP BY l_suppkey, l_orderkey, l_partkey, CAST(l_quantity AS INTEGER)
""")
def dedup_raw(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        F.concat(F.lit("book-"), "l_suppkey").alias("path"), F.col("l_linenumber").alias("row_no"),
        F.create_map(F.lit("order"), F.col("l_orderkey").cast("string"), F.lit("part"),
                     F.col("l_partkey").cast("string"), F.lit("menge"),
                     F.col("l_quantity").cast("int").cast("string")).alias("cells"))
    copies = lines.withColumn("row_no", F.col("row_no") + 100)
    return dedup_rows(lines.unionByName(copies)).select(
        "path", "row_no", F.col("cells")["order"].cast("bigint").alias("order_no"),
        F.col("cells")["part"].cast("bigint").alias("part_no"), F.col("cells")["menge"].cast("int").alias("quantity"))


@query("SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)")
def dedup_table(spark, folder):
    lines = load(spark, folder, "lineitem")
    return dedup_rows(lines.unionByName(lines))


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS versions FROM (SELECT DISTINCT * FROM lineitem)
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""", name="conflicting_keys")
def conflicting_lines(spark, folder):
    return conflicting_keys(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC) AS n FROM lineitem)
    WHERE n = 1
""", name="latest_per_key")
def latest_lines(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                   "l_shipdate")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("""
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN url || ' b+c%zz' ELSE url || '+%' END AS path
    FROM pages
""")
def path_decode(spark, folder):
    encoded = F.replace(F.url_encode("url"), F.lit("+"), F.lit("%20"))
    form = F.col("page_id") % 3
    sent = (F.when(form == 0, encoded).when(form == 1, F.concat(encoded, F.lit("%20b+c%zz")))
            .otherwise(F.concat(encoded, F.lit("+%"))))
    return load(spark, folder, "pages").select("page_id", decode_path(sent).alias("path"))


@query("""
    SELECT l_orderkey, nullif(l_linenumber, 7) AS line_no, count(*) AS row_count,
           CASE WHEN nullif(l_linenumber, 7) IS NULL THEN 'null key' ELSE 'repeated key' END AS reason
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 OR line_no IS NULL
""", name="pk_violations")
def primary_key_check(spark, folder):
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("line_no"))
    return pk_violations(lines, ["l_orderkey", "line_no"])


@query("""
    SELECT o_orderkey, count(*) AS row_count FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey
""", name="fk_violations")
def foreign_key_check(spark, folder):
    return fk_violations(load(spark, folder, "orders"), load(spark, folder, "lineitem"),
                         [("o_orderkey", "l_orderkey")])


EVENT_SHEET = TableSpec("event_values", (
    ColumnSpec("day", "date", "Datum"),
    ColumnSpec("clicks", "double", "click"),
    ColumnSpec("views", "double", "view"),
    ColumnSpec("purchases", "double", "purchase"),
    ColumnSpec("errors", "int", "error"),
    ColumnSpec("returns", "int", "return"),
), ("day",), Buckets(("day",), 4))


@query("""
    WITH found AS (SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type),
         wanted(column_name, header) AS (VALUES ('day', 'Datum'), ('clicks', 'click'), ('views', 'view'),
                                         ('purchases', 'purchase'), ('errors', 'error'), ('returns', 'return'))
    SELECT 'event_values' AS table_name, column_name, header, coalesce(n, 0) AS found,
           (SELECT count(DISTINCT user_id) FROM events) AS workbooks,
           coalesce(n, 0) < (SELECT count(DISTINCT user_id) FROM events) AS incomplete
    FROM wanted LEFT JOIN found ON header = event_type
""")
def column_coverage(spark, folder):
    raw = load(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("path"),
        F.create_map("event_type", F.col("value").cast("string")).alias("cells"))
    return coverage(raw, EVENT_SHEET)


@query("""
    WITH d AS (SELECT lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'lang' AS column_name, TRUE AS present, count(lang) AS filled, count(*) AS total,
           round(count(lang) / count(*), 6) AS filled_share FROM d
    UNION ALL SELECT 'quality', TRUE, count(quality), count(*), round(count(quality) / count(*), 6) FROM d
    UNION ALL SELECT 'toxic', TRUE, count(toxic), count(*), round(count(toxic) / count(*), 6) FROM d
    UNION ALL SELECT 'rating', FALSE, 0, count(*), 0.0 FROM d
""", name="verify_columns")
def required_columns(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "lang")
    return verify_columns(documents.join(load(spark, folder, "labels"), "doc_id", "left"),
                          ["lang", "quality", "toxic", "rating"])


@query("SELECT count(*) FILTER (WHERE o_orderkey % 4 <> 3) AS valid_dates, count(*) AS total_rows FROM orders", name="date_quality")
def date_quality_counts(spark, folder):
    return date_quality(mixed_date_parse(spark, folder), "order_date")


SHIPMENTS = TableSpec("shipments", (
    ColumnSpec("ship_date", "date", "Datum"),
    ColumnSpec("part_no", "bigint", "Teil"),
    ColumnSpec("quantity", "int", "Menge"),
), ("ship_date",), Buckets(("ship_date",), 16))


@query("""
    WITH typed AS (SELECT CASE WHEN l_orderkey % 4 = 3 THEN NULL ELSE l_shipdate END AS d,
                          l_partkey AS p, l_quantity AS q FROM lineitem)
    SELECT 'shipments' AS table_name, 2 * count(*) AS initial_rows, 2 * count(d) AS kept_rows,
           2 * (count(*) - count(d)) AS removed_rows,
           (SELECT count(*) FROM (SELECT DISTINCT * FROM typed WHERE d IS NOT NULL)) AS deduped_rows
    FROM typed
""", name="row_flow")
def row_flow_counts(spark, folder):
    lines = load(spark, folder, "lineitem")
    sheet = lines.select(dirty_date_text(F.col("l_orderkey"), F.col("l_shipdate")).alias("Datum"),
                         F.col("l_partkey").cast("string").alias("Teil"),
                         F.col("l_quantity").cast("int").cast("string").alias("Menge"))
    return row_flow(sheet.unionByName(sheet), SHIPMENTS)


@query("""
    SELECT *, CASE WHEN value < 100 THEN 'low' ELSE 'high' END AS alert FROM (
        SELECT CAST(ts AS DATE) AS day, event_type, round(sum(value), 2) AS value FROM events GROUP BY 1, 2)
    WHERE value < 100 OR value > 400
""", name="threshold_alerts")
def threshold_alert_days(spark, folder):
    return threshold_alerts(daily_event_values(spark, folder), "value", 100.0, 400.0)


def daily_event_values(spark, folder):
    return load(spark, folder, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(
        F.round(F.sum("value"), 2).alias("value"))


@query("""
    WITH days AS (
        SELECT CAST(ts AS DATE) AS day, event_type, round(sum(value), 2) AS value FROM events GROUP BY 1, 2),
    scored AS (
        SELECT *, avg(value) OVER w AS mean_before, stddev_samp(value) OVER w AS spread, count(value) OVER w AS n
        FROM days WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT day, event_type, value, round(mean_before, 4) AS mean_before,
           round((value - mean_before) / spread, 4) AS score
    FROM scored WHERE n = 7 AND spread > 0 AND abs((value - mean_before) / spread) > 1.5
""", name="unusual_values")
def unusual_event_days(spark, folder):
    return unusual_values(daily_event_values(spark, folder), "day", "value", 7, 1.5, ["event_type"]).select(
        "day", "event_type", "value", F.round("mean_before", 4).alias("mean_before"),
        F.round("score", 4).alias("score"))
