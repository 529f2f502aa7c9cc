"""Workbooks rendered from the orders by Spark, then read back: as a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators.projection import drop_null_key, project, with_date
from daybook.plans.batch import ingest_batch, quarantine_path
from daybook.plans.sheets import FILE_SCHEMA, ORDER_HEADERS, order_workbooks
from daybook.queries.registry import load, query
from daybook.session import shared_folder
from daybook.sources.tables import TableStore
from daybook.sources.workbook import decode_workbooks
from daybook.specs import DATE_HEADER, Buckets, ColumnSpec, TableSpec
from daybook.streaming.ingest import ingest_stream

BOOKED = TableSpec("booked", (
    ColumnSpec("order_no", "bigint", ORDER_HEADERS[1]),
    ColumnSpec("order_date", "date", "date"),
    ColumnSpec("customer_no", "bigint", ORDER_HEADERS[2]),
    ColumnSpec("total", "double", ORDER_HEADERS[3]),
    ColumnSpec("first_step", "int", "Takte"),
    ColumnSpec("second_step", "int", "Takte.1"),
    ColumnSpec("status", "string", ORDER_HEADERS[6]),
), ("order_no",), Buckets(("order_no",), 8))


@query("""
    SELECT o_orderkey AS order_no, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_no,
           o_totalprice AS total, CAST(o_orderkey AS INTEGER) AS first_step,
           CAST(-o_orderkey AS INTEGER) AS second_step, nullif(o_orderstatus, 'F') AS status FROM orders
""")
def workbook_ingest(spark, folder):
    raw = decode_workbooks(order_workbooks(load(spark, folder, "orders")))
    return drop_null_key(project(with_date(raw, DATE_HEADER), BOOKED), "order_no")


@query("""
    SELECT o_orderkey AS order_no, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_no,
           CASE WHEN o_orderstatus = 'O' THEN round(o_totalprice + 1000, 2) ELSE o_totalprice END AS total,
           CAST(o_orderkey AS INTEGER) AS first_step, CAST(-o_orderkey AS INTEGER) AS second_step,
           nullif(o_orderstatus, 'F') AS status FROM orders
""")
def stream_ingest(spark, folder):
    """Three runs of the stream: all orders, then corrected sheets of the open ones, then the first files once more under
    other names, which are known by their contents and change nothing."""
    orders = load(spark, folder, "orders")
    base = shared_folder(spark, "stream")
    store = TableStore(spark, f"{base}/store")
    corrected = orders.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    order_workbooks(orders, 1).write.parquet(f"{base}/first")
    first = spark.read.parquet(f"{base}/first")
    for sent in (first, order_workbooks(corrected, 2), first.withColumn("path", F.concat(F.lit("again/"), "path"))):
        sent.write.mode("append").parquet(f"{base}/inbox")
        files = spark.readStream.schema(FILE_SCHEMA).parquet(f"{base}/inbox").repartition(
            spark.sparkContext.defaultParallelism)
        ingest_stream(files, store, [BOOKED], f"{base}/checkpoint", DATE_HEADER).awaitTermination()
    return store.read(BOOKED).withColumn("total", F.round("total", 2))


def partly_broken(orders):
    """The order workbooks, every fifth cut off in the middle."""
    book = F.regexp_extract("path", r"book-(\d+)", 1).cast("bigint")
    half = F.expr("substring(content, 1, length(content) div 2)")
    return order_workbooks(orders).withColumn("content", F.when(book % 5 == 0, half).otherwise(F.col("content")))


def ingested_beside_broken(spark, folder):
    store = TableStore(spark, shared_folder(spark, "broken"))
    ingest_batch(store, decode_workbooks(partly_broken(load(spark, folder, "orders"))), [BOOKED], "first", DATE_HEADER)
    return store


@query("""
    SELECT o_orderkey AS order_no, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_no,
           o_totalprice AS total, CAST(o_orderkey AS INTEGER) AS first_step,
           CAST(-o_orderkey AS INTEGER) AS second_step, nullif(o_orderstatus, 'F') AS status FROM orders
    WHERE o_orderkey // 500 % 5 <> 0
""")
def ingest_beside_broken(spark, folder):
    """A workbook that cannot be read costs its own rows only."""
    return ingested_beside_broken(spark, folder).read(BOOKED)


@query("""
    SELECT 'wave-1/book-' || o_orderkey // 500 || '.xlsx' AS path,
           CASE WHEN o_orderkey // 500 % 5 = 0 THEN -1 ELSE count(*) END AS row_no,
           CASE WHEN o_orderkey // 500 % 5 = 0 THEN 'BadZipFile' ELSE 'booked' END AS cause,
           CASE WHEN o_orderkey // 500 % 5 <> 0 THEN 'Werte aus KW1 2024' END AS date_text,
           CASE WHEN o_orderkey // 500 % 5 <> 0 THEN '2.5' END AS total_text
    FROM orders GROUP BY o_orderkey // 500
""")
def stored_quarantine(spark, folder):
    """What a batch could not take, with its contents: broken workbooks and rows without a key."""
    store = ingested_beside_broken(spark, folder)
    return spark.read.parquet(quarantine_path(store, "first")).select(
        "path", "row_no", F.split("reason", ":")[0].alias("cause"),
        F.get_json_object("contents", f"$.{DATE_HEADER}").alias("date_text"),
        F.get_json_object("contents", f"$.{ORDER_HEADERS[3]}").alias("total_text"))
