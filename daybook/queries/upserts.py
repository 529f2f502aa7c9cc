"""Upserts, their counts and audits, change detection and incremental refresh.

The stored side is all orders before 2000, the batch all orders from 1999 on with corrections, so that both
together cover the whole table: 1999 is updated, later years are inserted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from daybook.operators.kpi import last_n_days
from daybook.operators.upsert import filter_words, one_version, row_diff, summary_message, table_audit, upsert, upsert_stats
from daybook.plans.batch import FILTER_LIMIT, upsert_all
from daybook.plans.batch import changed_days as batch_days
from daybook.plans.diff import stored_diff
from daybook.plans.refresh import Report, refresh_incremental, refresh_snapshot, refresh_view
from daybook.queries.registry import load, query
from daybook.session import shared_folder
from daybook.sources.bucketed import write_bucketed
from daybook.sources.footers import newest_day, stored_figures
from daybook.sources.tables import TableStore
from daybook.specs import Buckets, ColumnSpec, ParentRef, Periods, TableSpec

STORED_UNTIL = "DATE'2000-01-01'"
SENT_FROM = "DATE'1999-01-01'"

ORDERS = TableSpec("orders", (
    ColumnSpec("o_orderkey", "bigint", "o_orderkey"),
    ColumnSpec("o_orderdate", "date", "o_orderdate"),
    ColumnSpec("o_totalprice", "double", "o_totalprice"),
    ColumnSpec("o_orderpriority", "string", "o_orderpriority"),
), ("o_orderkey",), Buckets(("o_orderkey",), 8), label="Orders")

# The same orders, kept by year: a batch falls in the folders of its years only.
DATED_ORDERS = TableSpec("dated_orders", ORDERS.columns, ("o_orderdate", "o_orderkey"), Periods("o_orderdate", "year"))

LINES = TableSpec("lines", (
    ColumnSpec("l_orderkey", "bigint", "l_orderkey"),
    ColumnSpec("l_linenumber", "int", "l_linenumber"),
    ColumnSpec("l_quantity", "double", "l_quantity"),
    ColumnSpec("l_extendedprice", "double", "l_extendedprice"),
), ("l_orderkey", "l_linenumber"), Buckets(("l_orderkey", "l_linenumber"), 8),
    ParentRef("orders", (("l_orderkey", "o_orderkey"),)), "Lines")

NOTES = TableSpec("notes", (
    ColumnSpec("l_orderkey", "bigint", "l_orderkey"),
    ColumnSpec("text", "string", "text"),
), ("l_orderkey",), Buckets(("l_orderkey",), 8), ParentRef("orders", (("l_orderkey", "o_orderkey"),)), "Notes")


# Later versions of a key, as far as the rows themselves tell.
LAST_BY = ("l_extendedprice", "l_quantity", "o_totalprice", "text")


def order_rows(spark, folder):
    return load(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderpriority")


def stored_orders(spark, folder):
    return order_rows(spark, folder).filter(f"o_orderdate < {STORED_UNTIL}")


def sent_orders(spark, folder):
    """The batch: prices corrected, urgent priorities blanked, every row sent twice."""
    sent = order_rows(spark, folder).filter(f"o_orderdate >= {SENT_FROM}").select(
        "o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("o_orderpriority"))
    return sent.unionByName(sent)


ORDERS_AFTER = f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN o_orderdate >= {SENT_FROM} THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderdate >= {SENT_FROM} AND o_orderpriority = '1-URGENT' THEN NULL
                ELSE o_orderpriority END AS o_orderpriority
    FROM orders
"""


@query(f"""
    WITH stored AS (SELECT * FROM orders WHERE o_orderdate < {STORED_UNTIL}),
         sent AS (SELECT DISTINCT o_orderkey, o_orderdate, round(o_totalprice + 1, 2) AS o_totalprice,
                         nullif(o_orderpriority, '1-URGENT') AS o_orderpriority
                  FROM orders WHERE o_orderdate >= {SENT_FROM})
    SELECT coalesce(n.o_orderkey, t.o_orderkey) AS o_orderkey,
           CAST(CASE WHEN n.o_orderkey IS NULL THEN t.o_orderdate ELSE n.o_orderdate END AS DATE) AS o_orderdate,
           CASE WHEN n.o_orderkey IS NULL THEN t.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
           CASE WHEN n.o_orderkey IS NULL THEN t.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority
    FROM stored t FULL JOIN sent n ON t.o_orderkey = n.o_orderkey
""")
def upsert_orders(spark, folder):
    return upsert(stored_orders(spark, folder), sent_orders(spark, folder), ["o_orderkey"])


@query(ORDERS_AFTER)
def upsert_filtered(spark, folder):
    """The upsert of many keys: a Bloom filter of them spares the orders that it rules out the shuffle."""
    staged = one_version(sent_orders(spark, folder), ORDERS.key)
    words = filter_words(staged.count(), FILTER_LIMIT)
    return upsert(stored_orders(spark, folder), staged, ORDERS.key, unique=True, words=words)


UPSERT_COUNTS = f"""
    SELECT count(*) FILTER (WHERE o_orderdate >= {SENT_FROM}) AS affected,
           count(*) FILTER (WHERE o_orderdate >= {STORED_UNTIL}) AS inserted,
           count(*) FILTER (WHERE o_orderdate >= {SENT_FROM} AND o_orderdate < {STORED_UNTIL}) AS updated
    FROM orders
"""


@query(UPSERT_COUNTS, name="upsert_stats")
def upsert_counts(spark, folder):
    return upsert_stats(stored_orders(spark, folder), sent_orders(spark, folder), ["o_orderkey"])


def stored_store(spark, folder, label, *specs):
    """A fresh store that holds the history of the given tables."""
    store = TableStore(spark, shared_folder(spark, label))
    orders = stored_orders(spark, folder)
    rows = {"orders": orders, "lines": line_rows(spark, folder, orders), "notes": no_notes(spark, folder)}
    upsert_all(store, specs, "history", lambda spec: rows[spec.name], "latest", order=LAST_BY)
    return store


def line_rows(spark, folder, orders):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")


def no_notes(spark, folder):
    """A table for which the batch has nothing."""
    return load(spark, folder, "lineitem").filter("l_orderkey IS NULL").select(
        "l_orderkey", F.col("l_returnflag").alias("text"))


@query(ORDERS_AFTER)
def upsert_stored(spark, folder):
    """The upsert on disk: staging, merge of the touched folders into a new version, commit."""
    store = stored_store(spark, folder, "upsert", ORDERS)
    upsert_all(store, [ORDERS], "corrections", lambda _: sent_orders(spark, folder))
    return store.read(ORDERS)


@query(f"""
    WITH keys AS (SELECT l_orderkey, l_linenumber, o_orderdate, max(l_extendedprice) AS last
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
         amounts AS (SELECT round(sum(last), 2) AS amount FROM keys)
    SELECT 1 AS position, 'orders' AS table_name, 'applied' AS status, affected AS staged, affected, inserted,
           updated, inserted AS change,
           (SELECT round(sum(o_totalprice), 2) FROM ({ORDERS_AFTER})) AS amount FROM ({UPSERT_COUNTS})
    UNION ALL
    SELECT 2, 'lines', 'applied', count(*) FILTER (WHERE o_orderdate >= {SENT_FROM}),
           count(*) FILTER (WHERE o_orderdate >= {SENT_FROM}), count(*) FILTER (WHERE o_orderdate >= {STORED_UNTIL}),
           count(*) FILTER (WHERE o_orderdate >= {SENT_FROM} AND o_orderdate < {STORED_UNTIL}),
           count(*) FILTER (WHERE o_orderdate >= {STORED_UNTIL}), (SELECT amount FROM amounts) FROM keys
    UNION ALL SELECT 3, 'notes', 'skipped', 0, 0, 0, 0, 0, NULL
""")
def upsert_all_audit(spark, folder):
    """The audit, and the sum of each table's amounts, which only the last versions of the lines give."""
    store = stored_store(spark, folder, "audit", ORDERS, LINES)
    sent = sent_orders(spark, folder)
    rows = {"orders": sent, "lines": line_rows(spark, folder, sent), "notes": no_notes(spark, folder)}
    audit = upsert_all(store, [ORDERS, LINES, NOTES], "corrections", lambda spec: rows[spec.name], "latest", order=LAST_BY)
    amounts = [store.read(spec).agg(F.round(F.sum(column), 2).alias("amount")).withColumn("table_name", F.lit(spec.name))
               for spec, column in ((ORDERS, "o_totalprice"), (LINES, "l_extendedprice"))]
    return audit.join(amounts[0].unionByName(amounts[1]), "table_name", "left").select(
        "position", "table_name", "status", "staged", "affected", "inserted", "updated",
        (F.col("after") - F.col("before")).alias("change"), "amount")


@query(f"""
    WITH o AS ({UPSERT_COUNTS}),
         l AS (SELECT count(*) AS affected FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
               JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= {SENT_FROM}))
    SELECT 'Upsert completed: Orders=' || o.affected || ', Lines=' || l.affected || ' rows' AS message,
           CAST(o.affected + l.affected AS BIGINT) AS total_rows FROM o, l
""", name="summary_message")
def upsert_message(spark, folder):
    """The message of a batch, out of the audit of its tables."""
    sent = sent_orders(spark, folder)
    staged = {ORDERS: sent, LINES: line_rows(spark, folder, sent)}
    parts = [upsert_stats(df.limit(0), df, spec.key).withColumns({"position": F.lit(i), "title": F.lit(spec.title)})
             for i, (spec, df) in enumerate(staged.items(), start=1)]
    return summary_message(parts[0].unionByName(parts[1]))


@query(f"""
    SELECT 'orders' AS table_name, count(*) FILTER (WHERE o_orderdate < {STORED_UNTIL}) AS "before",
           count(*) AS "after", count(*) FILTER (WHERE o_orderdate >= {SENT_FROM}) AS staged,
           CAST(0 AS BIGINT) AS staged_after,
           count(*) FILTER (WHERE o_orderdate >= {STORED_UNTIL}) AS change, TRUE AS staging_cleared
    FROM orders
""", name="table_audit")
def table_counts(spark, folder):
    """The table, and what is staged for it, before and after a batch."""
    stored, staged = stored_orders(spark, folder), one_version(sent_orders(spark, folder), ORDERS.key)
    return table_audit({"orders": {"before": stored, "staged": staged, "after": upsert(stored, staged, ORDERS.key, unique=True),
                                   "staged_after": 0}})


@query(f"""
    SELECT o_orderkey, CASE WHEN o_orderdate >= {STORED_UNTIL} THEN 'inserted'
           WHEN o_orderdate >= {SENT_FROM} THEN 'updated' ELSE 'unchanged' END AS change FROM orders
""")
def stored_row_diff(spark, folder):
    """A stored table as it was before a batch against what it is after it."""
    before, after = stored_store(spark, folder, "before", ORDERS), stored_store(spark, folder, "after", ORDERS)
    upsert_all(after, [ORDERS], "corrections", lambda _: sent_orders(spark, folder))
    return stored_diff(before, after, ORDERS).select("o_orderkey", "change")


@query(f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN o_orderdate >= {STORED_UNTIL} THEN 'inserted' ELSE 'updated' END AS change
    FROM orders WHERE o_orderdate >= {SENT_FROM}
""")
def stored_changes(spark, folder):
    """What a batch changed in a stored table, by checksums first: folders of equal checksum are not read."""
    before, after = (dated_store(spark, folder, label) for label in ("before", "after"))
    upsert_all(after, [DATED_ORDERS], "corrections", lambda _: sent_orders(spark, folder))
    return stored_diff(before, after, DATED_ORDERS, changes_only=True)


@query("""
    SELECT count(*) AS "rows", min(CAST(o_orderdate AS DATE)) AS oldest, max(CAST(o_orderdate AS DATE)) AS newest FROM orders
    WHERE o_orderdate < DATE'2000-01-01'
""")
def footer_figures(spark, folder):
    """Rows, first and last day of a stored table, out of the footers of its files."""
    return stored_figures(dated_store(spark, folder, "footers"), DATED_ORDERS, "o_orderdate")


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate < DATE'2000-01-01' AND CAST(o_orderdate AS DATE) > (
        SELECT max(CAST(o_orderdate AS DATE)) - 7 FROM orders WHERE o_orderdate < DATE'2000-01-01')
""")
def stored_last_7_days(spark, folder):
    """The newest week of a stored table: the footers tell the newest day, the scan gets it as a literal."""
    store = dated_store(spark, folder, "newest")
    day = newest_day(store, DATED_ORDERS, "o_orderdate")
    found = last_n_days(store.read(DATED_ORDERS, with_layout=True), "o_orderdate", 7, as_of=day, layout=DATED_ORDERS.layout)
    return found.select("o_orderkey", "o_orderdate", "o_totalprice")


@query(ORDERS_AFTER)
def catalog_table(spark, folder):
    """Two batches into a table that SQL users see by its name."""
    database = f"daybook_{uuid.uuid4().hex}"
    base = shared_folder(spark, "catalog")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    store = TableStore(spark, f"{base}/store", database=database)
    upsert_all(store, [DATED_ORDERS], "history", lambda _: stored_orders(spark, folder))
    upsert_all(store, [DATED_ORDERS], "corrections", lambda _: sent_orders(spark, folder))
    return spark.sql(f"SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM {database}.{DATED_ORDERS.name}")


@query("""
    SELECT o_orderkey, o_totalprice, count(l_linenumber) AS lines, round(sum(l_extendedprice), 2) AS amount
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
""")
def colocated_join(spark, folder):
    """Orders beside the sums of their lines, both bucketed by order: neither the join nor the grouping shuffles."""
    orders, lines = bucketed_tables(spark, folder)
    amounts = lines.groupBy("o_orderkey").agg(F.count("l_linenumber").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    return orders.select("o_orderkey", "o_totalprice").join(amounts, "o_orderkey")


def bucketed_tables(spark, folder, buckets=8):
    base, tag = shared_folder(spark, "bucketed"), uuid.uuid4().hex
    lines = load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice")
    return [write_bucketed(rows, f"daybook_{name}_{tag}", f"{base}/{name}", ["o_orderkey"], buckets)
            for name, rows in (("orders", order_rows(spark, folder)), ("lines", lines))]


def dated_store(spark, folder, label):
    store = TableStore(spark, shared_folder(spark, label))
    upsert_all(store, [DATED_ORDERS], "history", lambda _: stored_orders(spark, folder))
    return store


@query("""
    WITH after AS (
        SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -1 - c_custkey ELSE c_custkey END AS c_custkey, c_nationkey,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer)
    SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
           CASE WHEN b.c_custkey IS NULL THEN 'inserted' WHEN a.c_custkey IS NULL THEN 'deleted'
                WHEN a.c_acctbal IS DISTINCT FROM b.c_acctbal THEN 'updated' ELSE 'unchanged' END AS change
    FROM customer b FULL JOIN after a ON a.c_custkey = b.c_custkey
""", name="row_diff")
def customer_diff(spark, folder):
    before = load(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    segment = F.col("c_mktsegment")
    after = before.select(
        F.when(segment == "MACHINERY", -1 - F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("c_custkey"),
        "c_nationkey", F.when(segment != "BUILDING", F.col("c_acctbal")).alias("c_acctbal"))
    return row_diff(before.drop("c_mktsegment"), after, ["c_custkey"])


REPORT = {"orders": ("count", "o_orderkey"), "revenue": ("sum", "o_totalprice")}
REPORT_SQL = """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, count(*) AS orders,
           round(sum(o_totalprice), 2) AS revenue FROM ({rows}) GROUP BY 1
"""

# Orders that a batch moves: every seventh by 45 days, and those of one month out of it altogether.
MOVED_ROWS = f"""
    SELECT o_orderkey, CASE WHEN o_orderdate >= DATE'1999-03-01' AND o_orderdate < DATE'1999-04-01'
                            THEN DATE'1999-05-05' WHEN o_orderkey % 7 = 0
                            THEN CASE WHEN CAST(o_orderdate AS DATE) + 45 BETWEEN DATE'1999-03-01' AND DATE'1999-03-31'
                                      THEN DATE'1999-06-06' ELSE CAST(o_orderdate AS DATE) + 45 END
                            ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
           o_totalprice FROM orders
"""


def moved_orders(spark, folder):
    """The batch: other dates for some orders; none is left in March 1999."""
    day, march = F.col("o_orderdate"), F.col("o_orderdate").between("1999-03-01", "1999-03-31")
    later = F.date_add(day, 45)
    moved = F.when(march, F.lit("1999-05-05").cast("date")).otherwise(
        F.when(later.between("1999-03-01", "1999-03-31"), F.lit("1999-06-06").cast("date")).otherwise(later))
    return order_rows(spark, folder).filter(march | (F.col("o_orderkey") % 7 == 0)).withColumn("o_orderdate", moved)


def read_report(spark, path):
    report = spark.read.schema("orders bigint, revenue double, period date").parquet(path)
    return report.select("period", "orders", F.round("revenue", 2).alias("revenue"))


@query(REPORT_SQL.format(rows=MOVED_ROWS))
def incremental_refresh(spark, folder):
    """A report on stored orders; a batch moves some to other months and empties one; only those months are redone."""
    base = shared_folder(spark, "report")
    store, path = TableStore(spark, f"{base}/store"), f"{base}/report"
    upsert_all(store, [ORDERS], "history", lambda _: order_rows(spark, folder))
    refresh_view(store.read(ORDERS), "o_orderdate", "month", REPORT, path)
    upsert_all(store, [ORDERS], "moves", lambda _: moved_orders(spark, folder))
    refresh_incremental(store.read(ORDERS), batch_days(store, ORDERS, "moves", "o_orderdate"), "o_orderdate", "month",
                        REPORT, path)
    return read_report(spark, path)


MONTHLY = {"orders": ("count", "o_orderkey"), "revenue": ("sum", "o_totalprice"), "mean_key": ("avg", "o_orderkey")}


@query(f"""
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderpriority, count(*) AS orders,
           round(sum(o_totalprice), 2) AS revenue, avg(o_orderkey) AS mean_key
    FROM (SELECT m.*, o.o_orderpriority FROM ({MOVED_ROWS}) m JOIN orders o USING (o_orderkey)) GROUP BY 1, 2
""")
def summary_delta_refresh(spark, folder):
    """A report kept by what a batch moved: its old rows are subtracted, its new ones added; the table is not read."""
    base = shared_folder(spark, "delta")
    store = TableStore(spark, f"{base}/store")
    report = Report(ORDERS, "o_orderdate", "month", MONTHLY, f"{base}/report", ("o_orderpriority",))
    upsert_all(store, [ORDERS], "history", lambda _: order_rows(spark, folder))
    report.rebuild(store)
    upsert_all(store, [ORDERS], "moves", lambda _: moved_orders(spark, folder))
    report.refresh(store, "moves")
    return report.read(spark).withColumn("revenue", F.round("revenue", 2))


@query(REPORT_SQL.format(rows=ORDERS_AFTER))
def view_swap(spark, folder):
    """A report view turned from one snapshot to the next, by an upsert in between."""
    root, view = shared_folder(spark, "snapshots"), "orders_by_month"
    stored, sent = stored_orders(spark, folder), sent_orders(spark, folder)
    refresh_snapshot(stored, "o_orderdate", "month", REPORT, root, view)
    refresh_snapshot(upsert(stored, sent, ["o_orderkey"]), "o_orderdate", "month", REPORT, root, view)
    return spark.table(view).select("period", "orders", F.round("revenue", 2).alias("revenue"))


@query(REPORT_SQL.format(rows=ORDERS_AFTER), name="refresh_view")
def full_refresh(spark, folder):
    path = shared_folder(spark, "report")
    stored, sent = stored_orders(spark, folder), sent_orders(spark, folder)
    refresh_view(upsert(stored, sent, ["o_orderkey"]), "o_orderdate", "month", REPORT, path)
    return read_report(spark, path)
