"""Untidy sheets made from clean tables: the inputs of the registered queries and of the tests."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Sequence
from datetime import date, datetime
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.specs import DATE_HEADER, PLANT_TABLES

FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("content", T.BinaryType()),
])

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def render_workbook(rows: Iterable[Sequence[object]]) -> bytes:
    """A minimal one-sheet xlsx: dates as serial numbers, numbers as numbers, text shared or inline."""
    strings: dict[str, int] = {}

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, date):
            day = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
            return f'<c s="1"><v>{(day - datetime(1899, 12, 30)).total_seconds() / 86400:.10g}</v></c>'
        if isinstance(value, bool):
            return f'<c t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c><v>{value!r}</v></c>"
        if len(value) % 2:
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
        return f'<c t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'

    body = "".join(f'<row>{"".join(cell(v) for v in row)}</row>' for row in rows)
    shared = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELATIONS}"><sheets>'
                           '<sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}">'
                                      f'<Relationship Id="rId1" Type="{_RELATIONS}/worksheet" '
                                      'Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs>'
                         "</styleSheet>",
        "xl/sharedStrings.xml": f'<sst xmlns="{_MAIN}">{shared}</sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()


# Headers of the order sheets. The repeated one is read as "Takte" and "Takte.1".
ORDER_HEADERS = (DATE_HEADER, "Order\nNo", "Kunde ", "Summe", "Takte", "Takte", "Status")
ORDERS_PER_BOOK = 500


def order_workbooks(orders: DataFrame, wave: int = 1) -> DataFrame:
    """Orders as xlsx files of at most 500 rows each, shaped like a ``binaryFile`` scan.

    The task count is given, since work per byte is high here and adaptive coalescing goes by bytes.
    """
    sent = datetime(2024, 1, wave)

    def render(key: tuple, book: pd.DataFrame) -> pd.DataFrame:
        rows = [["Auftragsbuch"], list(ORDER_HEADERS)]
        for r in book.itertuples(index=False):
            status = None if r.status == "F" else r.status
            rows.append([r.day, r.order_no, r.customer_no, r.total, r.order_no, -r.order_no, status])
        rows.append(["Werte aus KW1 2024", None, 1, 2.5])
        return pd.DataFrame({"path": [f"wave-{wave}/book-{key[0]}.xlsx"], "modificationTime": [sent],
                             "content": [render_workbook(rows)]})

    session = orders.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    return orders.select(
        F.expr(f"o_orderkey div {ORDERS_PER_BOOK}").alias("book"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderkey").alias("order_no"),
        F.col("o_custkey").alias("customer_no"), F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
    ).repartition(tasks, "book").groupBy("book").applyInPandas(render, FILE_SCHEMA)


def as_given(text: Column) -> Column:
    """Made-up text as if it came from a file: the optimizer must not paste its making into every use."""
    return F.when(F.monotonically_increasing_id() >= 0, text)


def dirty_date_text(key: Column, moment: Column) -> Column:
    """A date as the sheets write it: ISO, calendar text, slashes, or a week label that is no date."""
    day = moment.cast("date")
    week_label = F.concat(F.lit("Werte aus KW"), F.weekofyear(day), F.lit(" "), F.year(day))
    form = F.pmod(key, F.lit(4))
    return as_given(F.when(form == 3, week_label).otherwise(written_date(form, day)))


def written_date(form: Column, day: Column) -> Column:
    """A date in one of the three accepted forms, by number."""
    calendar = F.concat(
        F.lit("java.util.GregorianCalendar[time=?,YEAR="), F.year(day), F.lit(",MONTH="), F.month(day) - 1,
        F.lit(",WEEK_OF_YEAR=1,DAY_OF_MONTH="), F.dayofmonth(day), F.lit(",DAY_OF_YEAR=1]"))
    return (F.when(form == 0, F.concat(day.cast("string"), F.lit(" 00:00:00")))
            .when(form == 1, calendar)
            .otherwise(F.date_format(day, "MM/dd/yyyy")))


def plant_headers() -> list[tuple[str, str]]:
    """Every (header, type) of the plant sheet once, in spec order."""
    found: dict[str, str] = {}
    for spec in PLANT_TABLES:
        for c in spec.columns:
            if c.type != "date":
                found.setdefault(c.source, c.type)
    return list(found.items())


def plant_sheet(lineitem: DataFrame) -> DataFrame:
    """A daily plant sheet out of line items: one row per day, one text row per week, dirty cells.

    Cell ``i`` of a day is a number derived from that day's count, quantity and price; by day and column it
    is spoiled, blank, NaN, padded or written with a fraction.
    """
    headers = plant_headers()
    day = F.col("l_shipdate").cast("date").alias("day")
    daily = lineitem.groupBy(day).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("c"),
    )
    whole = [kind == "int" for _, kind in headers]

    def cell(is_whole: Column, i: Column) -> Column:
        number = (F.col("n") * (i + 3) + F.col("q") * (i + 1) + F.col("c")) % 5000
        cents = (F.col("c") * (i + 1) + F.col("q")) % 100000
        fraction = F.concat_ws(".", F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0"))
        text = F.when(is_whole, number.cast("string")).otherwise(fraction)
        form = (F.dayofyear("day") + i) % 11
        return (F.when(form == 0, "abc").when(form == 1, "").when(form == 2, "NaN")
                .when(form == 3, F.concat(F.lit(" "), text, F.lit(" ")))
                .when((form == 4) & is_whole, F.concat(text, F.lit(".0")))
                .otherwise(text))

    cells = F.map_from_arrays(
        F.array(F.lit(DATE_HEADER), *[F.lit(h) for h, _ in headers]),
        F.concat(F.array(written_date(F.dayofmonth("day") % 3, F.col("day"))),
                 F.transform(F.array(*[F.lit(w) for w in whole]), cell)))
    book = F.concat(F.lit("plant-"), F.year("day"), F.lit(".xlsx")).alias("path")
    rows = daily.select(book, F.dayofyear("day").alias("row_no"), as_given(cells).alias("cells"))
    label = F.concat(F.lit("Werte aus KW"), F.weekofyear("day"), F.lit(" "), F.year("day"))
    weeks = daily.groupBy(book, (F.weekofyear("day") + 400).alias("row_no"), label.alias("label")).agg(
        F.count(F.lit(1)).alias("days"))
    return rows.unionByName(weeks.select(
        "path", "row_no", F.create_map(F.lit(DATE_HEADER), F.col("label")).alias("cells")))
