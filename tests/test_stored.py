"""Filtered upserts, delta refresh, checksum-first diff, footers, bucketed tables, files sent again: results and plans."""

import os
import random
import re
import subprocess
import sys
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.operators.kpi import period_summary
from daybook.operators.upsert import CROWDED, filter_words, key_filter, row_diff, upsert, with_maybe
from daybook.plans import batch as flow
from daybook.plans import refresh as refreshing
from daybook.plans.batch import ingest_batch, ingest_files, upsert_all
from daybook.plans.diff import changed_folders, stored_diff
from daybook.plans.refresh import Report, refresh_snapshot
from daybook.plans.sheets import render_workbook
from daybook.sources import TableStore, file_stream, from_footers, newest_day, stored_figures, write_bucketed
from daybook.sources.tables import finished_steps
from daybook.sources.workbook import FILE_COLUMNS, WORKBOOK_GLOB
from daybook.specs import DATE_HEADER, OVERVIEW, Buckets, ColumnSpec, Periods, TableSpec
from daybook.streaming import ingest_stream

DATED = TableSpec("dated", (ColumnSpec("d", "date", "D"), ColumnSpec("k", "int", "K"), ColumnSpec("g", "string", "G"),
                            ColumnSpec("v", "int", "V")), ("d", "k"), Periods("d", "month"))
FREE = TableSpec("free", (ColumnSpec("k", "int", "K"), ColumnSpec("d", "date", "D"), ColumnSpec("g", "string", "G"),
                          ColumnSpec("v", "int", "V")), ("k",), Buckets(("k",), 3))
MEASURES = {"n": ("count", "k"), "total": ("sum", "v"), "mean": ("avg", "v"), "least": ("min", "v"), "most": ("max", "v")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def send(store, spec, batch, data):
    schema = ", ".join(f"{c.name} {c.type}" for c in spec.columns)
    return upsert_all(store, [spec], batch, lambda _: store.spark.createDataFrame(data, schema))


# --- Bloom-filtered upsert

def test_filter_size():
    assert filter_words(400, 1 << 20) == 100 and filter_words(0, 1 << 20) == 1
    assert filter_words(1 << 20, 32 * 1000) == 0  # too many keys to tell apart
    assert filter_words(CROWDED * 1000, 32 * 1000) == 1000 and filter_words(5, 0) == 0


def test_the_filter_loses_no_key(spark):
    keys = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("s"))
    words = filter_words(3000, 1 << 20)
    seen = with_maybe(keys, ["k", "s"], key_filter(keys, ["k", "s"], words), words)
    assert seen.columns == ["k", "s", "maybe"] and seen.where("NOT maybe").count() == 0
    others = spark.range(10_000, 60_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
    passed = with_maybe(others, ["k", "s"], key_filter(keys, ["k", "s"], words), words).where("maybe").count()
    assert passed < 0.02 * 50_000


def test_only_possible_matches_are_shuffled(spark, shuffled_joins):
    rng = random.Random(1)
    target = spark.createDataFrame([(i, f"t{i}") for i in range(20_000)], "k long, v string")
    staged = spark.createDataFrame([(i, f"s{i}" if i % 3 else None) for i in rng.sample(range(40_000), 500)], "k long, v string")
    want = rows(upsert(target, staged, ["k"], unique=True))
    filtered = upsert(target, staged, ["k"], unique=True, words=filter_words(500, 1 << 20))
    assert rows(filtered) == want and rows(upsert(target, staged, ["k"], unique=True, words=1)) == want
    assert rows(upsert(target, staged.limit(0), ["k"], unique=True, words=1)) == rows(target)
    fresh = upsert(target, staged, ["k"], unique=True, words=filter_words(500, 1 << 20))
    moved, brought, stay = re.split(r"\n   [:+]- ", plan_of(fresh).split("== Physical Plan ==")[1])[1:]
    dealt = "Exchange hashpartitioning(k#"
    # what is ruled out meets the broadcast filter only; by key goes what passed it, and the staged keys
    assert dealt not in stay and "BroadcastHashJoin [word#" in stay and "Filter NOT coalesce" in stay
    assert moved.count(dealt) == 2 and "LeftAnti" in moved and dealt not in brought
    passed = moved.split(dealt)[1]
    assert "Filter coalesce" in passed and "BroadcastHashJoin [word#" in passed


def test_a_large_batch_is_filtered_on_disk(spark, store, monkeypatch):
    seen = []
    monkeypatch.setattr(flow, "filter_words", lambda keys, limit: seen.append(filter_words(keys, limit)) or seen[-1])
    schema = "k int, d date, g string, v int"
    put = lambda batch, data: upsert_all(store, [FREE], batch, lambda _: spark.createDataFrame(data, schema), broadcast_limit=0)
    put("b1", [(i, date(2024, 1, 1), "a", i) for i in range(200)])
    put("b2", [(i, date(2024, 2, 1), "b", -i) for i in range(150, 250)])
    assert seen == [50, 25]
    assert {r.k: r.v for r in store.read(FREE).collect()} == {i: i if i < 150 else -i for i in range(250)}
    monkeypatch.setattr(flow, "FILTER_LIMIT", 0)
    put("b3", [(0, None, None, None)])
    assert store.read(FREE).where("v IS NULL").count() == 1 and seen[-1] == 0


# --- refresh by what a batch has moved

def moved(store, report, spec):
    got = rows(report.read(store.spark))
    want = rows(period_summary(store.read(spec).where(f"{report.day} IS NOT NULL"), report.day, report.grain, MEASURES, report.by))
    assert got == want
    return got


@pytest.mark.parametrize("spec, by", [(DATED, ()), (FREE, ("g",))])
def test_a_delta_refresh_equals_a_rebuild(spark, tmp_path, store, spec, by):
    rng = random.Random(3)
    report = Report(spec, "d", "month", MEASURES, str(tmp_path / "report"), by)
    first = date(2024, 1, 1)

    def some(n, upto):
        found = {}
        for _ in range(n):
            row = {"k": rng.randrange(300), "d": first + timedelta(days=rng.randrange(upto)), "g": rng.choice(["a", "b", None]),
                   "v": rng.choice([None, rng.randrange(100)])}
            found[tuple(row[c] for c in spec.key)] = tuple(row[c.name] for c in spec.columns)
        return list(found.values())

    send(store, spec, "b0", some(200, 200))
    report.rebuild(store)
    moved(store, report, spec)
    for n in range(1, 3):
        send(store, spec, f"b{n}", some(30, 100 * n))
        report.refresh(store, f"b{n}")
        assert moved(store, report, spec)
        report.refresh(store, f"b{n}")  # it holds the batch already
        moved(store, report, spec)


def test_a_report_from_nothing_and_emptied_periods(spark, tmp_path, store):
    report = Report(FREE, "d", "month", MEASURES, str(tmp_path / "report"))
    assert report.read(spark).count() == 0
    send(store, FREE, "b1", [(1, date(2024, 1, 5), "a", 10), (2, None, "a", 5)])
    report.refresh(store, "b1")
    send(store, FREE, "b2", [(1, date(2024, 3, 5), "a", None), (2, date(2024, 3, 6), None, 7)])
    report.refresh(store, "b2")
    assert rows(report.read(spark)) == [(date(2024, 3, 1), 2, 7, 7.0, 7, 7)]
    with pytest.raises(ValueError):
        Report(FREE, "d", "month", {"x": ("median", "v")}, "p")


def test_a_refresh_that_broke_off_counts_once(spark, tmp_path, store, monkeypatch):
    report = Report(FREE, "d", "year", MEASURES, str(tmp_path / "report"))
    send(store, FREE, "b1", [(i, date(2024, 1, 5), "a", i) for i in range(10)])
    report.rebuild(store)
    send(store, FREE, "b2", [(i, date(2024, 1, 5), "a", 2 * i) for i in range(5, 15)])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # the figures are in the state, the batch is not noted
        mark = refreshing.mark_ready
        patch.setattr(refreshing, "mark_ready", lambda spark, path: lost() if "/done/" in path else mark(spark, path))
        with pytest.raises(RuntimeError):
            report.refresh(store, "b2")
    report.refresh(store, "b2")
    moved(store, report, FREE)


def test_a_sum_is_refreshed_without_the_table(spark, tmp_path, store, monkeypatch):
    report = Report(FREE, "d", "month", {"n": ("count", "k"), "total": ("sum", "v")}, str(tmp_path / "report"))
    send(store, FREE, "b1", [(i, date(2024, 1 + i % 12, 5), "a", i) for i in range(100)])
    report.rebuild(store)
    send(store, FREE, "b2", [(5, date(2024, 3, 5), "a", 50)])
    monkeypatch.setattr(TableStore, "read", None)
    changes = report.changes(store, "b2")
    assert all("/moves/free/b2/" in file or "/report/state/" in file for file in changes.inputFiles())
    assert "PartitionFilters: [period#" in plan_of(changes) and "IN (2024-03-01,2024-06-01)" in plan_of(changes)
    report.refresh(store, "b2")


def test_the_load_ends_in_a_refresh(spark, tmp_path, store):
    headers = [DATE_HEADER, "Gesamt \nTonage"]
    report = Report(OVERVIEW, "date", "month", {"tons": ("sum", "tonage")}, str(tmp_path / "report"))

    def save(name, *data):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_bytes(render_workbook([["T"], headers, *data]))

    save("a.xlsx", [date(2024, 1, 5), 12], [date(2024, 1, 6), 3], [date(2024, 2, 6), 1])
    run = lambda: ingest_stream(file_stream(spark, str(tmp_path / "in")), store, [OVERVIEW], str(tmp_path / "cp"),
                                DATE_HEADER, reports=[report]).awaitTermination()
    run()
    assert rows(report.read(spark)) == [(date(2024, 1, 1), 15), (date(2024, 2, 1), 1)]
    save("b.xlsx", [date(2024, 1, 6), 5])
    run()
    assert rows(report.read(spark)) == [(date(2024, 1, 1), 17), (date(2024, 2, 1), 1)]


def test_a_reader_outlives_the_next_snapshot(spark, tmp_path):
    root = str(tmp_path / "reports")
    make = lambda v: spark.sql(f"SELECT DATE'2024-01-05' AS d, {v} AS v")
    refresh_snapshot(make(1), "d", "month", {"v": ("sum", "v")}, root, "swapped")
    began = spark.table("swapped")
    refresh_snapshot(make(2), "d", "month", {"v": ("sum", "v")}, root, "swapped")
    assert began.first().v == 1 and spark.table("swapped").first().v == 2
    refresh_snapshot(make(3), "d", "month", {"v": ("sum", "v")}, root, "swapped")
    assert spark.table("swapped").first().v == 3 and len(os.listdir(root)) == 2


# --- checksum-first diff

def test_diff_reads_unequal_folders_only(spark, tmp_path):
    before, after = (TableStore(spark, str(tmp_path / name)) for name in ("before", "after"))
    data = [(date(2024, m, 1), k, "g", None if k == 1 else k) for m in range(1, 7) for k in range(5)]
    for store in (before, after):
        send(store, DATED, "b1", data)
    assert changed_folders(before, after, DATED) == [] and stored_diff(before, after, DATED, changes_only=True).count() == 0
    # a NULL that moves from one column to another, and a new month
    send(after, DATED, "b2", [(date(2024, 2, 1), 1, None, 1), (date(2024, 2, 1), 2, "g", 2), (date(2024, 9, 1), 0, "g", 0)])
    assert changed_folders(before, after, DATED) == ["part_period=2024-02-01", "part_period=2024-09-01"]
    changes = stored_diff(before, after, DATED, changes_only=True)
    assert rows(changes) == [(date(2024, 2, 1), 1, "updated"), (date(2024, 9, 1), 0, "inserted")]
    plan = plan_of(changes)
    assert plan.count("PartitionFilters: [part_period#") + plan.count("PartitionFilters: [isnotnull(part_period") >= 2
    assert rows(stored_diff(before, after, DATED)) == rows(row_diff(before.read(DATED), after.read(DATED), list(DATED.key)))


def test_checks_follow_the_rows(spark, store):
    send(store, DATED, "b1", [(date(2024, 1, 1), 1, "a", 1), (date(2024, 2, 1), 1, "a", 1)])
    one = {r.part_period: (r.rows, r.digest) for r in store.checks(DATED).collect()}
    send(store, DATED, "b2", [(date(2024, 2, 1), 1, "a", 2), (date(2024, 2, 1), 2, "a", 2)])
    two = {r.part_period: (r.rows, r.digest) for r in store.checks(DATED).collect()}
    assert one[date(2024, 1, 1)] == two[date(2024, 1, 1)] and two[date(2024, 2, 1)][0] == 2 and one != two


# --- footers, buckets

def test_counts_and_days_come_from_footers(spark, store):
    send(store, DATED, "b1", [(date(2024, 1, 1) + timedelta(days=i), 1, "a", i) for i in range(90)])
    figures = stored_figures(store, DATED, "d")
    assert "PushedAggregation: [COUNT(*), MIN(d), MAX(d)]" in plan_of(figures).replace("CountStar", "COUNT(*)")
    assert rows(figures) == [(90, date(2024, 1, 1), date(2024, 3, 30))] and newest_day(store, DATED, "d") == date(2024, 3, 30)
    assert newest_day(store, FREE, "d") is None
    path = store.data_path(DATED)
    assert "PushedAggregation: []" in plan_of(from_footers(spark, path, DATED.stored_schema, F.max("g")))  # text is read
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_bucketed_tables_meet_without_exchange(spark, tmp_path, shuffled_joins):
    left, right = (write_bucketed(spark.range(n).select((F.col("id") % 500).alias("k"), F.col("id").alias(v)), f"bucketed_{v}",
                                  str(tmp_path / v), ["k"], 4) for n, v in ((500, "a"), (5000, "b")))
    joined = left.join(right.groupBy("k").agg(F.sum("b").alias("b")), "k")
    replaced = upsert(left, right.groupBy("k").agg(F.max("b").alias("a")).where("k < 100"), ["k"], unique=True)
    for found in (joined, replaced):
        assert "Exchange" not in plan_of(found).split("== Physical Plan ==")[1] and "SortMergeJoin" in plan_of(found)
    assert joined.count() == 500 and replaced.where("a >= 4500").count() == 100
    spark.sql("DROP TABLE bucketed_a")
    spark.sql("DROP TABLE bucketed_b")


# --- files sent again, long sheets

def test_a_file_sent_again_is_not_decoded(spark, tmp_path, store):
    headers = [DATE_HEADER, "Gesamt \nTonage"]
    folder = tmp_path / "in"
    folder.mkdir()
    book = render_workbook([["T"], headers, [date(2024, 1, 5), 12]])
    (folder / "a.xlsx").write_bytes(book)
    (folder / "a copy.xlsx").write_bytes(book)
    read = lambda: spark.read.format("binaryFile").schema(FILE_COLUMNS).option("pathGlobFilter", WORKBOOK_GLOB).load(str(folder))
    assert ingest_files(store, read(), [OVERVIEW], "b1", DATE_HEADER).first().sheet_rows == 1
    (folder / "b.xlsx").write_bytes(render_workbook([["T"], headers, [date(2024, 1, 5), 13], [date(2024, 1, 6), 1]]))
    (folder / "c.xlsx").write_bytes(book)
    assert ingest_files(store, read(), [OVERVIEW], "b2", DATE_HEADER).first().sheet_rows == 2
    again = ingest_files(store, read(), [OVERVIEW], "b3", DATE_HEADER).first()
    assert (again.sheet_rows, again.status) == (0, "skipped") and again.table_after == 2
    assert sorted(r.tonage for r in store.read(OVERVIEW).collect()) == [1, 13]
    assert rows(ingest_files(store, read(), [OVERVIEW], "b2", DATE_HEADER))[0][:4] == (1, "overview", "Overview", "applied")
    assert store.read(OVERVIEW).count() == 2


def test_files_of_a_batch_that_broke_off_are_taken_again(spark, tmp_path, store, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.xlsx").write_bytes(render_workbook([["T"], [DATE_HEADER, "Gesamt \nTonage"], [date(2024, 1, 5), 12]]))
    files = spark.read.format("binaryFile").load(str(folder))

    def lost(*_, **__):
        raise RuntimeError("lost")

    for step in ("stage_sheet", "merge_table", "audit"):
        with monkeypatch.context() as patch:
            patch.setattr(flow, step, lost)
            with pytest.raises(RuntimeError):
                ingest_files(store, files, [OVERVIEW], "b1", DATE_HEADER)
    assert ingest_files(store, files, [OVERVIEW], "b1", DATE_HEADER).first().inserted == 1
    assert (flow.WHOLE_BATCH, "files") in finished_steps(store, "b1")
    other = replace(store, batches=str(tmp_path / "elsewhere"))
    assert ingest_files(other, files, [OVERVIEW], "b9", DATE_HEADER).first().sheet_rows == 0


LONG_SHEET = """
import io, resource, sys, zipfile
sys.path.insert(0, {repo!r})
import pyarrow as pa
from daybook.plans.sheets import render_workbook
from daybook.sources import workbook
small = zipfile.ZipFile(io.BytesIO(render_workbook([["T"], ["A", "B"], [1, 2]])))
out = io.BytesIO()
with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
    for name in small.namelist():
        if "sheet1" not in name:
            book.writestr(name, small.read(name))
    with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as part:
        part.write(small.read("xl/worksheets/sheet1.xml").split(b"</sheetData>")[0])
        for _ in range(1000):
            part.write(b"<row><c><v>1</v></c><c><v>2</v></c></row>" * 1000)
        part.write(b"</sheetData></worksheet>" if {whole} else b"</sheet")
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = 0
try:
    held, more = workbook._held(pa.scalar("p"), pa.scalar(None, pa.timestamp("us")), out.getvalue(), 1)
    found = sum(batch.num_rows for batch in held)
    if more:
        rest = workbook._sheet_batches(pa.scalar("p"), pa.scalar(None, pa.timestamp("us")), out.getvalue(), 1)
        found += sum(b.num_rows for i, b in enumerate(rest) if i >= len(held))
except Exception as broken:
    print("broken", type(broken).__name__)
print("rows", found, "megabytes", (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("whole", [True, False])
def test_a_sheet_of_a_million_rows_is_not_held(whole):
    script = LONG_SHEET.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), whole=whole)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    words = done.stdout.split()
    assert words, done.stderr[-2000:]
    if whole:
        assert words[:2] == ["rows", "1000001"]
    else:
        assert words[:4] == ["broken", "ParseError", "rows", "0"]
    assert int(words[-1]) < 150
