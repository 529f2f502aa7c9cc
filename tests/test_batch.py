import json
import shutil
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daybook.operators.kpi import date_range, last_n_days, period_summary
from daybook.operators.upsert import changed_days as changed_in
from daybook.operators.upsert import upsert
from daybook.plans import batch as flow
from daybook.plans.batch import (
    ConflictingRows, MissingParent, UnknownParent, audit, changed_days, ingest_batch, quarantine_path, upsert_all)
from daybook.plans.refresh import refresh_incremental, refresh_view
from daybook.plans.sheets import render_workbook
from daybook.sources import TableStore, create_table_ddl, ensure_table, read_workbooks, unread_files, workbook_stream
from daybook.sources.cells import header_names
from daybook.sources.tables import folder_checks, subfolders
from daybook.specs import DATE_HEADER, FLEET, OVERVIEW, PLANT_TABLES, Buckets, ColumnSpec, ParentRef, Periods, TableSpec
from daybook.streaming import ingest_stream

HEADERS = [DATE_HEADER, "Gesamt \nTonage", "Gefahrene Km", "Takte", "Takte"]
PARENT = TableSpec("parent", (ColumnSpec("k", "int", "K"), ColumnSpec("v", "string", "V")), ("k",), Buckets(("k",), 4))
CHILD = TableSpec("child", (ColumnSpec("k", "int", "K"), ColumnSpec("w", "int", "W")), ("k",), Buckets(("k",), 4),
                  ParentRef("parent", (("k", "k"),)))


def save(folder, name, *rows, headers=HEADERS):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(render_workbook([["Titel"], headers, *rows]))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def frames(spark, parent, child=()):
    data = {"parent": spark.createDataFrame(list(parent), "k int, v string"),
            "child": spark.createDataFrame(list(child), "k int, w int")}
    return lambda spec: data[spec.name]


def test_workbooks(spark, tmp_path):
    save(tmp_path / "in", "a b.xlsx", [date(2024, 1, 5), 12.5, 3, 1, 2], [None] * 5, ["Werte aus KW1", True, "x", "NaN"])
    save(tmp_path / "in", "c.xlsx", [datetime(2024, 1, 5, 12, 30), "1"], headers=["X", None, "Y"])
    (tmp_path / "in" / "notes.txt").write_text("no workbook")
    got = {(r.path.rsplit("/", 1)[1], r.row_no): r.cells for r in read_workbooks(spark, str(tmp_path / "in")).collect()}
    assert got == {
        ("a b.xlsx", 0): {DATE_HEADER: "2024-01-05 00:00:00", "Gesamt \nTonage": "12.5", "Gefahrene Km": "3",
                          "Takte": "1", "Takte.1": "2"},
        ("a b.xlsx", 1): {DATE_HEADER: None, "Gesamt \nTonage": None, "Gefahrene Km": None, "Takte": None,
                          "Takte.1": None},
        ("a b.xlsx", 2): {DATE_HEADER: "Werte aus KW1", "Gesamt \nTonage": "true", "Gefahrene Km": "x",
                          "Takte": None, "Takte.1": None},
        ("c.xlsx", 0): {"X": "2024-01-05 12:30:00", "Unnamed: 1": "1", "Y": None},
    }


def test_no_file_is_lost_in_silence(spark, tmp_path, store):
    save(tmp_path / "in", "a.XLSX", [date(2024, 1, 5), 1, 1, 1, 1])
    save(tmp_path / "in", "b.xlsm", [date(2024, 1, 6), 2, 2, 2, 2])
    save(tmp_path / "in", "c d.xlsx", [date(2024, 1, 7), 3, 3, 3, 3])
    (tmp_path / "in" / "cut.xlsx").write_bytes((tmp_path / "in" / "a.XLSX").read_bytes()[:200])
    (tmp_path / "in" / "none.xlsx").write_bytes(b"no archive")
    (tmp_path / "in" / "notes.txt").write_text("no workbook")
    raw = read_workbooks(spark, str(tmp_path / "in"))
    assert sorted(r.path.rsplit("/", 1)[1] for r in raw.where("error IS NULL").collect()) == ["a.XLSX", "b.xlsm", "c d.xlsx"]
    left = {r.path.rsplit("/", 1)[1]: r.reason for r in unread_files(spark, str(tmp_path / "in"), raw).collect()}
    assert set(left) == {"cut.xlsx", "none.xlsx", "notes.txt"} and "BadZipFile" in left["none.xlsx"]
    assert read_workbooks(spark, str(tmp_path / "in" / "c%20d.xlsx"), encoded=True).count() == 1
    ingest_batch(store, raw, [OVERVIEW], "b1", DATE_HEADER)
    assert sorted(r.tonage for r in store.read(OVERVIEW).collect()) == [1, 2, 3]
    lost = spark.read.parquet(quarantine_path(store, "b1")).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in lost) == ["cut.xlsx", "none.xlsx"]


def test_header_names():
    assert header_names({0: "x", 1: "x", 2: "x.1", 3: "x", 5: "y"}, 6) == [
        "x", "x.1", "x.1.1", "x.2", "Unnamed: 4", "y"]


def test_ensure_table_twice_and_ddl(spark, tmp_path, store):
    path = str(tmp_path / "t")
    ensure_table(spark, FLEET, path)
    FLEET.with_layout(spark.sql("SELECT DATE'2024-01-01' AS date, 1D AS driving_hours, 2D AS kg_per_hour_driving, "
                                "3 AS km_driven")).write.mode("append").partitionBy("part_period").parquet(path)
    ensure_table(spark, FLEET, path)
    assert spark.read.schema(FLEET.stored_schema).parquet(path).count() == 1
    spark.sql(create_table_ddl(FLEET, path))
    spark.sql(create_table_ddl(FLEET, path))
    assert spark.table("fleet").columns == FLEET.stored_schema.names
    spark.sql("DROP TABLE fleet")


def test_upsert_all_and_audit(spark, store):
    first = upsert_all(store, [PARENT, CHILD], "b1", frames(spark, [(1, "a"), (2, "b"), (2, "b"), (None, "z")]))
    assert [(r.table_name, r.status, r.affected, r.inserted, r.updated) for r in first.orderBy("position").collect()] == [
        ("parent", "applied", 2, 2, 0), ("child", "skipped", 0, 0, 0)]
    second = upsert_all(store, [PARENT, CHILD], "b2", frames(spark, [(2, None), (3, "c")], [(3, 1)]))
    assert [(r.table_name, r.status, r.affected, r.inserted, r.updated) for r in second.orderBy("position").collect()] == [
        ("parent", "applied", 2, 1, 1), ("child", "applied", 1, 1, 0)]
    assert rows(store.read(PARENT)) == [(1, "a"), (2, None), (3, "c")]
    assert store.staged(PARENT, "b2").count() == 0
    store.register_views(PARENT, CHILD)
    assert spark.sql("SELECT v, w FROM parent JOIN child USING (k)").collect()[0] == ("c", 1)


def test_large_key_sets_are_joined_by_shuffle(spark, store):
    upsert_all(store, [PARENT], "b1", frames(spark, [(i, "a") for i in range(50)]), broadcast_limit=0)
    upsert_all(store, [PARENT], "b2", frames(spark, [(i, "b") for i in range(25, 75)]), broadcast_limit=0)
    assert rows(store.read(PARENT)) == rows(spark.createDataFrame(
        [(i, "a" if i < 25 else "b") for i in range(75)], "k int, v string"))


def test_conflicts(spark, store):
    with pytest.raises(ConflictingRows):
        upsert_all(store, [PARENT], "b1", frames(spark, [(1, "a"), (1, "b")]))
    assert store.read(PARENT).count() == 0
    sent = {"parent": spark.createDataFrame([(1, "z", 1), (1, "a", 2)], "k int, v string, at int")}
    with pytest.raises(ValueError):
        upsert_all(store, [PARENT], "b1", lambda spec: sent[spec.name].drop("at"), on_conflict="latest")
    upsert_all(store, [PARENT], "b1", lambda spec: sent[spec.name], on_conflict="latest", order=["at"])
    assert rows(store.read(PARENT)) == [(1, "a")]


def test_missing_parent(spark, store):
    for limit in (0, flow.BROADCAST_LIMIT):
        with pytest.raises(MissingParent):
            upsert_all(store, [PARENT, CHILD], f"b{limit}", frames(spark, [(1, "a")], [(1, 1), (9, 9)]),
                       broadcast_limit=limit)
    assert rows(store.read(PARENT)) == [(1, "a")] and store.read(CHILD).count() == 0


def test_parents_outside_the_batch_and_in_the_wrong_order(spark, store):
    with pytest.raises(UnknownParent):
        upsert_all(store, [CHILD], "b1", frames(spark, [], [(1, 1)]))
    with pytest.raises(UnknownParent):
        upsert_all(store, [CHILD, PARENT], "b1", frames(spark, [(1, "a")], [(1, 1)]))
    upsert_all(store, [PARENT], "b1", frames(spark, [(1, "a")]))
    with pytest.raises(MissingParent):
        upsert_all(store, [CHILD], "b2", frames(spark, [], [(1, 1), (2, 2)]), stored=[PARENT])
    upsert_all(store, [CHILD], "b3", frames(spark, [], [(1, 1)]), stored=[PARENT])
    assert rows(store.read(CHILD)) == [(1, 1)]


def test_long_references_are_measured(spark, store, monkeypatch):
    named = TableSpec("named", (ColumnSpec("v", "string", "V"),), ("v",), Buckets(("v",), 2))
    child = TableSpec("child", (ColumnSpec("k", "int", "K"), ColumnSpec("v", "string", "V")), ("k",), Buckets(("k",), 2),
                      ParentRef("named", (("v", "v"),)))
    texts = [f"{i}" * 500 for i in range(10, 30)]
    data = {"named": spark.createDataFrame([(t,) for t in texts], "v string"),
            "child": spark.createDataFrame(list(enumerate(texts)), "k int, v string")}
    seen = []
    monkeypatch.setattr(flow.F, "broadcast", lambda df: seen.append(df.columns) or df)
    upsert_all(store, [named, child], "b1", lambda spec: data[spec.name], broadcast_limit=2000)
    assert ["v"] not in seen  # the keys of the child are small, its references are not
    assert store.read(child).count() == 20


def broken(*args, **kwargs):
    raise RuntimeError("lost")


BREAKS = ["stage_table", "merge_table", "note_moves", "merged", "mark_ready", "apply", "checks", "applied", "clear_batch"]


def break_off(patch, at):
    """A failure before the given step, before the given entry of the table of batches, or midway in the table."""
    if at == "apply":
        patch.setattr(TableStore, "apply", broken)
    elif at == "checks":
        put = TableStore.put
        patch.setattr(TableStore, "put", lambda self, df, spec, path: broken() if "/checks/" in path else put(self, df, spec, path))
    elif at in ("merged", "applied"):
        note = flow.note_step
        patch.setattr(flow, "note_step", lambda store, batch, **step:
                      broken() if step["step"] == at else note(store, batch, **step))
    else:
        patch.setattr(flow, at, broken)


@pytest.mark.parametrize("fails", BREAKS)
def test_a_batch_that_broke_off_goes_on(spark, store, monkeypatch, fails):
    upsert_all(store, [PARENT], "b1", frames(spark, [(1, "a"), (2, "b")]))
    send = frames(spark, [(2, "c"), (3, "d")])
    with monkeypatch.context() as patch:
        break_off(patch, fails)
        with pytest.raises(RuntimeError):
            upsert_all(store, [PARENT], "b2", send)
    again = upsert_all(store, [PARENT], "b2", send).first()
    assert (again.affected, again.inserted, again.updated) == (2, 1, 1)
    assert rows(store.read(PARENT)) == [(1, "a"), (2, "c"), (3, "d")]
    assert upsert_all(store, [PARENT], "b2", broken).first().affected == 2


@pytest.mark.parametrize("fails, streams", [*[(at, False) for at in BREAKS], *[(at, True) for at in ("merged", "apply", "checks")]])
def test_a_resumed_batch_undoes_no_later_one(spark, tmp_path, store, monkeypatch, fails, streams):
    first, second = (replace(store, batches=str(tmp_path / f"batches{i}")) if streams else store for i in range(2))
    one = TableSpec("parent", PARENT.columns, PARENT.key, Buckets(("k",), 1))
    upsert_all(first, [one], "b0", frames(spark, [(1, "a"), (9, "x")]))
    with monkeypatch.context() as patch:
        break_off(patch, fails)
        with pytest.raises(RuntimeError):
            upsert_all(first, [one], "b1", frames(spark, [(2, "b"), (9, "y")]))
    upsert_all(second, [one], "b2", frames(spark, [(3, "c")]))
    again = upsert_all(first, [one], "b1", frames(spark, [(2, "b"), (9, "y")])).first()
    assert (again.affected, again.inserted, again.updated) == (2, 1, 1)
    assert rows(store.read(one)) == [(1, "a"), (2, "b"), (3, "c"), (9, "y")]
    checks = [(r.rows, r.digest) for r in store.checks(one).collect()]
    assert checks == [(r.rows, r.digest) for r in folder_checks(store.read(one, with_layout=True), one).collect()]


def test_a_folder_lost_midway_comes_back(spark, tmp_path, store, monkeypatch):
    """A write that died between deleting a folder of the table and bringing its new one: the next writer mends it."""
    one = TableSpec("parent", PARENT.columns, PARENT.key, Buckets(("k",), 1))
    upsert_all(store, [one], "b0", frames(spark, [(1, "a"), (9, "x")]))
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "put", broken)
        with pytest.raises(RuntimeError):
            upsert_all(store, [one], "b1", frames(spark, [(2, "b")]))
    shutil.rmtree(tmp_path / "store/tables/parent/part_bucket=0")
    upsert_all(store, [one], "b2", frames(spark, [(3, "c")]))
    assert rows(store.read(one)) == [(1, "a"), (2, "b"), (3, "c"), (9, "x")]
    assert upsert_all(store, [one], "b1", broken).first().inserted == 1


def test_nothing_is_left_behind(spark, tmp_path, store):
    for n in range(3):
        audit_ = upsert_all(store, [PARENT], f"b{n}", frames(spark, [(i, str(n)) for i in range(40 + n)]))
    assert [(r.table_before, r.table_after) for r in audit_.collect()] == [(41, 42)]
    assert not list((tmp_path / "store/staging/parent").glob("*")) and not list((tmp_path / "store/merged/parent").glob("*"))
    assert {v for _, v in rows(store.read(PARENT))} == {"2"}


def test_tables_in_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS plant LOCATION '{tmp_path}/plant'")
    store = TableStore(spark, str(tmp_path / "store"), database="plant")
    dated = TableSpec("dated", (ColumnSpec("d", "date", "D"), ColumnSpec("v", "int", "V")), ("d",), Periods("d", "year"))
    send = lambda data: lambda _: spark.createDataFrame(data, "d date, v int")
    upsert_all(store, [dated], "b1", send([(date(2023, 1, 1), 1), (date(2024, 1, 1), 2)]))
    assert rows(spark.sql("SELECT d, v FROM plant.dated")) == [(date(2023, 1, 1), 1), (date(2024, 1, 1), 2)]
    upsert_all(store, [dated], "b2", send([(date(2024, 1, 1), 3), (date(2025, 1, 1), 4)]))
    assert rows(spark.table("plant.dated").select("v")) == [(1,), (3,), (4,)]
    assert len(spark.sql("SHOW PARTITIONS plant.dated").collect()) == 3
    assert "PartitionFilters: [isnotnull(part_period" in plan_of(spark.table("plant.dated").where("part_period = DATE'2024-01-01'"))
    spark.sql("DROP DATABASE plant CASCADE")


def test_days_of_a_batch_before_and_after(spark, store):
    dated = TableSpec("dated", (ColumnSpec("k", "int", "K"), ColumnSpec("d", "date", "D")), ("k",), Buckets(("k",), 2))
    send = lambda data: lambda _: spark.createDataFrame(data, "k int, d date")
    upsert_all(store, [dated], "b1", send([(1, date(2024, 1, 1)), (2, date(2024, 2, 1)), (3, None)]))
    upsert_all(store, [dated], "b2", send([(1, date(2024, 3, 1)), (3, date(2024, 4, 1))]))
    assert rows(changed_days(store, dated, "b2", "d")) == [(date(2024, m, 1),) for m in (1, 3, 4)]
    assert changed_days(store, dated, "none", "d").count() == 0


def test_ingest_batch_with_quarantine(spark, tmp_path, store):
    save(tmp_path / "in", "a.xlsx", [date(2024, 1, 5), 12.0, 3, 1, 2], [date(2024, 1, 5), 12.0, 3, 1, 2],
         ["Werte aus KW1 2024", 99.0, 9, 9, 9], ["01/06/2024", 13.0, "x", None, None])
    raw = read_workbooks(spark, str(tmp_path / "in"))
    result = ingest_batch(store, raw, PLANT_TABLES, "b1", DATE_HEADER)
    assert [(r.title, r.inserted) for r in result.orderBy("position").collect()] == [
        ("Overview", 2), ("Fleet", 2), ("Washing", 2), ("Drying", 2)]
    assert [(r.date, r.tonage) for r in store.read(OVERVIEW).orderBy("date").collect()] == [
        (date(2024, 1, 5), 12), (date(2024, 1, 6), 13)]
    assert [r.km_driven for r in store.read(FLEET).orderBy("date").collect()] == [3, None]
    lost = spark.read.parquet(quarantine_path(store, "b1")).collect()
    assert [(r.row_no, r.reason.split(", ")[0]) for r in lost] == [(2, "overview: key is null")]
    assert json.loads(lost[0].contents)["Gefahrene Km"] == "9"
    figures = result.filter("table_name = 'fleet'").first()
    assert (figures.sheet_rows, figures.valid_dates, figures.removed, figures.copies) == (4, 3, 1, 1)
    assert rows(ingest_batch(store, raw, PLANT_TABLES, "b1", DATE_HEADER)) == rows(audit(store, PLANT_TABLES, "b1"))


def test_stream_takes_each_file_once_and_corrections_win(spark, tmp_path, store):
    inbox, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")

    def run():
        stream = workbook_stream(spark, str(inbox), max_files=1)
        ingest_stream(stream, store, [OVERVIEW, FLEET], checkpoint, DATE_HEADER).awaitTermination()
        return {r.date.day: r.tonage for r in store.read(OVERVIEW).collect()}

    save(inbox, "a.xlsx", [date(2024, 1, 1), 1, 1, 1, 1], [date(2024, 1, 2), 2, 2, 2, 2])
    save(inbox, "b.xlsx", [date(2024, 1, 3), 3, 3, 3, 3])
    assert run() == {1: 1, 2: 2, 3: 3}
    save(inbox, "c.xlsx", [date(2024, 1, 1), None, 1, 1, 1], [date(2024, 1, 4), 4, 4, 4, 4])
    (inbox / "broken.xlsx").write_bytes(b"no archive")  # must not stop the stream
    assert run() == {1: None, 2: 2, 3: 3, 4: 4}
    assert run() == {1: None, 2: 2, 3: 3, 4: 4}


def test_incremental_refresh_equals_a_full_one(spark, tmp_path):
    layout = Periods("d", "year")
    old = spark.sql("SELECT explode(sequence(DATE'2022-12-20', DATE'2024-02-10', interval 1 day)) AS d, 1 AS v")
    new = old.withColumn("v", F.when(F.col("d").between("2022-12-28", "2023-01-03"), 5).otherwise(F.col("v")))
    changed = new.filter("v = 5")
    table = str(tmp_path / "t")
    new.withColumn("part_period", layout.expression()).write.partitionBy("part_period").parquet(table)
    for grain in ("week", "month", "quarter", "year"):
        path = str(tmp_path / grain)
        measures = {"v": ("sum", "v"), "n": ("count", "v")}
        refresh_view(old, "d", grain, measures, path)
        refresh_incremental(spark.read.parquet(table), changed, "d", grain, measures, path, layout=layout)
        report = spark.read.schema("v long, n long, period date").parquet(path)
        assert rows(report.select("period", "v", "n")) == rows(period_summary(new, "d", grain, measures))


def test_refresh_drops_emptied_periods(spark, tmp_path):
    old = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-05', 10), (2, DATE'2024-01-06', 20) AS t(k, d, v)")
    sent = spark.sql("SELECT * FROM VALUES (1, DATE'2024-02-05', 10), (2, DATE'2024-02-06', 20) AS t(k, d, v)")
    path = str(tmp_path / "report")
    refresh_view(old, "d", "month", {"v": ("sum", "v")}, path)
    refresh_incremental(upsert(old, sent, ["k"]), changed_in(old, sent, ["k"], "d"), "d", "month", {"v": ("sum", "v")}, path)
    assert rows(spark.read.schema("v long, period date").parquet(path)) == [(30, date(2024, 2, 1))]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_filters_reach_the_scan_and_prune_folders(spark, tmp_path):
    layout = Periods("d", "year")
    path = str(tmp_path / "t")
    df = spark.sql("SELECT explode(sequence(DATE'2022-12-20', DATE'2024-02-10', interval 1 day)) AS d, 1 AS v, 2 AS w")
    df.withColumn("part_period", layout.expression()).write.partitionBy("part_period").parquet(path)
    table = spark.read.parquet(path)
    ranged = date_range(table, "d", date(2023, 3, 1), date(2023, 3, 5), layout).select("d", "v")
    newest = last_n_days(table, "d", 5, layout=layout).select("d", "v")
    for kept in (ranged, newest):
        assert kept.count() == 5
        plan = plan_of(kept)
        assert "PartitionFilters: [isnotnull(part_period" in plan and "ReadSchema: struct<d:date,v:int>" in plan
    assert "GreaterThanOrEqual(d,2023-03-01)" in plan_of(ranged)


def test_a_small_batch_does_not_shuffle_the_table(spark, store):
    upsert_all(store, [PARENT], "b1", frames(spark, [(i, "a") for i in range(100)]))
    staged = PARENT.with_layout(spark.createDataFrame([(5, "b")], "k int, v string"))
    store.write(staged, PARENT, store.staging_path(PARENT, "b2"))
    staged = store.staged(PARENT, "b2")
    folder = subfolders(spark, store.staging_path(PARENT, "b2"))
    inside = flow.touched_part(store, PARENT, folder)
    plan = plan_of(flow.upsert(inside, staged, PARENT.key, broadcast_keys=True, unique=True))
    table_side = plan[plan.index("== Physical Plan =="):].split("Union")[1]
    assert "LeftAnti, BuildRight" in table_side and "SortMergeJoin" not in table_side
    assert len(folder) == 1 and "PartitionFilters: [isnotnull(part_bucket" in plan
