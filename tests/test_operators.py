from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators.dedup import conflicting_keys, dedup_rows, latest_per_key
from daybook.operators.kpi import date_range, last_n_days, period_filter, trend_line
from daybook.operators.projection import conform, drop_null_key, fan_out, project, quarantine, to_raw, with_date
from daybook.operators.quality import coverage, fk_violations, pk_violations, row_flow, unusual_values, verify_columns
from daybook.operators.upsert import first_row, row_diff, summary_message, table_audit, upsert, upsert_stats
from daybook.specs import DATE_HEADER, DRYING, FLEET, OVERVIEW, PLANT_TABLES, Buckets, ColumnSpec, Periods, TableSpec


def kv(spark, rows):
    return spark.createDataFrame(rows, "k int, v int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


CASES = [
    ([(1, 10), (2, 20)], [(2, 21), (3, 30), (3, 30)], [(1, 10), (2, 21), (3, 30)], (2, 1, 1)),
    ([(1, 10)], [(1, None)], [(1, None)], (1, 0, 1)),
    ([(1, 10)], [(1, 10)], [(1, 10)], (1, 0, 1)),
    ([(1, 10)], [], [(1, 10)], (0, 0, 0)),
    ([], [(1, 10)], [(1, 10)], (1, 1, 0)),
]


@pytest.mark.parametrize("target,staged,result,counts", CASES)
@pytest.mark.parametrize("broadcast_keys", [False, True])
def test_upsert(spark, target, staged, result, counts, broadcast_keys):
    t, s = kv(spark, target), kv(spark, staged)
    assert rows(upsert(t, s, ["k"], broadcast_keys)) == result
    assert tuple(upsert_stats(t, s, ["k"]).first()) == counts


pairs = st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 5))), max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=pairs, staged=pairs)
def test_upsert_against_a_dictionary(spark, target, staged):
    target, staged = dict(target), dict(staged)
    t, s = kv(spark, list(target.items())), kv(spark, list(staged.items()))
    once = upsert(t, s, ["k"])
    assert dict(rows(once)) == {**target, **staged}
    assert rows(upsert(once, s, ["k"])) == rows(once)
    stats = upsert_stats(t, s, ["k"]).first()
    assert (stats.affected, stats.updated) == (len(staged), len(target.keys() & staged.keys()))


def test_row_diff(spark):
    before, after = kv(spark, [(1, 1), (2, 2), (3, None), (4, 4)]), kv(spark, [(1, 1), (2, 3), (3, None), (5, 5)])
    assert rows(row_diff(before, after, ["k"])) == [
        (1, "unchanged"), (2, "updated"), (3, "unchanged"), (4, "deleted"), (5, "inserted")]


def test_first_row_and_audit(spark):
    t = kv(spark, [(2, 1), (1, 5), (1, 4)])
    assert tuple(first_row(t, "k", "v").first()) == (1, 4)
    audit = table_audit({"a": {"before": t, "after": t.union(t), "staged": t, "staged_after": t.limit(0)}}).first()
    assert audit.asDict() == {"table_name": "a", "before": 3, "after": 6, "staged": 3, "staged_after": 0, "change": 3,
                              "staging_cleared": True}
    counts = spark.createDataFrame([(2, "Fleet", 3), (1, "Overview", 4)], "position int, title string, affected long")
    assert tuple(summary_message(counts).first()) == ("Upsert completed: Overview=4, Fleet=3 rows", 7)


def test_conflicts_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (2, 1, "a"), (2, 2, "b"), (3, 1, None)],
                               "k int, o int, v string")
    assert rows(conflicting_keys(df, ["k"])) == [(2, 2)]
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 1, "a"), (2, 2, "b"), (3, 1, None)]


def test_dedup_rows_of_sheets(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1", "y": None}), ("a", 2, {"y": None, "x": "1"}),
                                ("b", 3, {"x": "1", "y": None}), ("a", 4, {"x": "2"})],
                               "path string, row_no int, cells map<string,string>")
    assert [(r.path, r.row_no) for r in dedup_rows(df).orderBy("row_no").collect()] == [("a", 1), ("b", 3), ("a", 4)]


def sheet(spark):
    data = [("01/02/2024", "12.0", "3,5", "7"), ("2024-01-03 00:00:00", "x", "2.5", "8"), ("KW 1", "1", "1", "1"),
            ("01/02/2024", "12.0", "3,5", "7")]
    df = spark.createDataFrame(data, "a string, b string, c string, d string")
    return df.toDF("Datum", "Gefahrene Km", "Stunden\nFuhrpark / Verlader", "Takte")


def test_fan_out_of_a_wide_sheet(spark):
    tables = fan_out(with_date(sheet(spark), DATE_HEADER), PLANT_TABLES)
    assert list(tables) == ["overview", "fleet", "washing_machines", "drying"]
    assert rows(tables["fleet"]) == [(date(2024, 1, 2), None, None, 12), (date(2024, 1, 3), 2.5, None, None)]
    drying = tables["drying"].orderBy("date").first()
    assert (drying.steps_total, drying.steps, drying.kipper) == (7, 7, None)
    assert tables["overview"].schema == OVERVIEW.schema


def test_cells_map_gives_the_same_as_a_wide_sheet(spark):
    wide = sheet(spark)
    cells = F.create_map(*[x for c in wide.columns for x in (F.lit(c), F.col(f"`{c}`"))])
    raw = wide.select(cells.alias("cells"))
    for spec in PLANT_TABLES:
        assert rows(project(with_date(raw, DATE_HEADER), spec)) == rows(project(with_date(wide, DATE_HEADER), spec))


def test_names_with_dots_and_quarantine(spark):
    spec = TableSpec("t", (ColumnSpec("k", "int", "Takte.1"), ColumnSpec("v", "string", "a`b")), ("k",),
                     Buckets(("k",), 2))
    df = to_raw(spark.createDataFrame([(1, "x"), (None, "y")], "a int, b string").toDF("Takte.1", "a`b"))
    typed = project(df, spec)
    assert rows(drop_null_key(typed, "k")) == [(1, "x")]
    assert rows(quarantine(typed, "k")) == [(None, "y", "k is null")]


def test_conform(spark):
    df = spark.createDataFrame([(1.25, date(2024, 1, 1), "x")], "driving_hours double, date date, other string")
    out = conform(df, FLEET)
    assert out.schema == FLEET.schema and rows(out) == [(date(2024, 1, 1), 1.25, None, None)]
    assert dict(conform(df, FLEET, single_precision=True).dtypes)["driving_hours"] == "float"


def test_spec_checks():
    column = ColumnSpec("k", "int", "K")
    with pytest.raises(ValueError):
        ColumnSpec("k", "decimal", "K")
    with pytest.raises(ValueError):
        TableSpec("t", (column, column), ("k",), Buckets(("k",), 2))
    with pytest.raises(ValueError):
        TableSpec("t", (column, ColumnSpec("d", "date", "D")), ("k",), Periods("d"))
    with pytest.raises(ValueError):
        TableSpec("t", (column,), ("x",), Buckets(("k",), 2))


def test_constraints(spark):
    df = kv(spark, [(1, 1), (1, 2), (2, 1), (None, 1)])
    assert rows(pk_violations(df, ["k"])) == [(1, 2, "repeated key"), (None, 1, "null key")]
    assert rows(fk_violations(df, kv(spark, [(2, 0), (2, 1)]), [("k", "k")])) == [(1, 2)]


def test_coverage_verify_and_flow(spark):
    raw = spark.createDataFrame([("a", {"Takte": "1"}), ("a", {"Kipper": None}), ("b", {"Takte": None})],
                                "path string, cells map<string,string>")
    found = {r.column_name: (r.found, r.workbooks) for r in coverage(raw, DRYING).collect()}
    assert (found["steps"], found["steps_total"], found["kipper"], found["roboter_1"]) == ((2, 2), (2, 2), (1, 2), (0, 2))
    checked = {r.column_name: (r.present, r.filled, r.total) for r in
               verify_columns(kv(spark, [(1, None), (2, 1)]), ["k", "v", "w"]).collect()}
    assert checked == {"k": (True, 2, 2), "v": (True, 1, 2), "w": (False, 0, 2)}
    flow = row_flow(with_date(sheet(spark), DATE_HEADER), FLEET).first()
    assert (flow.initial_rows, flow.kept_rows, flow.removed_rows, flow.deduped_rows) == (4, 3, 1, 2)


def test_unusual_values(spark):
    series = spark.createDataFrame([(date(2024, 1, i + 1), float(v)) for i, v in enumerate([1, 2, 1, 2, 9, 2])],
                                   "day date, v double")
    assert [r.day for r in unusual_values(series, "day", "v", 3, 3.0).collect()] == [date(2024, 1, 5)]


def test_date_filters(spark):
    df = spark.sql("SELECT explode(sequence(DATE'2023-11-01', DATE'2024-04-10', interval 1 day)) AS d")
    def span(x):
        return x.agg(F.min("d"), F.max("d"), F.count("d")).first()
    assert span(date_range(df, "d", date(2024, 1, 5), date(2024, 1, 7))) == (date(2024, 1, 5), date(2024, 1, 7), 3)
    assert span(period_filter(df, "d", 2023, quarter=4)) == (date(2023, 11, 1), date(2023, 12, 31), 61)
    assert span(period_filter(df, "d", 2024, month=2)) == (date(2024, 2, 1), date(2024, 2, 29), 29)
    assert span(last_n_days(df, "d", 30)) == (date(2024, 3, 12), date(2024, 4, 10), 30)
    assert span(last_n_days(df, "d", 30, date(2024, 1, 30))) == (date(2024, 1, 1), date(2024, 1, 30), 30)


def test_trend_line_of_a_straight_line(spark):
    df = spark.sql("SELECT DATE'2024-01-01' + i AS day, 3 * i + 5 AS v FROM (SELECT explode(sequence(0, 9)) AS i)")
    for r in trend_line(df, "day", "v").collect():
        assert r.slope == pytest.approx(3) and r.fitted == pytest.approx(r.v)
