"""What the plans read, and guards."""

import math
import os
import subprocess
import sys
from datetime import date

import pytest
from pyspark.errors import PySparkException

from daybook.operators.kpi import daily_series, period_summaries, period_summary, trend_line
from daybook.operators.projection import fan_out, project, to_raw
from daybook.operators.quality import coverage, unusual_values
from daybook.operators.upsert import upsert
from daybook.queries import QUERIES
from daybook.session import drop_shared_folders, shared_folder, shared_folders
from daybook.specs import DATE_HEADER, DRYING, Buckets, ColumnSpec, TableSpec

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def scans(df):
    """Scans that a run of the frame made: only in what ran do they lead into rows, and a reused exchange has none."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("ColumnarToRow")


def table(name, *columns):
    return TableSpec(name, columns, (columns[0].name,), Buckets((columns[0].name,), 2))


def test_one_scan_for_a_trend(spark):
    series = daily_series(spark.read.parquet(ORDERS), "o_orderdate", {"n": ("count", "o_orderkey")})
    assert scans(trend_line(series, "day", "n")) == 1


def test_one_scan_for_three_grains(spark):
    orders = spark.read.parquet(ORDERS)
    measures = {"n": ("count", "o_orderkey"), "total": ("sum", "o_totalprice"), "mean": ("avg", "o_totalprice"),
                "low": ("min", "o_totalprice"), "high": ("max", "o_totalprice")}
    found = period_summaries(orders, "o_orderdate", ("week", "month", "year"), measures, ["o_orderstatus"])
    assert scans(found) == 1
    for grain in ("week", "month", "year"):
        got = {(r.period, r.o_orderstatus): r for r in found.filter(f"grain = '{grain}'").collect()}
        want = period_summary(orders, "o_orderdate", grain, measures, ["o_orderstatus"]).collect()
        assert len(got) == len(want)
        for r in want:
            own = got[r.period, r.o_orderstatus]
            assert own.n == r.n and all(math.isclose(own[m], r[m]) for m in ("total", "mean", "low", "high"))


def test_fan_out_computes_its_parent_once(spark):
    orders = spark.read.parquet(ORDERS)
    specs = [table("a", ColumnSpec("k", "bigint", "o_orderkey")), table("b", ColumnSpec("c", "bigint", "o_custkey"))]
    for frame in fan_out(orders, specs).values():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "orders.parquet" not in plan and "fan-out" in plan


def test_typed_sources(spark):
    nan, inf = float("nan"), float("inf")
    typed = spark.createDataFrame([(1, 12345678.0, 2.9), (2, -12345678.9, nan), (3, 1e12, inf), (4, None, None), (5, nan, -0.5)],
                                  "k long, x double, y double")
    spec = table("t", ColumnSpec("k", "int", "k"), ColumnSpec("i", "int", "x"), ColumnSpec("l", "bigint", "x"),
                 ColumnSpec("y", "double", "y"), ColumnSpec("s", "string", "x"))
    assert rows(project(typed, spec)) == [
        (1, 12345678, 12345678, 2.9, "12345678.0"), (2, -12345678, -12345678, None, "-12345678.9"),
        (3, None, 10**12, inf, "1000000000000.0"), (4, None, None, None, None), (5, None, None, -0.5, "NaN")]
    texts = to_raw(spark.createDataFrame([(3.0,), (1e7,), (1.25e-5,), (1e300,)], "v double"))
    assert sorted(r.v for r in texts.collect()) == ["0.0000125", "1.0E300", "10000000.0", "3.0"]


def test_upsert_conflicts(spark):
    kv = lambda data: spark.createDataFrame(data, "k int, v string")
    target, sent = kv([(1, "a")]), kv([(2, "z"), (2, "b"), (3, None), (3, None)])
    with pytest.raises(PySparkException):
        upsert(target, sent, ["k"]).collect()
    with pytest.raises(ValueError):
        upsert(target, sent, ["k"], on_conflict="latest")
    ordered = spark.createDataFrame([(2, "z", 1), (2, "b", 2), (1, None, 0)], "k int, v string, at int")
    assert rows(upsert(target, ordered, ["k"], on_conflict="latest", order=["at"])) == [(1, None), (2, "b")]


def test_coverage_counts_the_date_and_no_broken_book(spark):
    raw = spark.createDataFrame([("a", {DATE_HEADER: "x"}, None), ("b", {"Kipper": "1"}, None), ("c", {}, "broken")],
                                "path string, cells map<string,string>, error string")
    found = {r.column_name: (r.found, r.workbooks) for r in coverage(raw, DRYING, date_header=DATE_HEADER).collect()}
    assert found["date"] == (1, 2) and found["kipper"] == (1, 2) and found["steps"] == (0, 2)


def test_unusual_days_of_raw_rows(spark):
    values = [1, 2, 1, 2, 9, 2]
    raw = spark.createDataFrame([(date(2024, 1, i + 1), v / 4) for i, v in enumerate(values) for _ in range(4)], "day date, v double")
    assert [(r.day, r.v) for r in unusual_values(raw, "day", "v", 3, 3.0).collect()] == [(date(2024, 1, 5), 9.0)]


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, master):
            self.conf = {"spark.master": master}

    assert shared_folder(Session("local[4]"), "x") and shared_folder(Session("local"), "x")
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            shared_folder(Session(master), "x")


def test_shared_folders_can_be_dropped(spark):
    path, other = shared_folder(spark, "gone"), shared_folder(spark, "stays")
    for folder in (path, other):
        spark.range(3).write.parquet(folder)
    drop_shared_folders(spark, [path])
    assert not os.path.exists(path) and os.path.exists(other) and path not in shared_folders()
    drop_shared_folders(spark)
    assert not os.path.exists(other) and shared_folders() == []


HIDDEN = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name.split(".")[0] in {hidden!r} or name in {hidden!r}:
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hide())
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
print("queries", len(entry.queries()), len(entry.oracle_sql()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("hidden", [["xxhash"], ["public_tokenizers"], ["daybook.llm"], ["corpus_pipeline"],
                                    ["daybook.llm.common"], ["daybook.operators.kpi"]])
def test_the_entry_without_the_corpus_operators(hidden):
    """What only the corpus operators need may be absent; a part of the library itself may not."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(hidden=hidden, repo=repo)], capture_output=True, text=True, timeout=120)
    if hidden[0] in ("daybook.llm.common", "daybook.operators.kpi") and os.path.isdir(os.path.join(repo, "daybook", "llm")):
        assert "ModuleNotFoundError" in done.stderr and not done.stdout
    elif hidden[0] == "daybook.operators.kpi":
        assert "ModuleNotFoundError" in done.stderr
    else:
        words = done.stdout.split()
        assert words[0] == "queries" and int(words[1]) >= len(QUERIES), done.stderr[-2000:]
        assert words[3] == "False" and (hidden == ["corpus_pipeline"] or int(words[1]) == int(words[2]) == len(QUERIES))


def test_workers_get_the_package_from_the_archive(tmp_path):
    """A driver that has the package and workers that do not: started outside of the repository, without PYTHONPATH."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.append({repo!r})
from daybook.session import local_session, ship_package
from daybook.plans.sheets import order_workbooks
from daybook.sources import decode_workbooks
spark = local_session(2)
ship_package(spark)
orders = spark.read.parquet({ORDERS!r})
print("rows", decode_workbooks(order_workbooks(orders)).where("error IS NULL").count() > 1500)
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "rows True" in done.stdout, done.stderr[-2000:]
