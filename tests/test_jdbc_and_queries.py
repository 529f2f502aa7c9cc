"""Options of the database source and sink (no database is started), and the registry of queries."""

import os
from datetime import date

import pytest
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

import __spark_entry__ as entry
from daybook.queries import QUERIES, SQL
from daybook.sources import read_jdbc, write_jdbc_append

FOLDER = "/root/testdata/sf0.001"


def test_jdbc_append_options(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties:
                        seen.update(url=url, table=table, mode=mode, **properties))
    write_jdbc_append(spark.range(3), "jdbc:x", "overview_staging", {"user": "u"}, batch_size=500, connections=4)
    assert seen == {"url": "jdbc:x", "table": "overview_staging", "mode": "append", "batchsize": "500",
                    "numPartitions": "4", "user": "u"}


def test_jdbc_scan_options(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **options: seen.append(options))
    read_jdbc(spark, "jdbc:x", "t", "date", (date(2024, 1, 1), date(2024, 12, 31)), partitions=12)
    read_jdbc(spark, "jdbc:x", "t", predicates=["a < 1", "a >= 1"])
    read_jdbc(spark, "jdbc:x", "t", single_task=True)
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", "t")
    assert (seen[0]["column"], seen[0]["lowerBound"], seen[0]["numPartitions"]) == ("date", "2024-01-01", 12)
    assert seen[1]["predicates"] == ["a < 1", "a >= 1"] and set(seen[2]) == {"properties"}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", ["volume_per_day", "mapped_projection", "upsert_orders", "upsert_stats",
                                  "plant_drying", "dashboard_equipment_usage", "workbook_ingest", "row_flow"])
def test_queries_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    database = duckdb.connect()
    for table in ("orders", "lineitem"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = entry.queries()[name](spark, FOLDER)
    want = database.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    expected = database.sql(f"SELECT {', '.join(order)} FROM want").fetchall()
    assert sorted(map(repr, (tuple(r) for r in got.select(*order).collect()))) == sorted(map(repr, expected))
