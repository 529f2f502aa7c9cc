"""The four plant tables and the dashboard on them, from a daily sheet derived from the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.projection import fan_out, with_date
from daybook.operators.quality import coverage, verify_columns
from daybook.plans.batch import ingest_batch
from daybook.plans.dashboard import (
    KEY_COLUMNS, WASHING_STEPS, equipment_usage, fleet_utilization, production_cards, production_report,
    production_trend)
from daybook.plans.sheets import plant_headers, plant_sheet
from daybook.queries.registry import load, query
from daybook.session import shared_folder
from daybook.sources.tables import TableStore
from daybook.specs import DATE_HEADER, DRYING, FLEET, OVERVIEW, PLANT_TABLES, WASHING_MACHINES, TableSpec

DAILY_SQL = """
    SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS c FROM lineitem GROUP BY 1
"""


def table_sql(spec: TableSpec) -> str:
    """The typed table that the derived sheet must give (see ``plans.sheets.plant_sheet``)."""
    position = {header: i for i, (header, _) in enumerate(plant_headers())}
    columns = []
    for c in spec.columns:
        if c.type == "date":
            columns.append(f"day AS {c.name}")
            continue
        i = position[c.source]
        value = (f"CAST((n * {i + 3} + q * {i + 1} + c) % 5000 AS INTEGER)" if c.type == "int"
                 else f"CAST((c * {i + 1} + q) % 100000 AS DOUBLE) / 100")
        columns.append(f"CASE WHEN (dayofyear(day) + {i}) % 11 > 2 THEN {value} END AS {c.name}")
    return f"SELECT {', '.join(columns)} FROM ({DAILY_SQL})"


def plant_tables(spark, folder, *specs: TableSpec) -> dict[str, DataFrame]:
    sheet = with_date(plant_sheet(load(spark, folder, "lineitem")), DATE_HEADER)
    return fan_out(sheet, specs)


@query(table_sql(OVERVIEW))
def plant_overview(spark, folder):
    return plant_tables(spark, folder, OVERVIEW)["overview"]


@query(table_sql(FLEET))
def plant_fleet(spark, folder):
    return plant_tables(spark, folder, FLEET)["fleet"]


@query(table_sql(WASHING_MACHINES))
def plant_washing_machines(spark, folder):
    return plant_tables(spark, folder, WASHING_MACHINES)["washing_machines"]


@query(table_sql(DRYING))
def plant_drying(spark, folder):
    return plant_tables(spark, folder, DRYING)["drying"]


@query(f"""
    SELECT position, table_name, title, 'applied' AS status, n + weeks AS sheet_rows, n AS valid_dates,
           weeks AS removed, CAST(0 AS BIGINT) AS copies, n AS staged, CAST(0 AS BIGINT) AS "before",
           n AS affected, n AS inserted, CAST(0 AS BIGINT) AS updated, n AS "after", CAST(0 AS BIGINT) AS table_before, n AS table_after
    FROM (VALUES (1, 'overview', 'Overview'), (2, 'fleet', 'Fleet'), (3, 'washing_machines', 'Washing'),
                 (4, 'drying', 'Drying')) AS t(position, table_name, title),
         (SELECT count(*) AS n FROM ({DAILY_SQL})),
         (SELECT count(*) AS weeks FROM (SELECT DISTINCT year(day), weekofyear(day) FROM ({DAILY_SQL})))
""")
def plant_ingest_audit(spark, folder):
    """The whole batch on disk: one read of the sheet, four tables staged and upserted, parents first."""
    store = TableStore(spark, shared_folder(spark, "plant"))
    return ingest_batch(store, plant_sheet(load(spark, folder, "lineitem")), PLANT_TABLES, "first", DATE_HEADER)


@query(f"""
    SELECT '{DRYING.name}' AS table_name, column_name, header, n AS found, n AS workbooks, FALSE AS incomplete
    FROM (VALUES {', '.join(f"('{c.name}', '{DATE_HEADER if c.type == 'date' else c.source}')" for c in DRYING.columns)})
             AS t(column_name, header),
         (SELECT count(DISTINCT year(l_shipdate)) AS n FROM lineitem)
""")
def plant_coverage(spark, folder):
    """Header coverage per yearly workbook; the parsed ``date`` is found under the sheet's date header."""
    return coverage(plant_sheet(load(spark, folder, "lineitem")), DRYING, date_header=DATE_HEADER)


@query(" UNION ALL ".join(f"""
    SELECT '{spec.name}' AS table_name, '{column}' AS column_name, TRUE AS present, count({column}) AS filled,
           count(*) AS total, round(count({column}) / count(*), 6) AS filled_share FROM ({table_sql(spec)})
""" for spec in PLANT_TABLES for column in KEY_COLUMNS[spec.name]))
def plant_key_columns(spark, folder):
    tables = plant_tables(spark, folder, *PLANT_TABLES)
    reports = [verify_columns(tables[name], columns).withColumn("table_name", F.lit(name))
               for name, columns in KEY_COLUMNS.items()]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


@query(f"""
    WITH s AS (SELECT date AS day, CAST(sum(tonage) AS BIGINT) AS tonage FROM ({table_sql(OVERVIEW)}) GROUP BY 1),
         f AS (SELECT regr_slope(tonage, day - DATE'1970-01-01') AS slope,
                      regr_intercept(tonage, day - DATE'1970-01-01') AS intercept FROM s)
    SELECT day, tonage, round(slope, 6) AS slope, round(intercept, 3) AS intercept,
           round(intercept + slope * (day - DATE'1970-01-01'), 3) AS fitted FROM s, f
""")
def dashboard_production_trend(spark, folder):
    return production_trend(plant_tables(spark, folder, OVERVIEW)["overview"]).withColumns({
        "slope": F.round("slope", 6), "intercept": F.round("intercept", 3), "fitted": F.round("fitted", 3)})


@query(f"""
    SELECT CAST(sum(tonage) AS BIGINT) AS total_production, round(avg(kg_per_hour), 4) AS average_efficiency,
           round(sum(water_m3), 2) AS total_water_m3 FROM ({table_sql(OVERVIEW)})
""")
def dashboard_production_cards(spark, folder):
    return production_cards(plant_tables(spark, folder, OVERVIEW)["overview"]).withColumns({
        "average_efficiency": F.round("average_efficiency", 4), "total_water_m3": F.round("total_water_m3", 2)})


@query(f"""
    SELECT date AS day, round(sum(driving_hours), 2) AS driving_hours, CAST(sum(km_driven) AS BIGINT) AS km_driven
    FROM ({table_sql(FLEET)}) GROUP BY 1
""")
def dashboard_fleet_utilization(spark, folder):
    return fleet_utilization(plant_tables(spark, folder, FLEET)["fleet"]).withColumn(
        "driving_hours", F.round("driving_hours", 2))


@query(f"""
    WITH w AS (SELECT date AS day, CAST(sum({' + '.join(f'coalesce({c}, 0)' for c in WASHING_STEPS)}) AS BIGINT)
                      AS washing_loads FROM ({table_sql(WASHING_MACHINES)}) GROUP BY 1),
         d AS (SELECT date AS day, CAST(sum(steps_total) AS BIGINT) AS drying_cycles
               FROM ({table_sql(DRYING)}) GROUP BY 1)
    SELECT day, washing_loads, drying_cycles FROM w JOIN d USING (day)
""")
def dashboard_equipment_usage(spark, folder):
    tables = plant_tables(spark, folder, WASHING_MACHINES, DRYING)
    return equipment_usage(tables["washing_machines"], tables["drying"])


@query(f"""
    SELECT CAST(date_trunc('week', date) AS DATE) AS period, count(*) AS days,
           CAST(sum(tonage) AS BIGINT) AS production, round(sum(water_m3), 2) AS water_m3
    FROM ({table_sql(OVERVIEW)}) GROUP BY 1
""")
def dashboard_weekly_report(spark, folder):
    return production_report(plant_tables(spark, folder, OVERVIEW)["overview"], "week").withColumn(
        "water_m3", F.round("water_m3", 2))
