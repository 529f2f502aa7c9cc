"""The questions of the plant dashboard on its four tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.kpi import clustered_series, daily_series, dual_series, kpi_cards, period_summary, trend_line

# Columns that must be filled before a table is charted.
KEY_COLUMNS = {
    "overview": ("date", "tonage", "water_m3", "kg_per_hour"),
    "fleet": ("date", "driving_hours", "km_driven"),
    "washing_machines": ("date", "steps_130kg", "steps_85kg_middle", "steps_85kg_right"),
    "drying": ("date", "steps_total"),
}
WASHING_STEPS = ("steps_130kg", "steps_85kg_middle", "steps_85kg_right")


def production_trend(overview: DataFrame) -> DataFrame:
    """Daily production volume with its trend line."""
    return trend_line(daily_series(overview, "date", {"tonage": ("sum", "tonage")}), "day", "tonage").orderBy("day")


def production_cards(overview: DataFrame) -> DataFrame:
    """Total production, mean efficiency (kg per hour) and total water."""
    return kpi_cards(overview, {
        "total_production": ("sum", "tonage"),
        "average_efficiency": ("avg", "kg_per_hour"),
        "total_water_m3": ("sum", "water_m3"),
    })


def fleet_utilization(fleet: DataFrame) -> DataFrame:
    """Daily driving hours (bars) and kilometres (line)."""
    return dual_series(fleet, "date", "driving_hours", "km_driven")


def washing_loads() -> Column:
    """All washing steps of a row; a machine without a value adds nothing."""
    return reduce(Column.__add__, [F.coalesce(F.col(c), F.lit(0)) for c in WASHING_STEPS])


def equipment_usage(washing_machines: DataFrame, drying: DataFrame, how: str = "inner") -> DataFrame:
    """Daily washing loads beside daily drying cycles."""
    washing = washing_machines.withColumn("washing_loads", washing_loads())
    return clustered_series(washing, "date", {"washing_loads": ("sum", "washing_loads")},
                            drying, "date", {"drying_cycles": ("sum", "steps_total")}, how)


def production_report(overview: DataFrame, grain: str) -> DataFrame:
    """Weekly or monthly summary of production and water."""
    return period_summary(overview, "date", grain, {
        "days": ("count", "date"), "production": ("sum", "tonage"), "water_m3": ("sum", "water_m3")})
