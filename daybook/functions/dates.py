"""Dates out of mixed text, and calendar periods of dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three accepted written forms. Calendar months count from 0.
ISO_START = r"^\s*\d{4}-\d{2}-\d{2}"
SLASH_DATE = r"^\d{2}/\d{2}/\d{4}$"
CALENDAR_YEAR = r"YEAR=(\d{4})"
CALENDAR_MONTH = r"MONTH=(\d+)"
CALENDAR_DAY = r"DAY_OF_MONTH=(\d+)"

GRAINS = {"week": "WEEK", "month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}


def calendar_text_date(text: Column) -> Column:
    """Date held in the printed form of a calendar object (``YEAR=..,MONTH=..,DAY_OF_MONTH=..``)."""
    month = F.regexp_extract(text, CALENDAR_MONTH, 1).try_cast("int") + 1
    return F.concat(
        F.regexp_extract(text, CALENDAR_YEAR, 1),
        F.lit("-"), F.lpad(month.cast("string"), 2, "0"),
        F.lit("-"), F.lpad(F.regexp_extract(text, CALENDAR_DAY, 1), 2, "0"),
    ).try_cast("date")


def slash_text_date(text: Column) -> Column:
    """Date out of ``MM/dd/yyyy``."""
    return F.concat(text.substr(7, 4), F.lit("-"), text.substr(1, 2), F.lit("-"), text.substr(4, 2)).try_cast("date")


def parse_mixed_date(text: Column) -> Column:
    """ISO date or datetime, ``MM/dd/yyyy`` or calendar text, told apart by pattern. Anything else is NULL.

    Every form ends in a cast of ISO text: a failed cast costs nothing, a failed formatted parse throws per
    row. The patterns also guard the cast, which by itself accepts text such as ``'2024'``.
    """
    return (F.when(text.rlike(ISO_START), text.try_cast("date"))
            .when(text.rlike(SLASH_DATE), slash_text_date(text))
            .when(text.rlike(CALENDAR_YEAR), calendar_text_date(text)))


def day_of(moment: Column) -> Column:
    """Calendar day of a date or timestamp."""
    return moment.cast("date")


def period_start(day: Column, grain: str) -> Column:
    """First day of the week (Monday), month, quarter or year of ``day``."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}, use one of {sorted(GRAINS)}")
    return F.trunc(day.cast("date"), GRAINS[grain])


def date_parts(day: Column) -> dict[str, Column]:
    """Year, quarter, month and ISO week of ``day``, by name."""
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "week": F.weekofyear(day),
    }
