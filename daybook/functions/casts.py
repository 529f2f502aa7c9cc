"""Casts of spreadsheet text that give NULL instead of raising, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.dates import parse_mixed_date

# A plain number with an optional fraction: no exponent, no type suffix, no grouping.
PLAIN_NUMBER = r"^\s*([+-]?)(\d+(?:\.\d*)?|\.\d+)\s*$"
WHOLE_PART = r"^\s*[+-]?(\d*)"
# Whole numbers short enough for 32 and 64 bit. A failed cast throws inside, so it is only tried on fitting text.
SHORT_INT = r"^\s*[+-]?\d{1,9}\s*$"
SHORT_BIGINT = r"^\s*[+-]?\d{1,18}\s*$"
# What a cast to double accepts, NaN aside.
FLOATING_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?[df]?|inf(inity)?)\s*$"


def lenient_cast(text: Column, kind: str) -> Column:
    """Cast a string column to ``kind`` (int, bigint, double, date or string).

    Whole numbers lose their fraction (``'3.7'`` gives 3), overflow, other text and blanks give NULL,
    and so does NaN, which would otherwise poison every sum over the column.
    """
    if kind == "int":
        return (F.when(text.rlike(SHORT_INT), text.try_cast("int"))
                .when(text.rlike(PLAIN_NUMBER), text.try_cast("double").try_cast("int")))
    if kind == "bigint":
        # Not by way of double, which is exact up to 2^53 only.
        whole = F.concat(F.regexp_extract(text, PLAIN_NUMBER, 1), F.lit("0"), F.regexp_extract(text, WHOLE_PART, 1))
        return (F.when(text.rlike(SHORT_BIGINT), text.try_cast("bigint"))
                .when(text.rlike(PLAIN_NUMBER), whole.try_cast("bigint")))
    if kind == "double":
        return F.when(text.rlike(FLOATING_NUMBER), text.try_cast("double"))
    if kind == "date":
        return parse_mixed_date(text)
    if kind == "string":
        return text.cast("string")
    raise ValueError(f"unknown type {kind!r}")
