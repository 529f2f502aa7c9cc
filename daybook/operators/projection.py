"""From an untyped wide sheet to typed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import lenient_cast
from daybook.session import shared_folder
from daybook.specs import ColumnSpec, TableSpec

CELLS = "cells"


def quoted(name: str) -> Column:
    """Column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain_text(value: Column, kind: T.DataType) -> Column:
    """A value as text, numbers without an exponent as far as 38 digits carry them."""
    text = value.cast("string")
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return text
    digits = F.regexp_replace(text.try_cast("decimal(38,15)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(text.contains("E"), F.coalesce(digits, text)).otherwise(text)


def to_raw(df: DataFrame) -> DataFrame:
    """Every column as a nullable string."""
    return df.select(*[plain_text(quoted(c), df.schema[c].dataType).alias(c) for c in df.columns])


def has_cells(df: DataFrame) -> bool:
    return CELLS in df.columns and isinstance(df.schema[CELLS].dataType, T.MapType)


def raw_value(df: DataFrame, header: str) -> Column | None:
    """The raw column under ``header``; None if a wide frame lacks it.

    A frame with a ``cells`` map holds sheets with different headers: there a missing header reads as NULL.
    """
    if header in df.columns:
        return quoted(header)
    if has_cells(df):
        return F.col(CELLS)[F.lit(header)]
    return None


def typed_column(df: DataFrame, column: ColumnSpec) -> Column:
    """One spec column out of the raw frame, typed; NULL of that type if the header is missing."""
    value = raw_value(df, column.source)
    if value is None:
        return F.lit(None).cast(column.spark_type)
    kind = df.schema[column.source].dataType if column.source in df.columns else T.StringType()
    if isinstance(kind, T.NumericType) and isinstance(column.spark_type, T.NumericType):
        # Typed numbers need no text between; whole numbers lose their fraction, NaN is NULL as in text.
        known = F.when(~F.isnan(value), value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value
        return known.try_cast(column.spark_type)
    if kind == column.spark_type:
        return value
    return lenient_cast(plain_text(value, kind), column.type)


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rename and cast the raw frame to the columns of ``spec``."""
    return df.select(*[typed_column(df, c).alias(c.name) for c in spec.columns])


def conform(df: DataFrame, spec: TableSpec, single_precision: bool = False) -> DataFrame:
    """Typed frame in the declared order; absent columns become NULL, unknown ones are left out.

    ``single_precision`` narrows doubles to 32 bit for a sink whose columns are REAL.
    """
    def column(c: ColumnSpec) -> Column:
        kind = T.FloatType() if single_precision and c.type == "double" else c.spark_type
        value = quoted(c.name) if c.name in df.columns else F.lit(None)
        return value.cast(kind).alias(c.name)

    return df.select(*[column(c) for c in spec.columns])


def with_date(df: DataFrame, header: str, name: str = "date") -> DataFrame:
    """Parse the sheet's date column once, for all tables that are keyed by it."""
    value = raw_value(df, header)
    parsed = F.lit(None).cast("date") if value is None else lenient_cast(value.cast("string"), "date")
    return df.withColumn(name, parsed)


def fan_out(df: DataFrame, specs: Sequence[TableSpec]) -> dict[str, DataFrame]:
    """One cleaned input, one frame per table: projected, without NULL keys, without exact copies.

    For more than one table the typed columns of all are written once to the shared folder, and each frame reads its
    own from there; the input is then computed once, now.
    """
    if len(specs) == 1:
        tables = {specs[0].name: project(df, specs[0])}
    else:
        wide, path = project_all(df, specs), shared_folder(df.sparkSession, "fan-out")
        wide.write.parquet(path)
        wide = df.sparkSession.read.schema(wide.schema).parquet(path)
        tables = {spec.name: narrow(wide, spec) for spec in specs}
    return {spec.name: drop_null_key(tables[spec.name], *spec.key).distinct() for spec in specs}


def wide_name(spec: TableSpec, column: str) -> str:
    return f"{spec.name}__{column}"


def project_all(df: DataFrame, specs: Iterable[TableSpec], keep: Iterable[str] = (),
                more: Mapping[str, Column] | None = None) -> DataFrame:
    """The columns of all tables side by side, so that one pass over an expensive source feeds every table.

    ``keep`` are raw columns that come along, ``more`` others by name.
    """
    columns = [quoted(c) for c in keep]
    for spec in specs:
        columns += [typed_column(df, c).alias(wide_name(spec, c.name)) for c in spec.columns]
    return df.select(*columns, *[column.alias(name) for name, column in (more or {}).items()])


def narrow(wide: DataFrame, spec: TableSpec, keep: Iterable[str] = ()) -> DataFrame:
    """One table's columns back out of :func:`project_all`; on Parquet only these are read."""
    return wide.select(*[quoted(c) for c in keep],
                       *[quoted(wide_name(spec, c)).alias(c) for c in spec.column_names])


def key_is_set(*key: str) -> Column:
    condition = F.lit(True)
    for k in key:
        condition = condition & quoted(k).isNotNull()
    return condition


def drop_null_key(df: DataFrame, *key: str) -> DataFrame:
    """Rows whose whole key is set."""
    return df.filter(key_is_set(*key))


def quarantine(df: DataFrame, *key: str) -> DataFrame:
    """The rows :func:`drop_null_key` leaves out, with the reason."""
    reason = F.concat_ws(", ", *[F.when(quoted(k).isNull(), F.lit(f"{k} is null")) for k in key])
    return df.filter(~key_is_set(*key)).withColumn("reason", reason)
