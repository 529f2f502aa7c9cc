"""Mapping specs: which raw header feeds which typed column of which keyed table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.dates import period_start

TYPES = {
    "date": T.DateType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    """One typed column and the raw header it is read from (matched exactly)."""

    name: str
    type: str
    source: str

    def __post_init__(self):
        if self.type not in TYPES:
            raise ValueError(f"{self.name}: unknown type {self.type!r}, use one of {sorted(TYPES)}")

    @property
    def spark_type(self) -> T.DataType:
        return TYPES[self.type]


@dataclass(frozen=True)
class Periods:
    """Folder per month, quarter or year of a date key column: date filters prune, a batch touches few folders.

    Choose the grain by the rows per day: a table with one row a day is best kept by year.
    """

    key: str
    grain: str = "month"
    column: str = "part_period"

    @property
    def spark_type(self) -> T.DataType:
        return T.DateType()

    def expression(self) -> Column:
        return period_start(F.col(self.key), self.grain)

    def between(self, low: date, high: date) -> Column:
        """The folders that days from ``low`` to ``high`` lie in."""
        first, last = (period_start(F.lit(day), self.grain) for day in (low, high))
        return F.col(self.column).between(first, last)


@dataclass(frozen=True)
class Buckets:
    """Folder per hash bucket of the key, for keys without a date. Keys are unique, so buckets are even."""

    keys: tuple[str, ...]
    count: int
    column: str = "part_bucket"

    @property
    def spark_type(self) -> T.DataType:
        return T.IntegerType()

    def expression(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")


@dataclass(frozen=True)
class ParentRef:
    """Foreign key: the named columns must exist in the parent table's key."""

    table: str
    columns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class TableSpec:
    """A typed table with a primary key, its folder layout and, optionally, its parent table."""

    name: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...]
    layout: Periods | Buckets
    parent: ParentRef | None = None
    label: str = ""

    def __post_init__(self):
        names = self.column_names
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: repeated column name")
        missing = [k for k in self.key if k not in names]
        if not self.key or missing:
            raise ValueError(f"{self.name}: key {self.key} is not among the columns")
        # A row must stay in its folder when its payload changes, or the old version would survive an upsert.
        used = (self.layout.key,) if isinstance(self.layout, Periods) else self.layout.keys
        if not set(used) <= set(self.key):
            raise ValueError(f"{self.name}: the layout may only use key columns")

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def payload(self) -> list[str]:
        return [c for c in self.column_names if c not in self.key]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, True) for c in self.columns])

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(self.layout.column, self.layout.spark_type, True)])

    @property
    def title(self) -> str:
        return self.label or self.name

    def with_layout(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.layout.column, self.layout.expression())


def _table(name, label, mapping, parent=None):
    columns = tuple(ColumnSpec(column, kind, source) for column, kind, source in mapping)
    return TableSpec(name, columns, ("date",), Periods("date", "year"), parent, label)


# The header of the sheet's date column, and per table (column, type, source header).
# Headers are matched exactly, including line breaks and blanks. "Takte" feeds two columns.
DATE_HEADER = "Datum"

OVERVIEW = _table("overview", "Overview", [
    ("date", "date", "date"),
    ("tonage", "int", "Gesamt \nTonage"),
    ("water_m3", "double", "Wasserverbrauch in m³"),
    ("liters_per_kg", "double", "Liter/kg gesamt"),
    ("electricity_per_kg", "double", "Stom / Kg Wäsche"),
    ("gas_per_kg", "double", "Gas / Kg\nWäsche"),
    ("gas_plus_elec_per_kg", "double", "Gas+ Stom / Kg Wäsche"),
    ("hours_production", "double", "Stunden\nProduktion"),
    ("kg_per_hour", "double", "KG / \nStunde Produktion"),
])

BY_DATE = ParentRef("overview", (("date", "date"),))

FLEET = _table("fleet", "Fleet", [
    ("date", "date", "date"),
    ("driving_hours", "double", "Stunden\nFuhrpark / Verlader"),
    ("kg_per_hour_driving", "double", "KG / Stunde\n Fuhrpark / Verlader"),
    ("km_driven", "int", "Gefahrene Km"),
], BY_DATE)

WASHING_MACHINES = _table("washing_machines", "Washing", [
    ("date", "date", "date"),
    ("machine_130kg", "int", "130 KG"),
    ("steps_130kg", "int", "130 KG\nTakte"),
    ("machine_85kg_plus_85kg", "int", "85 KG + 85 KG\n "),
    ("machine_85kg_middle", "int", "85 KG\nmitte"),
    ("steps_85kg_middle", "int", "85 KG mitte\nTakte"),
    ("machine_85kg_right", "int", "85 kg \nrechts"),
    ("steps_85kg_right", "int", "85 KG rechts\nTakte"),
    ("electrolux", "int", "Electrolux"),
    ("avg_load_130kg", "double", "Ø Beladung 130"),
    ("avg_load_85kg_middle", "double", "Ø Beladung 85\nmitte"),
    ("avg_load_85kg_right", "double", "Ø Beladung 85\nrechts"),
], BY_DATE)

DRYING = _table("drying", "Drying", [
    ("date", "date", "date"),
    ("roboter_1", "int", "Roboter 1"),
    ("roboter_2", "int", "Roboter 2"),
    ("roboter_3", "int", "Roboter 3 "),
    ("roboter_4", "int", "Roboter 4"),
    ("terry_prep_1", "int", "Frottelege 1 "),
    ("terry_prep_2", "int", "Frottelege 2"),
    ("terry_prep_3", "int", "Frottelege 3"),
    ("terry_prep_4", "int", "Frottelege 4 "),
    ("blankets_1", "int", "Decken 1"),
    ("blankets_2", "int", "Decken 2"),
    ("sum_drying_load", "int", "Summe Frottee"),
    ("steps_total", "int", "Takte"),
    ("kipper", "int", "Kipper"),
    ("avg_drying_load", "double", "Ø Beladung\n Trockner"),
    ("sum_drying", "int", "Trockner"),
    ("steps", "int", "Takte"),
], BY_DATE)

# Parent first: this is also the order of the upserts.
PLANT_TABLES = (OVERVIEW, FLEET, WASHING_MACHINES, DRYING)
