"""daybook: untidy daily spreadsheets in, typed keyed tables and KPI answers out, all on Spark."""

from daybook.specs import PLANT_TABLES, Buckets, ColumnSpec, ParentRef, Periods, TableSpec

__all__ = ["PLANT_TABLES", "Buckets", "ColumnSpec", "ParentRef", "Periods", "TableSpec"]
