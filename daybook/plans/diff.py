"""Row comparison of stored tables that reads only what differs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.projection import quoted
from daybook.operators.upsert import row_diff
from daybook.plans.batch import touched_part
from daybook.sources.tables import TableStore
from daybook.specs import TableSpec


def changed_folders(before: TableStore, after: TableStore, spec: TableSpec) -> list[str]:
    """Layout folders whose checksums differ, as ``column=value``. As many as calendar periods or buckets at most."""
    column = spec.layout.column
    sides = [store.checks(spec).select(F.col(column).cast("string").alias("folder"), F.struct("rows", "digest").alias(name))
             for store, name in ((before, "old"), (after, "new"))]
    unequal = sides[0].join(sides[1], "folder", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(f"{column}={row[0]}" for row in unequal.select("folder").collect())


def stored_diff(before: TableStore, after: TableStore, spec: TableSpec, changes_only: bool = False) -> DataFrame:
    """Per key: inserted, updated, deleted or unchanged, between two stores of a table.

    Checksums that were written with the rows are compared first. Rows of unequal folders are joined; of the others only the
    keys are read, or nothing with ``changes_only``. Rows stay in their folder as long as their key does, so no change is lost.
    """
    folders = changed_folders(before, after, spec)
    columns = list(spec.column_names)
    sides = [touched_part(store, spec, folders).select(*columns) for store in (before, after)]
    found = row_diff(*sides, list(spec.key))
    if changes_only:
        return found.where("change <> 'unchanged'")
    column = spec.layout.column
    values = [F.lit(folder.split("=", 1)[1]).cast(spec.layout.spark_type) for folder in folders]
    same = after.read(spec, with_layout=True).where(~F.col(column).isin(*values))
    return found.unionByName(same.select(*[quoted(k) for k in spec.key], F.lit("unchanged").alias("change")))
