"""Exact copies and conflicting versions of a key.

Every operator here is a grouped aggregate, so copies collapse on the map side and a key that holds a third
of the rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.projection import has_cells, quoted


def dedup_rows(df: DataFrame, source: str = "path", position: str = "row_no") -> DataFrame:
    """Drop exact copies of rows.

    Sheet rows (a ``cells`` map) are copies of each other if they have equal cells in the same workbook;
    the first position is kept.
    """
    if not has_cells(df):
        return df.distinct()
    group = [c for c in df.columns if c != position]
    first = [F.min(position).alias(position)] if position in df.columns else []
    if not first:
        return df.groupBy(*group).agg(F.count(F.lit(1)).alias("copies")).select(*group)
    return df.groupBy(*group).agg(*first).select(*df.columns)


def conflicting_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that carry more than one distinct row, with the number of versions."""
    return (
        df.distinct()
        .groupBy(*[quoted(k) for k in key])
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter(F.col("versions") > 1)
    )


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last version of each key by the columns ``order``, of which there must be one.

    The maximum of a struct (order first, then payload) is the same on every run, ties included. Versions are merged
    before the shuffle, in a sort aggregate, so a hot key arrives as one row per task; ranking in a window would send
    them all.
    """
    if not order:
        raise ValueError("the latest version of a key needs columns to order by")
    rest = [c for c in df.columns if c not in key]
    lead = [quoted(c).alias(f"order_{i}") for i, c in enumerate(order)]
    last = F.max(F.struct(*lead, *[quoted(c) for c in rest]))
    return (
        df.groupBy(*[quoted(k) for k in key])
        .agg(last.alias("last"))
        .select(*[F.col("last").getField(c).alias(c) if c in rest else quoted(c) for c in df.columns])
    )
