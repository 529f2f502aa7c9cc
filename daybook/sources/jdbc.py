"""Database tables: append to staging, and a scan that is split on the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                      batch_size: int = 10_000, connections: int = 16) -> None:
    """Append to a staging table. ``connections`` bounds the parallel writers, not the rows.

    A task that is run again may append its rows twice; the upsert reads staging as distinct rows.
    """
    options = {"batchsize": str(batch_size), "numPartitions": str(connections), **(properties or {})}
    df.write.jdbc(url, table, mode="append", properties=options)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None,
              bounds: tuple[object, object] | None = None, partitions: int = 16,
              predicates: Sequence[str] | None = None, properties: dict[str, str] | None = None,
              single_task: bool = False) -> DataFrame:
    """Scan a database table in parallel; filters and column choice go to the database.

    Either ``key`` with ``bounds`` splits the key range evenly (rows outside still come along), or
    ``predicates`` gives one condition per task, for keys whose values are bunched up. Without either the whole table
    would come through one connection; that has to be asked for by ``single_task``.
    """
    options = {"fetchsize": "10000", **(properties or {})}
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    if key is None or bounds is None:
        if not single_task:
            raise ValueError("give a key with bounds, or predicates, or single_task=True")
        return spark.read.jdbc(url, table, properties=options)
    low, high = bounds
    return spark.read.jdbc(url, table, column=key, lowerBound=str(low), upperBound=str(high),
                           numPartitions=partitions, properties=options)
