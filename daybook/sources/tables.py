"""Typed tables as partitioned Parquet folders below one root that all executors share.

tables/<name>/<layout folder>     the rows
checks/<name>/<layout folder>     number of rows and checksum of each folder
staging/<name>/<batch>            typed, deduplicated rows of one batch
merged/<name>/<batch>             new contents of the folders that the batch falls in, until they are in the table
moves/<name>/<batch>              rows that the batch replaced and those it brought, for a refresh of reports; none of a first load
batches/<batch>                   finished steps of a batch, with their counts

All writes are Spark's own: a merge goes to a folder of its own first, then replaces the touched folders of the table by
``partitionOverwriteMode=dynamic``. Putting a finished merge into the table can be done over and over, so a batch that broke
off there is carried on by whoever writes the table next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.specs import TableSpec


def create_table_ddl(spec: TableSpec, location: str, database: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for a catalog, on the table's folder."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.stored_schema)
    return (f"CREATE TABLE IF NOT EXISTS {catalog_name(spec, database)} ({columns}) USING parquet "
            f"PARTITIONED BY (`{spec.layout.column}`) LOCATION '{location}'")


def catalog_name(spec: TableSpec, database: str | None = None) -> str:
    return f"`{database}`.`{spec.name}`" if database else f"`{spec.name}`"


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame made without Python workers."""
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def one_row(spark: SparkSession, schema: T.StructType, values: dict[str, object]) -> DataFrame:
    """A frame of one row made without Python workers; absent values are NULL."""
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def ensure_table(spark: SparkSession, spec: TableSpec, location: str) -> None:
    """Create the empty table folder unless it is there; a second call changes nothing."""
    no_rows(spark, spec.stored_schema).write.mode("ignore").partitionBy(spec.layout.column).parquet(location)


def in_folders(df: DataFrame, folder: str, keyed: DataFrame) -> DataFrame:
    """Rows of ``df`` in the folders that ``keyed``, which has the same folder column, falls in.

    The folder names go into the scan as literals: pruning at run time would skip a batch without a filter.
    """
    names = [row[0] for row in keyed.select(folder).distinct().collect()]
    return df.filter(F.col(folder).isin(names))


def _path(spark: SparkSession, path: str):
    """A path of the shared file system, and that file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    folder, system = _path(spark, path)
    system.delete(folder, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder: layout folders or batches, never as many as rows. None if it does not exist."""
    folder, system = _path(spark, path)
    if not system.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(folder)
                  if entry.isDirectory() and not entry.getPath().getName().startswith(("_", ".")))


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether Spark's last write to this folder came to its end."""
    marker, system = _path(spark, f"{path}/_SUCCESS")
    return system.exists(marker)


def mark_ready(spark: SparkSession, path: str) -> None:
    """Mark a folder whose contents are complete and may be put where they belong, by whomever."""
    marker, system = _path(spark, f"{path}/_READY")
    system.create(marker, True).close()


def is_ready(spark: SparkSession, path: str) -> bool:
    marker, system = _path(spark, f"{path}/_READY")
    return system.exists(marker)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder with a known schema; empty if it does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def checksum(columns: list[str]) -> Column:
    """Order-free checksum of a group of rows: all hashes by XOR, NULLs told apart by place."""
    parts = [part for c in columns for part in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.bit_xor(F.xxhash64(*parts))


def folder_checks(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows, digest`` per layout folder of rows that carry the layout column."""
    return df.groupBy(spec.layout.column).agg(
        F.count(F.lit(1)).alias("rows"), checksum(spec.column_names).alias("digest")).select("rows", "digest", spec.layout.column)


@dataclass(frozen=True)
class TableStore:
    """The tables of one root folder. One writer per table at a time.

    ``batches`` may lie elsewhere: a stream keeps its finished batches with its checkpoint, whose batch numbers they hold.
    With a ``database`` each table is in the session's catalog as well, and every batch adds its new folders there.
    """

    spark: SparkSession
    root: str
    batches: str | None = None
    database: str | None = None

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def data_path(self, spec: TableSpec) -> str:
        return self.path("tables", spec.name)

    def checks_path(self, spec: TableSpec) -> str:
        return self.path("checks", spec.name)

    def staging_path(self, spec: TableSpec, batch: str) -> str:
        return self.path("staging", spec.name, batch)

    def merged_path(self, spec: TableSpec, batch: str) -> str:
        return self.path("merged", spec.name, batch)

    def moves_path(self, spec: TableSpec, batch: str) -> str:
        return self.path("moves", spec.name, batch)

    def read(self, spec: TableSpec, with_layout: bool = False) -> DataFrame:
        """The table as of now."""
        df = read_if_there(self.spark, self.data_path(spec), spec.stored_schema).select(*spec.stored_schema.names)
        return df if with_layout else df.select(*spec.column_names)

    def checks(self, spec: TableSpec) -> DataFrame:
        """``rows, digest`` of each folder, as they were written with the rows."""
        return read_if_there(self.spark, self.checks_path(spec), checks_schema(spec))

    def staged(self, spec: TableSpec, batch: str) -> DataFrame:
        return read_if_there(self.spark, self.staging_path(spec, batch), spec.stored_schema)

    def merged(self, spec: TableSpec, batch: str) -> DataFrame:
        """New contents of a batch's folders: merged ones, or the staged rows as they are if the table had none of them."""
        merged = "rows" in subfolders(self.spark, self.merged_path(spec, batch))
        path = f"{self.merged_path(spec, batch)}/rows" if merged else self.staging_path(spec, batch)
        return self.spark.read.schema(spec.stored_schema).parquet(path).select(*spec.stored_schema.names)

    def moves(self, spec: TableSpec, batch: str) -> DataFrame:
        """The rows of a batch with their ``sign``: -1 as they were before it, 1 as it brought them."""
        return read_if_there(self.spark, self.moves_path(spec, batch), moves_schema(spec))

    def register_views(self, *specs: TableSpec) -> None:
        """Each table as a temp view of its name, for SQL users without a catalog."""
        for spec in specs:
            self.read(spec, with_layout=True).createOrReplaceTempView(spec.name)

    def write(self, df: DataFrame, spec: TableSpec, path: str) -> None:
        """Write rows that carry their layout column, in folders of it."""
        (df.select(*spec.stored_schema.names).write.mode("overwrite").option("partitionOverwriteMode", "static")
           .partitionBy(spec.layout.column).parquet(path))

    def put(self, df: DataFrame, spec: TableSpec, path: str) -> None:
        """Replace the folders that the rows fall in; all others stay."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(spec.layout.column).parquet(path))

    def apply(self, spec: TableSpec, batch: str) -> None:
        """Put a finished merge into the table. To be done again after a failure, with the same result."""
        folder = self.merged_path(spec, batch)
        self.put(self.merged(spec, batch), spec, self.data_path(spec))
        self.put(self.spark.read.schema(checks_schema(spec)).parquet(f"{folder}/checks"), spec, self.checks_path(spec))
        if self.database is not None:
            self.register(spec, subfolders(self.spark, f"{folder}/checks"))
        drop_folder(self.spark, folder)

    def finish_others(self, spec: TableSpec, batch: str) -> None:
        """Carry on other batches that broke off while they were put into the table; their merges are complete."""
        for other in subfolders(self.spark, self.path("merged", spec.name)):
            if other != batch and is_ready(self.spark, self.merged_path(spec, other)):
                self.apply(spec, other)

    def register(self, spec: TableSpec, folders: list[str] | None = None) -> None:
        """The table in the catalog, with the given layout folders (all, if none are) as its partitions."""
        self.spark.sql(create_table_ddl(spec, self.data_path(spec), self.database))
        name, column = catalog_name(spec, self.database), spec.layout.column
        folders = subfolders(self.spark, self.data_path(spec)) if folders is None else folders
        values = [folder.split("=", 1)[1] for folder in folders]
        parts = " ".join(f"PARTITION (`{column}`={'NULL' if v == '__HIVE_DEFAULT_PARTITION__' else repr(v)})" for v in values)
        if parts:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        self.spark.catalog.refreshTable(name)

    def drop(self, *parts: str) -> None:
        drop_folder(self.spark, self.path(*parts))


def checks_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField("rows", T.LongType()), T.StructField("digest", T.LongType()),
                         T.StructField(spec.layout.column, spec.layout.spark_type)])


def moves_schema(spec: TableSpec) -> T.StructType:
    return T.StructType([*[T.StructField(c.name, c.spark_type) for c in spec.columns], T.StructField("sign", T.IntegerType())])


BATCH_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("step", T.StringType()),
    *[T.StructField(n, T.LongType()) for n in (
        "rows", "dated", "keyed", "staged", "before", "affected", "inserted", "updated", "after", "table_before", "table_after",
        "attempt")],
])


def batch_path(store: TableStore, batch: str) -> str:
    return f"{store.batches or store.path('batches')}/{batch}"


def note_step(store: TableStore, batch: str, **step: object) -> None:
    """Record a finished step. One small file, which appears whole or not at all."""
    one_row(store.spark, BATCH_SCHEMA, step).write.mode("append").parquet(batch_path(store, batch))


def finished_steps(store: TableStore, batch: str) -> dict[tuple[str, str], dict]:
    """Counts by (table, step), those of the last attempt; a batch has a handful of steps per table. Empty if it is new."""
    rows = sorted(read_if_there(store.spark, batch_path(store, batch), BATCH_SCHEMA).collect(), key=lambda r: r.attempt or 0)
    return {(r.table_name, r.step): r.asDict() for r in rows}
