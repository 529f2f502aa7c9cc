"""Period reports kept as tables: full rebuild, only the periods in which keys changed, or by what a batch has changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import period_start
from daybook.operators.kpi import period_summary
from daybook.operators.projection import quoted
from daybook.sources.tables import TableStore, drop_folder, in_folders, is_ready, is_written, mark_ready, read_if_there, subfolders
from daybook.specs import Periods, TableSpec

# Days after the first that may still lie in the period.
PERIOD_DAYS = {"week": 6, "month": 30, "quarter": 91, "year": 365}


def refresh_view(df: DataFrame, key: str, grain: str, measures: Mapping[str, tuple[str, str]], path: str,
                 by: Sequence[str] = ()) -> None:
    """Rebuild the whole report, one folder per period."""
    report = by_period(period_summary(df, key, grain, measures, by))
    report.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("period").parquet(path)


def by_period(report: DataFrame) -> DataFrame:
    """Gathered by period, so that a folder gets few files; a large period is split."""
    return report.hint("rebalance", F.col("period"))


def refresh_snapshot(df: DataFrame, key: str, grain: str, measures: Mapping[str, tuple[str, str]], root: str, view: str,
                     by: Sequence[str] = ()) -> None:
    """Rebuild the report as a snapshot of its own below ``root`` and turn the view ``view`` of the session's catalog to it.

    A reader that began before reads on: the snapshot before the new one is kept, older ones are dropped.
    """
    spark = df.sparkSession
    before = subfolders(spark, root)
    path = f"{root}/snapshot-{int(before[-1].rsplit('-', 1)[1]) + 1 if before else 1:08d}"
    refresh_view(df, key, grain, measures, path, by)
    spark.read.parquet(path).createOrReplaceTempView(view)
    for old in before[:-1]:
        drop_folder(spark, f"{root}/{old}")


def in_periods(df: DataFrame, key: str, grain: str, changed: DataFrame, layout: Periods | None = None) -> DataFrame:
    """Rows of ``df`` in the periods of the changed keys. The broadcast side is one row per calendar period.

    ``layout`` is the folder layout of the table, if it is kept by period; other folders are then not read.
    """
    periods = changed.select(period_start(quoted(key), grain).alias("period")).distinct()
    if layout:
        days = F.explode(F.sequence("period", F.date_add("period", PERIOD_DAYS[grain])))
        folders = periods.select(days.alias("day")).select(
            period_start(F.col("day"), layout.grain).alias(layout.column))
        df = in_folders(df, layout.column, folders)
    return df.join(F.broadcast(periods), period_start(quoted(key), grain) == periods["period"], "left_semi")


def refresh_incremental(df: DataFrame, changed: DataFrame, key: str, grain: str,
                        measures: Mapping[str, tuple[str, str]], path: str, by: Sequence[str] = (),
                        layout: Periods | None = None) -> None:
    """Recompute the periods in which ``changed`` has days and replace just their folders.

    ``changed`` must hold the days of the rows as they were and as they are: ``plans.batch.changed_days`` of an ingested
    batch, or ``operators.upsert.changed_days``. A period without rows any more loses its folder.
    """
    touched = in_periods(df, key, grain, changed, layout)
    report = by_period(period_summary(touched, key, grain, measures, by))
    (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("period").parquet(path))
    periods = changed.where(quoted(key).isNotNull()).select(period_start(quoted(key), grain).alias("period")).distinct()
    left = touched.select(period_start(quoted(key), grain).alias("period")).distinct()
    for row in periods.join(left, "period", "left_anti").collect():  # one row per emptied calendar period
        drop_folder(df.sparkSession, f"{path}/period={row['period']}")


@dataclass(frozen=True)
class Report:
    """A period report on a stored table that is kept up to date by what batches change.

    The report's folder holds, per period and group, the number of rows and for each measure a sum and a count of values,
    and the least and greatest value for ``min`` and ``max``. A batch's old rows are subtracted and its new ones added, so a
    refresh reads what the batch moved (see ``TableStore.moves``) and the report's touched periods, not the table. Only
    periods of a report with ``min`` or ``max`` that lost a row are summed up again from the table. Sums of doubles that
    are subtracted keep rounding errors in the last digits; whole numbers are exact.

    <path>/state/period=<first day>    figures; a group without rows any more stays with 0 rows and is not read
    <path>/pending/<batch>             new figures of the touched periods, until they are in the state
    <path>/done/<batch>                batches that the report holds
    """

    spec: TableSpec
    day: str
    grain: str
    measures: Mapping[str, tuple[str, str]]
    path: str
    by: tuple[str, ...] = ()

    def __post_init__(self):
        unknown = {how for how, _ in self.measures.values()} - {"sum", "avg", "count", "min", "max"}
        if unknown:
            raise ValueError(f"unknown aggregates {sorted(unknown)}")

    def _values(self) -> dict[str, str]:
        """The columns that measures are made of, by a number of their own."""
        return {column: f"v{i}" for i, column in enumerate(dict.fromkeys(column for _, column in self.measures.values()))}

    def _extremes(self) -> dict[str, tuple[str, str]]:
        return {f"{how}_{self._values()[column]}": (how, column) for how, column in self.measures.values() if how in ("min", "max")}

    def _sums(self) -> list[str]:
        return ["rows", *[f"{part}_{v}" for v in self._values().values() for part in ("sum", "count")]]

    def _schema(self) -> T.StructType:
        """The state's columns, summed as Spark sums them."""
        kinds = {c.name: c.spark_type for c in self.spec.columns}
        fields = [T.StructField(c, kinds[c]) for c in self.by] + [T.StructField("rows", T.LongType())]
        for column, v in self._values().items():
            numeric = not isinstance(kinds[column], (T.StringType, T.DateType))
            whole = isinstance(kinds[column], (T.IntegerType, T.LongType)) or not numeric
            fields += [T.StructField(f"sum_{v}", T.LongType() if whole else T.DoubleType()), T.StructField(f"count_{v}", T.LongType())]
        fields += [T.StructField(name, kinds[column]) for name, (_, column) in self._extremes().items()]
        return T.StructType([*fields, T.StructField("period", T.DateType())])

    def _figures(self, rows: DataFrame) -> DataFrame:
        """Figures per period and group of rows with a ``sign``."""
        sign, parts = F.col("sign"), [F.sum("sign").cast("bigint").alias("rows")]
        kinds = {c.name: c.spark_type for c in self.spec.columns}
        for column, v in self._values().items():
            value = F.lit(0) if isinstance(kinds[column], (T.StringType, T.DateType)) else quoted(column)
            parts += [F.coalesce(F.sum(value * sign), F.lit(0)).cast(self._schema()[f"sum_{v}"].dataType).alias(f"sum_{v}"),
                      F.sum(F.when(quoted(column).isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"count_{v}")]
        parts += [(F.min if how == "min" else F.max)(F.when(sign > 0, quoted(column))).alias(name)
                  for name, (how, column) in self._extremes().items()]
        dated = rows.where(quoted(self.day).isNotNull())
        return dated.groupBy(period_start(quoted(self.day), self.grain).alias("period"), *[quoted(c) for c in self.by]).agg(*parts)

    def _state(self, spark) -> DataFrame:
        return read_if_there(spark, f"{self.path}/state", self._schema())

    def rebuild(self, store: TableStore) -> None:
        """Make the report from the whole table."""
        figures = by_period(self._figures(store.read(self.spec).withColumn("sign", F.lit(1))))
        figures.select(*self._schema().names).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "period").parquet(f"{self.path}/state")

    def refresh(self, store: TableStore, batch: str) -> None:
        """Bring the report up to a batch that is in the table. A batch that it holds already changes nothing; a report that
        is not there yet is made from the whole table."""
        spark, pending = store.spark, f"{self.path}/pending"
        for waiting in subfolders(spark, pending):  # a refresh that broke off once its figures were complete
            if is_ready(spark, f"{pending}/{waiting}"):
                self._put(spark, waiting)
        if batch in subfolders(spark, f"{self.path}/done"):
            return
        if not is_written(spark, f"{self.path}/state"):
            self.rebuild(store)
            mark_ready(spark, f"{self.path}/done/{batch}")
            return
        self.changes(store, batch).write.mode("overwrite").parquet(f"{pending}/{batch}")
        mark_ready(spark, f"{pending}/{batch}")
        self._put(spark, batch)

    def changes(self, store: TableStore, batch: str) -> DataFrame:
        """The new figures of all groups in the periods that a batch touches."""
        spark, schema = store.spark, self._schema()
        moves = store.moves(self.spec, batch)
        touched = sorted(row[0] for row in moves.where(quoted(self.day).isNotNull()).select(
            period_start(quoted(self.day), self.grain)).distinct().collect())  # calendar periods
        old = self._state(spark).where(F.col("period").isin(touched))
        new = self._figures(moves)
        extremes = self._extremes()
        if not extremes:
            return self._merged(old, new, {}).select(*schema.names)
        lost = [row[0] for row in moves.where((F.col("sign") < 0) & quoted(self.day).isNotNull()).select(
            period_start(quoted(self.day), self.grain)).distinct().collect()]
        grown = self._merged(old, new, extremes).where(~F.col("period").isin(lost))
        table = store.read(self.spec, with_layout=True)
        layout = self.spec.layout if isinstance(self.spec.layout, Periods) and self.spec.layout.key == self.day else None
        shrunk = moves.where(F.col("sign") < 0).select(quoted(self.day))
        again = self._figures(in_periods(table, self.day, self.grain, shrunk, layout).withColumn("sign", F.lit(1)))
        gone = old.where(F.col("period").isin(lost)).select(*schema.names)
        zero = [F.lit(0).cast(schema[c].dataType).alias(c) if c in self._sums() else F.lit(None).cast(schema[c].dataType).alias(c)
                if c in extremes else quoted(c) for c in schema.names]
        return grown.select(*schema.names).unionByName(self._merged(again.select(*schema.names), gone.select(*zero), extremes).select(*schema.names))

    def _merged(self, left: DataFrame, right: DataFrame, extremes: Mapping[str, tuple[str, str]]) -> DataFrame:
        both = left.unionByName(right)
        sums = [F.sum(c).cast(self._schema()[c].dataType).alias(c) for c in self._sums()]
        ends = [(F.min if how == "min" else F.max)(name).alias(name) for name, (how, _) in extremes.items()]
        return both.groupBy("period", *[quoted(c) for c in self.by]).agg(*sums, *ends)

    def _put(self, spark, batch: str) -> None:
        """Put complete figures into the state: the same however often it is done."""
        figures = spark.read.schema(self._schema()).parquet(f"{self.path}/pending/{batch}")
        by_period(figures).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(
            f"{self.path}/state")
        mark_ready(spark, f"{self.path}/done/{batch}")
        drop_folder(spark, f"{self.path}/pending/{batch}")

    def read(self, spark) -> DataFrame:
        """The report as of now: ``period``, the groups, the measures."""
        def figure(how: str, column: str) -> Column:
            v = self._values()[column]
            if how == "count":
                return F.col(f"count_{v}")
            if how in ("min", "max"):
                return F.col(f"{how}_{v}")
            own = F.col(f"sum_{v}") if how == "sum" else F.col(f"sum_{v}") / F.col(f"count_{v}")
            return F.when(F.col(f"count_{v}") > 0, own)

        return self._state(spark).where("rows > 0").select(
            "period", *[quoted(c) for c in self.by], *[figure(how, column).alias(name) for name, (how, column) in self.measures.items()])
