"""One batch from raw rows to updated tables.

Steps per batch: the raw source is read once into a typed wide frame; then, table by table and parents first,
staging -> merge -> table. A merge writes the new contents of the touched folders to a folder of its own; they then replace
those folders of the table. Every finished step is in the table of batches, and a batch that is run again takes up where it
stopped: a merge that was not complete is made again on the table as it is now, a complete one is put into the table first,
by this batch or by the next one that writes the table, so nothing that came later is undone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.dedup import latest_per_key
from daybook.operators.projection import (
    CELLS, drop_null_key, has_cells, key_is_set, narrow, project_all, quoted, wide_name, with_date)
from daybook.operators.quality import fk_violations
from daybook.operators.upsert import filter_words, upsert
from daybook.sources.tables import (
    TableStore, checks_schema, drop_folder, finished_steps, folder_checks, in_folders, is_ready, mark_ready, no_rows, note_step, one_row,
    read_if_there, subfolders)
from daybook.plans.refresh import Report
from daybook.sources.workbook import decode_workbooks, with_hash
from daybook.specs import TableSpec

# Staged keys are broadcast up to this measured size; beyond it the join shuffles what a Bloom filter of the keys lets pass.
BROADCAST_LIMIT = 64 * 1024 * 1024
# Size of that filter at most; with more keys than it can tell apart, all touched rows are shuffled.
FILTER_LIMIT = 256 * 1024 * 1024
AUDIT_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in ("table_name", "title", "status")],
    *[T.StructField(n, T.LongType()) for n in (
        "sheet_rows", "valid_dates", "removed", "copies", "staged", "before", "affected", "inserted", "updated", "after",
        "table_before", "table_after")]])
FILES_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("sha", "path", "batch")])
BATCH_ORDER = ("modified", "path", "row_no")
WHOLE_BATCH = "*"


class ConflictingRows(ValueError):
    """A batch holds two different rows for one key."""


class MissingParent(ValueError):
    """A batch holds child rows whose parent row does not exist."""


class UnknownParent(ValueError):
    """A table's parent is not known, or comes after it."""


def sheet_path(store: TableStore, batch: str) -> str:
    return store.path("sheet", batch)


def quarantine_path(store: TableStore, batch: str) -> str:
    return store.path("quarantine", batch)


def wide_schema(specs: Sequence[TableSpec], raw: DataFrame) -> T.StructType:
    """Schema of the typed wide frame: the columns of file and row, those of all tables, what the rest is for."""
    return T.StructType([
        *[T.StructField(c, raw.schema[c].dataType) for c in batch_order(raw)],
        *[T.StructField(wide_name(spec, c.name), c.spark_type) for spec in specs for c in spec.columns],
        T.StructField("unfit", T.StringType()), T.StructField("contents", T.StringType())])


def stage_sheet(store: TableStore, raw: DataFrame, specs: Sequence[TableSpec], batch: str,
                date_header: str | None = None) -> None:
    """Read the raw source once and write all typed columns, plus the rows that fit no table, with their contents.

    A file that could not be read (a row with ``error``) goes to quarantine as well. The ledger gets the figures of the
    sheet: rows, rows with a valid date, and rows with a key for each table.
    """
    keep = batch_order(raw)
    dated = with_date(raw, date_header) if date_header else raw
    reasons = [F.when(lost, F.lit(f"{spec.name}: key is null")) for spec in specs
               for lost in [~key_is_set(*[wide_name(spec, k) for k in spec.key])]]
    contents = F.col(CELLS) if has_cells(raw) else F.struct(*[quoted(c) for c in raw.columns if c not in keep])
    error = F.col("error") if has_cells(raw) and "error" in raw.columns else F.lit(None).cast("string")
    typed = project_all(dated, specs, keep, {"unfit": error, "contents": F.to_json(contents, {"ignoreNullFields": "false"})})
    reason = F.coalesce("unfit", F.concat_ws(", ", *reasons))
    typed = typed.withColumn("unfit", F.nullif(reason, F.lit(""))).withColumn(
        "contents", F.when(F.col("unfit").isNotNull(), F.col("contents")))
    typed.select(*wide_schema(specs, raw).names).write.mode("overwrite").parquet(sheet_path(store, batch))

    wide = store.spark.read.schema(wide_schema(specs, raw)).parquet(sheet_path(store, batch))
    (wide.filter("unfit IS NOT NULL").select(*keep, F.col("unfit").alias("reason"), "contents")
         .write.mode("overwrite").parquet(quarantine_path(store, batch)))
    dates = [wide_name(spec, c.name) for spec in specs for c in spec.columns if c.source == "date" and c.type == "date"]
    dated_rows = F.count(quoted(dates[0])) if dates else F.lit(None).cast("bigint")
    keyed = [F.count_if(key_is_set(*[wide_name(spec, k) for k in spec.key])).alias(spec.name) for spec in specs]
    row = wide.agg(F.count(F.lit(1)).alias("all rows"), dated_rows.alias("dated rows"), *keyed).first()
    for spec in specs:
        note_step(store, batch, table_name=spec.name, step="typed", keyed=row[spec.name])
    note_step(store, batch, table_name=WHOLE_BATCH, step="sheet", rows=row["all rows"], dated=row["dated rows"])


def stage_table(store: TableStore, spec: TableSpec, rows: DataFrame, batch: str, on_conflict: str = "error",
                order: Sequence[str] | None = None) -> None:
    """Typed rows of one table into its batch staging: keys set, exact copies dropped.

    ``on_conflict`` is ``error`` (two versions of a key stop the batch, see :func:`measure_staged`) or
    ``latest``: the last one wins, by those of the columns ``order`` (by default file and row) that the rows have;
    there must be one.
    """
    rows = drop_null_key(rows, *spec.key)
    if on_conflict == "latest":
        order = batch_order(rows) if order is None else [c for c in order if c in rows.columns]
        rows = latest_per_key(rows, spec.key, order).select(*spec.column_names)
    elif on_conflict == "error":
        rows = rows.select(*spec.column_names).distinct()
    else:
        raise ValueError(f"unknown conflict policy {on_conflict!r}")
    rows = spec.with_layout(rows).hint("rebalance", F.col(spec.layout.column))
    store.write(rows, spec, store.staging_path(spec, batch))


def batch_order(df: DataFrame) -> list[str]:
    return [c for c in BATCH_ORDER if c in df.columns]


def _octets(df: DataFrame, columns: Sequence[str]) -> Column:
    """Bytes of one row of these columns in memory, about."""
    size = F.lit(16)
    for c in columns:
        text = isinstance(df.schema[c].dataType, T.StringType)
        size = size + 8 + (F.coalesce(F.octet_length(quoted(c)), F.lit(0)) if text else F.lit(0))
    return size


def measure_staged(spec: TableSpec, staged: DataFrame, unique: bool = False) -> tuple[int, int]:
    """Number and size of the staged keys; raises if a key has more than one version.

    ``unique`` keys, as the policy ``latest`` leaves them, are only counted.
    """
    size = F.coalesce(F.sum(_octets(staged, spec.key)), F.lit(0)).alias("bytes")
    if unique:
        row = staged.agg(F.count(F.lit(1)).alias("keys"), size).first()
        return row["keys"], row["bytes"]
    counted = staged.groupBy(*[quoted(k) for k in spec.key]).agg(F.count(F.lit(1)).alias("versions"))
    row = counted.agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(F.col("versions") > 1).alias("conflicts"), size).first()
    if row["conflicts"]:
        raise ConflictingRows(f"{spec.name}: {row['conflicts']} keys have more than one version in the batch")
    return row["keys"], row["bytes"]


def touched_part(store: TableStore, spec: TableSpec, folders: Sequence[str]) -> DataFrame:
    """The table's rows in the given layout folders. The names go into the scan as literals, so it prunes."""
    column = spec.layout.column
    values = [F.lit(folder.split("=", 1)[1]).cast(spec.layout.spark_type) for folder in folders]
    return store.read(spec, with_layout=True).filter(F.col(column).isin(*values))


def check_parent(store: TableStore, spec: TableSpec, parent: TableSpec, staged: DataFrame,
                 broadcast_limit: int = BROADCAST_LIMIT) -> None:
    """Raise if staged rows refer to rows the parent table lacks.

    The references are measured; only up to the limit are they broadcast.
    """
    pairs = spec.parent.columns
    references = drop_null_key(staged, *[c for c, _ in pairs]).select(
        *[quoted(c).alias(p) for c, p in pairs]).distinct()
    known = in_folders(store.read(parent, with_layout=True), parent.layout.column, parent.with_layout(references)).select(
        *[p for _, p in pairs])
    size = references.agg(F.coalesce(F.sum(_octets(references, references.columns)), F.lit(0))).first()[0]
    if size <= broadcast_limit:
        known = known.join(F.broadcast(references), [p for _, p in pairs], "left_semi")
    lost = fk_violations(references, known, [(p, p) for _, p in pairs]).count()
    if lost:
        raise MissingParent(f"{spec.name}: {lost} keys have no row in {parent.name}")


def parents_of(specs: Sequence[TableSpec], stored: Sequence[TableSpec] = ()) -> dict[str, TableSpec]:
    """The parent of each table that has one: earlier in the batch, or among the ``stored`` tables.

    Raises if a parent is unknown or comes after its child.
    """
    found, earlier = {}, {spec.name: spec for spec in stored}
    for spec in specs:
        if spec.parent:
            if spec.parent.table not in earlier:
                raise UnknownParent(f"{spec.name}: its parent {spec.parent.table} is neither an earlier table of the "
                                    "batch nor among the stored tables given")
            found[spec.name] = earlier[spec.parent.table]
        earlier[spec.name] = spec
    return found


def note_moves(store: TableStore, spec: TableSpec, batch: str, inside: DataFrame, staged: DataFrame, small: bool) -> None:
    """Keep the rows that the batch replaces and those it brings, if the table has a day that reports can be made by."""
    if not any(c.type == "date" for c in spec.columns):
        return
    keys = staged.select(*spec.key)
    replaced = inside.join(F.broadcast(keys) if small else keys, list(spec.key), "left_semi")
    columns = list(spec.column_names)
    both = replaced.select(*columns, F.lit(-1).alias("sign")).unionByName(staged.select(*columns, F.lit(1).alias("sign")))
    both.write.mode("overwrite").parquet(store.moves_path(spec, batch))


def changed_days(store: TableStore, spec: TableSpec, batch: str, column: str) -> DataFrame:
    """Days of ``column`` in which a batch has changed rows, as they were and as they are, for ``refresh_incremental``."""
    return store.moves(spec, batch).where(F.col(column).isNotNull()).select(column).distinct()


def merge_table(store: TableStore, spec: TableSpec, batch: str, keys: int, size: int, broadcast_limit: int, attempt: int) -> dict[str, int]:
    """Write the new contents of the touched folders to a folder of their own and count what changes.

    If the table has none of these folders, the staged rows are their new contents and are not written again; of the first
    load of a table, which reports are made from as a whole, no moves are kept.
    """
    small = size <= broadcast_limit
    staged, folders = store.staged(spec, batch), subfolders(store.spark, store.staging_path(spec, batch))
    existing = subfolders(store.spark, store.data_path(spec))
    inside = touched_part(store, spec, folders)
    # unless the keys are small, the join spreads what it shuffles over all tasks: it is gathered by folder again
    merged = upsert(inside, staged, spec.key, broadcast_keys=small, unique=True, gather=None if small else spec.layout.column,
                    words=0 if small else filter_words(keys, FILTER_LIMIT))
    target = store.merged_path(spec, batch)
    drop_folder(store.spark, target)
    if set(folders) & set(existing):
        store.write(merged, spec, f"{target}/rows")
    if existing:
        note_moves(store, spec, batch, inside, staged, small)
    folder_checks(store.merged(spec, batch), spec).coalesce(1).write.mode("overwrite").partitionBy(spec.layout.column).parquet(
        f"{target}/checks")
    touched = F.col(spec.layout.column).isin(*[F.lit(f.split("=", 1)[1]).cast(spec.layout.spark_type) for f in folders])
    none = F.lit(0).cast("bigint")
    new = store.spark.read.schema(checks_schema(spec)).parquet(f"{target}/checks").select(
        F.col("rows").alias("after"), none.alias("before"), none.alias("whole"))
    old = store.checks(spec).select(none, F.when(touched, F.col("rows")), "rows")
    after, before, whole = (x or 0 for x in new.union(old).agg(F.sum("after"), F.sum("before"), F.sum("whole")).first())
    inserted = after - before
    counts = {"staged": keys, "before": before, "affected": keys, "inserted": inserted, "updated": keys - inserted,
              "after": after, "table_before": whole, "table_after": whole + inserted, "attempt": attempt}
    note_step(store, batch, table_name=spec.name, step="merged", **counts)
    mark_ready(store.spark, target)
    return counts


def upsert_table(store: TableStore, spec: TableSpec, batch: str, done: dict, parent: TableSpec | None = None,
                 broadcast_limit: int = BROADCAST_LIMIT, on_conflict: str = "error") -> None:
    """Merge a staged batch and put it into its table, then drop what it staged. An empty batch is skipped."""
    store.finish_others(spec, batch)
    counts = done.get((spec.name, "merged"))
    if not _complete(store, spec, batch, counts):
        keys, size = measure_staged(spec, store.staged(spec, batch), unique=on_conflict == "latest")
        if keys == 0:
            whole = store.checks(spec).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            note_step(store, batch, table_name=spec.name, step="skipped", staged=0, before=0, affected=0, inserted=0, updated=0,
                      after=0, table_before=whole, table_after=whole)
            return
        if parent is not None:
            check_parent(store, spec, parent, store.staged(spec, batch), broadcast_limit)
        counts = merge_table(store, spec, batch, keys, size, broadcast_limit, 1 + (counts["attempt"] if counts else 0))
    if is_ready(store.spark, store.merged_path(spec, batch)):
        store.apply(spec, batch)
    note_step(store, batch, **{**counts, "table_name": spec.name, "step": "applied"})
    clear_batch(store, spec, batch)


def _complete(store: TableStore, spec: TableSpec, batch: str, counts: dict | None) -> bool:
    """Whether the batch's merge was completed: it waits to be put into the table, or is in it and gone already."""
    folder = store.merged_path(spec, batch)
    return counts is not None and (is_ready(store.spark, folder) or batch not in subfolders(store.spark, store.path("merged", spec.name)))


def clear_batch(store: TableStore, spec: TableSpec, batch: str) -> None:
    """Drop the staging rows of an applied batch."""
    store.drop("staging", spec.name, batch)


def upsert_all(store: TableStore, specs: Sequence[TableSpec], batch: str, rows_of, on_conflict: str = "error",
               broadcast_limit: int = BROADCAST_LIMIT, order: Sequence[str] | None = None,
               stored: Sequence[TableSpec] = ()) -> DataFrame:
    """Stage and upsert every table in the given order, parents first; returns the audit.

    ``rows_of(spec)`` gives a table's typed rows, with the columns of ``order`` for the policy ``latest``. Tables that
    are only referred to are given as ``stored``. Tables are written one by one: a failure leaves the earlier ones
    updated, and running the batch again goes on from there.
    """
    parents = parents_of(specs, stored)
    done = finished_steps(store, batch)
    for spec in specs:
        if (spec.name, "applied") in done:
            clear_batch(store, spec, batch)
        if (spec.name, "applied") in done or (spec.name, "skipped") in done:
            continue
        if not _complete(store, spec, batch, done.get((spec.name, "merged"))):
            stage_table(store, spec, rows_of(spec), batch, on_conflict, order)
        upsert_table(store, spec, batch, done, parents.get(spec.name), broadcast_limit, on_conflict)
    return audit(store, specs, batch)


def ingest_batch(store: TableStore, raw: DataFrame, specs: Sequence[TableSpec], batch: str,
                 date_header: str | None = None, on_conflict: str = "error", reports: Sequence[Report] = ()) -> DataFrame:
    """Raw rows to updated tables and the reports on them; returns the audit. Safe to run again with the same batch name."""
    if (WHOLE_BATCH, "sheet") not in finished_steps(store, batch):
        stage_sheet(store, raw, specs, batch, date_header)
    wide = read_if_there(store.spark, sheet_path(store, batch), wide_schema(specs, raw))
    result = upsert_all(store, specs, batch, lambda spec: narrow(wide, spec, batch_order(wide)), on_conflict)
    for report in reports:
        report.refresh(store, batch)
    store.drop("sheet", batch)
    return result


def unseen_files(store: TableStore, files: DataFrame, batch: str) -> DataFrame:
    """The files of a batch, given as ``path, modificationTime, content``, whose contents no finished batch has had.

    Contents are hashed in one pass, which keeps path and hash only; of files with equal contents the first by path counts.
    """
    known = read_if_there(store.spark, store.path("files"), FILES_SCHEMA).select("sha")
    hashed = with_hash(files).groupBy("sha").agg(F.min("path").alias("path"))
    hashed.join(known, "sha", "left_anti").write.mode("overwrite").parquet(store.path("incoming", batch))
    fresh = store.spark.read.schema("sha string, path string").parquet(store.path("incoming", batch)).select("path")
    size = fresh.agg(F.coalesce(F.sum(_octets(fresh, ["path"])), F.lit(0))).first()[0]
    return files.join(F.broadcast(fresh) if size <= BROADCAST_LIMIT else fresh, "path", "left_semi")


def ingest_files(store: TableStore, files: DataFrame, specs: Sequence[TableSpec], batch: str, date_header: str | None = None,
                 on_conflict: str = "error", reports: Sequence[Report] = (), header: int = 1) -> DataFrame:
    """Workbook files to updated tables, like :func:`ingest_batch`; a file that was sent again as it was is not decoded.

    So a file that is delivered twice changes nothing, even if its rows have been corrected by another one in between.
    """
    if (WHOLE_BATCH, "files") in finished_steps(store, batch):
        return audit(store, specs, batch)
    fresh = unseen_files(store, files, batch) if (WHOLE_BATCH, "sheet") not in finished_steps(store, batch) else files
    result = ingest_batch(store, decode_workbooks(fresh, header), specs, batch, date_header, on_conflict, reports)
    hashes = store.spark.read.schema("sha string, path string").parquet(store.path("incoming", batch))
    hashes.write.mode("overwrite").parquet(store.path("files", f"batch={batch}"))
    note_step(store, batch, table_name=WHOLE_BATCH, step="files")
    store.drop("incoming", batch)
    return result


def audit(store: TableStore, specs: Sequence[TableSpec], batch: str) -> DataFrame:
    """One row per table of a batch, in upsert order, with its status and counts.

    ``sheet_rows`` and ``valid_dates`` are those of the raw sheet, ``removed`` its rows without the table's key and
    ``copies`` the further ones that repeated a row or key; they are NULL for rows that came typed. ``before`` and ``after``
    count the touched folders, which is where all of the change lies, ``table_before`` and ``table_after`` the whole table.
    """
    steps = finished_steps(store, batch)
    sheet = steps.get((WHOLE_BATCH, "sheet"), {})
    rows = []
    for position, spec in enumerate(specs, start=1):
        step = next((s for s in ("applied", "skipped") if (spec.name, s) in steps), None)
        if step is None:
            continue
        counts, keyed = steps[spec.name, step], steps.get((spec.name, "typed"), {}).get("keyed")
        figures = {name: counts[name] for name in (
            "staged", "before", "affected", "inserted", "updated", "after", "table_before", "table_after")}
        rows.append(one_row(store.spark, AUDIT_SCHEMA, {
            "position": position, "table_name": spec.name, "title": spec.title, "status": step, "sheet_rows": sheet.get("rows"),
            "valid_dates": sheet.get("dated"), **figures,
            "removed": None if keyed is None else sheet["rows"] - keyed, "copies": None if keyed is None else keyed - counts["staged"]}))
    return reduce(DataFrame.unionByName, rows) if rows else no_rows(store.spark, AUDIT_SCHEMA)
