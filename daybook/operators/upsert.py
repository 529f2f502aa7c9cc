"""Keyed upsert: insert new keys, overwrite every other column of known ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.dedup import latest_per_key
from daybook.operators.projection import quoted


# The wording of the summary.
SUMMARY_START, SUMMARY_PART, SUMMARY_BETWEEN, SUMMARY_END = "Upsert completed: ", "%s=%d", ", ", " rows"


def _keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(k) for k in key]).distinct()


def one_version(staged: DataFrame, key: Sequence[str], on_conflict: str = "error",
                order: Sequence[str] = ()) -> DataFrame:
    """The staged rows, one per key. Two versions of a key stop the job (``error``), or the last by ``order`` stays."""
    if on_conflict == "latest":
        return latest_per_key(staged, key, order)
    if on_conflict != "error":
        raise ValueError(f"unknown conflict policy {on_conflict!r}")
    rest = [c for c in staged.columns if c not in key]
    row = F.struct(F.lit(1).alias("present"), *[quoted(c) for c in rest])
    counted = staged.groupBy(*[quoted(k) for k in key]).agg(F.min(row).alias("low"), F.max(row).alias("high"))
    same = F.col("low").eqNullSafe(F.col("high"))
    failed = F.raise_error(F.lit("a key has more than one version in the staged rows")).cast("boolean")
    return counted.filter(F.when(same, True).otherwise(failed)).select(
        *[F.col("low").getField(c).alias(c) if c in rest else quoted(c) for c in staged.columns])


# Keys per word of the filter: 16 bits each, of which four are set. More keys than ``CROWDED`` leave too few zeros.
ROOM, CROWDED, BITS, WORD_BYTES = 4, 16, 4, 32


def filter_words(keys: int, limit: int) -> int:
    """Words of a filter for so many keys, within a limit in bytes; none if it could not tell enough of them apart."""
    words = min(max(1, keys // ROOM), limit // WORD_BYTES)
    return words if words and keys <= CROWDED * words else 0


def _word_and_mask(key: Sequence[str], words: int) -> list[Column]:
    """The word of the filter that a key falls in, and the bits that it sets there."""
    columns = [quoted(k) for k in key]
    places = F.xxhash64(*columns, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(places, 6 * i).bitwiseAND(63).cast("int"))
            for i in range(BITS)]
    return [F.pmod(F.xxhash64(*columns), F.lit(words)).alias("word"), reduce(Column.bitwiseOR, bits).alias("mask")]


def key_filter(keys: DataFrame, key: Sequence[str], words: int) -> DataFrame:
    """A Bloom filter as a frame: ``word, bits``, each key's bits together in one word. No more rows than words."""
    return keys.select(*_word_and_mask(key, words)).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def with_maybe(df: DataFrame, key: Sequence[str], filter_: DataFrame, words: int, name: str = "maybe") -> DataFrame:
    """``df`` with a column that is false only for rows whose key is surely not in the filter. Nothing is shuffled."""
    marked = df.select("*", *_word_and_mask(key, words)).join(F.broadcast(filter_), "word", "left")
    found = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    return marked.select(*[quoted(c) for c in df.columns], found.alias(name))


def upsert(target: DataFrame, staged: DataFrame, key: Sequence[str], broadcast_keys: bool = False,
           unique: bool = False, on_conflict: str = "error", order: Sequence[str] = (), words: int = 0,
           gather: str | None = None) -> DataFrame:
    """Target rows whose key is not staged, plus the distinct staged rows. NULLs overwrite too.

    Only the staged keys meet the target. ``broadcast_keys`` is for callers that have measured those keys
    (see ``plans.batch``): the target then stays where it is. Otherwise Spark decides by its own size
    estimate and falls back to a shuffled join. With ``words`` (see :func:`filter_words`) a Bloom filter of the keys is
    broadcast first: rows that it rules out stay where they are, the others are joined exactly, so the result is the same.
    ``gather`` gathers what was shuffled by that column. If the staged rows hold two versions of a key, ``on_conflict``
    and ``order`` decide as in :func:`one_version`; ``unique`` says that there is one row per key already.
    """
    columns = [quoted(c) for c in target.columns]
    incoming = staged if unique else one_version(
        staged.select(*dict.fromkeys([*target.columns, *order])) if order else staged.select(*columns), key, on_conflict, order)
    keys = staged.select(*[quoted(k) for k in key])
    if not unique:
        keys = keys.distinct()
    if broadcast_keys:
        keys = F.broadcast(keys)
    stay = []
    if words and not broadcast_keys:
        marked = with_maybe(target, key, key_filter(keys, key, words), words)
        stay, target = [marked.filter(~F.col("maybe")).select(*columns)], marked.filter("maybe")
    moved = target.join(keys, list(key), "left_anti").select(*columns).unionByName(incoming.select(*columns))
    if gather:
        moved = moved.hint("rebalance", quoted(gather))
    return reduce(DataFrame.unionByName, stay, moved)


def changed_days(target: DataFrame, staged: DataFrame, key: Sequence[str], day: str) -> DataFrame:
    """Days of the rows that an upsert replaces and of those it brings, for an incremental refresh."""
    replaced = target.join(staged.select(*[quoted(k) for k in key]).distinct(), list(key), "left_semi")
    return replaced.select(quoted(day)).unionByName(staged.select(quoted(day))).distinct()


def upsert_stats(target: DataFrame, staged: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row ``affected, inserted, updated``. Rewrites with equal values count as updates."""
    incoming = _keys(staged, key)
    known = target.select(*[quoted(k) for k in key]).join(incoming, list(key), "left_semi")
    counts = incoming.agg(F.count(F.lit(1)).alias("affected"), F.lit(0).cast("bigint").alias("updated")).unionByName(
        known.agg(F.lit(0).cast("bigint").alias("affected"), F.count(F.lit(1)).alias("updated"))
    )
    return counts.agg(F.sum("affected").alias("affected"), F.sum("updated").alias("updated")).select(
        "affected", (F.col("affected") - F.col("updated")).alias("inserted"), "updated"
    )


def row_diff(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per key: inserted, updated, deleted or unchanged, comparing all other columns NULL-safely."""
    rest = [c for c in before.columns if c not in key]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[quoted(k) for k in key], F.struct(F.lit(1).alias("present"), *[quoted(c) for c in rest])
                         .alias(name))

    both = side(before, "old").join(side(after, "new"), list(key), "full")
    change: Column = (
        F.when(F.col("old").isNull(), "inserted")
        .when(F.col("new").isNull(), "deleted")
        .when(F.col("old").eqNullSafe(F.col("new")), "unchanged")
        .otherwise("updated")
    )
    return both.select(*[quoted(k) for k in key], change.alias("change"))


def first_row(df: DataFrame, *order: str) -> DataFrame:
    """The first row in key order: each task keeps one row, nothing is sorted as a whole."""
    return df.orderBy(*[quoted(c) for c in order]).limit(1)


def _counted(frames: dict[str, DataFrame | int], phase: str) -> DataFrame:
    if isinstance(frames[phase], int):
        session = next(f for f in frames.values() if isinstance(f, DataFrame)).sparkSession
        return session.range(0, 1, 1, 1).select(F.lit(frames[phase]).cast("bigint").alias("n"))
    return frames[phase].agg(F.count(F.lit(1)).alias("n"))


def table_audit(phases: dict[str, dict[str, DataFrame | int]]) -> DataFrame:
    """Row counts per table before and after, staged rows before and after, and the change.

    ``phases`` is ``{table: {"before": df, "after": df, "staged": df, "staged_after": df}}``. Each frame is
    counted where it lies; only the counts meet. A count stands for a frame that will be gone by then.
    """
    names = ("before", "after", "staged", "staged_after")
    counted = [
        _counted(frames, phase).select(F.lit(table).alias("table_name"), F.lit(phase).alias("phase"), "n")
        for table, frames in phases.items()
        for phase in names
        if phase in frames
    ]
    merged = reduce(DataFrame.unionByName, counted)
    per_phase = [F.coalesce(F.sum(F.when(F.col("phase") == p, F.col("n"))), F.lit(0)).alias(p) for p in names]
    return (
        merged.groupBy("table_name").agg(*per_phase)
        .withColumn("change", F.col("after") - F.col("before"))
        .withColumn("staging_cleared", F.col("staged_after") == 0)
    )


def summary_message(audit: DataFrame, title: str = "title", order: str = "position") -> DataFrame:
    """The audit in one line of text and the grand total. One row per table goes in, so it stays small."""
    part = F.format_string(SUMMARY_PART, F.col(title), F.col("affected"))
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), part.alias("text"))))
    text = F.array_join(F.transform(parts, lambda p: p["text"]), SUMMARY_BETWEEN)
    return audit.agg(
        F.concat(F.lit(SUMMARY_START), text, F.lit(SUMMARY_END)).alias("message"),
        F.sum("affected").alias("total_rows"),
    )
