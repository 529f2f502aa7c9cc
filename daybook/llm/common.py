"""What the corpus operators share: columns by exact name, rows kept aside, tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import shared_folder

#: White space of the contracts, as a character class: blank, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]"


_caches: dict[str, dict] = {}


def only_cache(name: str, cache: dict) -> dict:
    """``cache`` as the one that a Python worker keeps: workers serve one operator after the other, and each remembers
    words of its own, so those of the others are let go."""
    for other, kept in _caches.items():
        if other != name:
            kept.clear()
    _caches[name] = cache
    return cache


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def pick(frame: DataFrame, wanted: dict[str, str], row: bool = False) -> DataFrame:
    """The wanted columns (new name -> type) by their exact names, whatever else the frame holds.

    With ``row`` all columns are kept beside them in a struct that ``unpack`` turns back. Columns are taken by place, so
    that names which differ in case only do not clash.
    """
    plain = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    places = {name: frame.columns.index(name) for name in wanted}
    columns = [F.col(f"c{places[name]}").cast(kind).alias(name) for name, kind in wanted.items()]
    if row:
        columns.append(F.struct(*plain.columns).alias("row"))
    return plain.select(*columns)


def kept(names: list[str], name: str) -> Column:
    """A column of the frame that ``pick`` kept in ``row``, by its exact name."""
    return F.col("row")[f"c{names.index(name)}"]


def unpack(frame: DataFrame, names: list[str], changed: dict[str, Column] | None = None) -> DataFrame:
    """The frame that ``pick`` kept in ``row``; ``changed`` columns get new values of the old type."""
    kinds = {field.name: field.dataType for field in frame.schema["row"].dataType.fields}
    columns = []
    for i, name in enumerate(names):
        old = F.col("row")[f"c{i}"]
        columns.append((changed[name].cast(kinds[f"c{i}"]) if changed and name in changed else old).alias(f"c{i}"))
    return frame.select(*columns).toDF(*names)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder of the session and read again: a cut lineage that outlives executors."""
    path = shared_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, without the empty strings that splitting leaves at its ends."""
    return F.filter(F.split(text, BLANK + "+"), lambda word: word != "")
