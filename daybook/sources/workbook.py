"""Workbook scan: many xlsx files in, one frame of untyped sheet rows out.

Spark lists the files and spreads them over tasks; a task decodes its workbooks one after the other and
streams their rows in Arrow batches. The file format itself limits a sheet to 1,048,576 rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.cells import header_names, sheet_rows

# Sheets differ in their headers, so the cells are a map; a missing header reads as NULL.
RAW_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modified", T.TimestampType(), True),
    T.StructField("row_no", T.IntegerType(), False),
    T.StructField("cells", T.MapType(T.StringType(), T.StringType(), True), False),
    T.StructField("error", T.StringType(), True),
])
# Workbook files by their suffix, whatever its case.
WORKBOOK_GLOB, WORKBOOK_NAME = "*.[xX][lL][sS][xXmM]", r"(?i)\.xls[xm]$"
ROWS_PER_BATCH = 4096
# Batches of a sheet that wait until the rest has proved readable; a longer sheet is read through once before.
BATCHES_HELD = 16
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"

_CELLS = pa.map_(pa.string(), pa.string())


def _data_rows(content: bytes, header: int) -> Iterator[tuple[int, list[tuple[str, str | None]]]]:
    """Rows below the header row, every header present. Blank rows count if a filled one follows.

    A column without a header that first shows up further down is numbered like a blank header.
    """
    names: list[str] = header_names({}, 0)
    title: dict[int, str] = {}
    next_row = header + 1
    for position, row in sheet_rows(content):
        if position < header:
            continue
        if position == header:
            title = row
            names = header_names(title, max(row) + 1)
            continue
        if max(row) >= len(names):
            names = header_names(title, max(row) + 1)
        for blank in range(next_row, position):
            yield blank, [(name, None) for name in names]
        yield position, [(name, row.get(i)) for i, name in enumerate(names)]
        next_row = position + 1


def decode_workbooks(files: DataFrame, header: int = 1) -> DataFrame:
    """Sheet rows of workbooks given as ``path, modificationTime, content``, header on row index ``header``.

    A file that cannot be read gives one row without cells, its ``error`` set and ``row_no`` -1, and no other row: its
    rows go out when the last has been decoded. Of a long sheet no more than ``BATCHES_HELD`` batches are held for that.
    """
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, modified = batch.column("path")[i], batch.column("modificationTime")[i]
                content = batch.column("content")[i].as_py()
                try:
                    held, more = _held(path, modified, content, header)
                except Exception as broken:  # whatever a broken file makes the decoder raise, it is that file's fault
                    held, more = [_raw_batch(path, modified, [-1], [[]], f"{type(broken).__name__}: {broken}")], False
                yield from held
                if more:
                    yield from islice(_sheet_batches(path, modified, content, header), len(held), None)

    return files.select("path", "modificationTime", "content").mapInArrow(decode, RAW_SCHEMA)


def _held(path, modified, content: bytes, header: int) -> tuple[list[pa.RecordBatch], bool]:
    """The first batches of a sheet, and whether there are more; raises unless the whole sheet can be read."""
    batches = _sheet_batches(path, modified, content, header)
    held = list(islice(batches, BATCHES_HELD))
    return held, sum(1 for _ in batches) > 0


def _sheet_batches(path, modified, content: bytes, header: int) -> Iterator[pa.RecordBatch]:
    numbers: list[int] = []
    cells: list[list[tuple[str, str | None]]] = []
    for row_no, row in _data_rows(content, header):
        numbers.append(row_no - header - 1)
        cells.append(row)
        if len(numbers) == ROWS_PER_BATCH:
            yield _raw_batch(path, modified, numbers, cells)
            numbers, cells = [], []
    if numbers:
        yield _raw_batch(path, modified, numbers, cells)


def _raw_batch(path, modified, numbers, cells, error: str | None = None) -> pa.RecordBatch:
    n = len(numbers)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(path, n), pa.repeat(modified, n), pa.array(numbers, pa.int32()), pa.array(cells, _CELLS),
         pa.array([error] * n, pa.string())],
        names=RAW_SCHEMA.names,
    )


def read_workbooks(spark: SparkSession, paths: str | Sequence[str], header: int = 1, encoded: bool = False) -> DataFrame:
    """Sheet rows of all workbooks that match ``paths`` (files, folders or globs), ``encoded`` as in storage events or not."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", WORKBOOK_GLOB).load(_named(paths, encoded))
    return decode_workbooks(files, header)


def unread_files(spark: SparkSession, paths: str | Sequence[str], raw: DataFrame | None = None,
                 encoded: bool = False) -> DataFrame:
    """``path, reason`` of every file that gave no rows: not named as a workbook, or, given its ``raw`` rows, broken.

    Files that are no workbooks are listed, not opened.
    """
    every = spark.read.format("binaryFile").load(_named(paths, encoded)).select("path")
    other = every.where(~F.col("path").rlike(WORKBOOK_NAME)).select("path", F.lit("not named as a workbook").alias("reason"))
    if raw is None:
        return other
    return other.unionByName(raw.where("error IS NOT NULL").select("path", F.col("error").alias("reason")))


def _named(paths: str | Sequence[str], encoded: bool) -> str | list[str]:
    """Paths for the reader; storage events give them percent-encoded."""
    if not encoded:
        return paths if isinstance(paths, str) else list(paths)
    return unquote(paths) if isinstance(paths, str) else [unquote(p) for p in paths]


def file_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Workbook files as they arrive in ``folder``, not decoded: ``streaming.ingest_stream`` leaves out those it has had."""
    reader = spark.readStream.format("binaryFile").schema(FILE_COLUMNS).option(
        "pathGlobFilter", WORKBOOK_GLOB)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def workbook_stream(spark: SparkSession, folder: str, header: int = 1, max_files: int | None = None) -> DataFrame:
    """Sheet rows of workbooks as they arrive in ``folder``."""
    return decode_workbooks(file_stream(spark, folder, max_files), header)


def with_hash(files: DataFrame) -> DataFrame:
    """Files with the SHA-256 of their contents: the same bytes under another name are the same workbook."""
    return files.withColumn("sha", F.sha2("content", 256))
