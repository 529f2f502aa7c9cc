"""New files to updated tables, each exactly once.

The file source remembers which files it has handed out; the table of batches, kept beside that memory in the
checkpoint folder, remembers which steps of a micro-batch are done. A micro-batch that is run again after a
crash therefore changes nothing twice. Corrections of any age simply overwrite: no watermark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from daybook.plans.batch import ingest_batch, ingest_files
from daybook.plans.refresh import Report
from daybook.sources.tables import TableStore
from daybook.specs import TableSpec


def ingest_stream(raw: DataFrame, store: TableStore, specs: Sequence[TableSpec], checkpoint: str,
                  date_header: str | None = None, on_conflict: str = "latest", reports: Sequence[Report] = ()) -> StreamingQuery:
    """Start a run over all files that are new since the last run; it ends when they are done.

    ``raw`` is a streaming frame of untyped rows, such as ``workbook_stream``, or of files (``file_stream``), of which those
    that were sent before as they are do not get decoded again. Within one micro-batch the newest file wins by default, as if
    the files had been taken one by one. ``reports`` are brought up to each micro-batch.
    """
    take = ingest_files if "content" in raw.columns else ingest_batch
    own = replace(store, batches=f"{checkpoint.rstrip('/')}/batches")
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]  # keeps the batches of two streams apart

    def apply(rows: DataFrame, number: int) -> None:
        take(own, rows, specs, f"{stream}-{number:08d}", date_header, on_conflict, reports)

    return (raw.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
