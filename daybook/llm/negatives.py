"""Hard-negative mining: for each anchor and positive, the best rows of other labels that score within a window below it.

An anchor's positives are few, and the upper limits of their windows split the scores into disjoint slots. While a task
reads its rows it keeps the best few per anchor and slot, and only these are handed on and merged. A window reaches from
its limit down, so its answer is the best few of all slots from its own on: one descending merge of an anchor's slots
serves all its windows, however they overlap. The lower limit comes last, as what it cuts off is at the end.

Anchors are a stated query set and meet all rows in blocks of ``BLOCK``: per block one pass for the positives, one for the
slots, and the result is written before the next block. A block's anchors and their limits are all that the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import pick
from daybook.session import shared_folder

#: Fixed values of the contract: anchors, positives and negatives; the window in hundredths of the positive's score; the
#: scale of components; every so manieth row has its label moved on by one.
EVERY, POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 50, 5, 3, 50, 95, 256
MOVED, LABELS = 7, 10
#: Anchors per pass, and products that a task holds at once.
BLOCK, CELLS = 4096, 1 << 20
#: Less than any score.
NONE = -(1 << 62)
RESULT = {"anchor_id": "long", "positive_id": "long", "rank": "int", "negative_id": "long", "positive_score": "long",
          "negative_score": "long"}


def participants(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part, labels moved on where that is asked for."""
    rows = pick(embeddings, {"vec_id": "long", "label": "long", "embedding": "array<double>"})
    known = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(known).withColumn(
        "label", F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")))


def whole(column: pa.ListArray, width: int) -> np.ndarray:
    """The scaled vectors as rows of a matrix; shorter ones are filled up with zeros."""
    lengths = np.asarray(column.value_lengths())
    values = np.floor(SCALE * np.asarray(column.flatten(), dtype=np.float64))
    width = max(width, int(lengths.max(initial=0)))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width))
    matrix[np.arange(width) < lengths[:, None]] = values
    return matrix


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: by way of doubles while these hold all sums."""
    width = min(rows.shape[1], anchors.shape[1])  # what is missing is zero
    rows, anchors = rows[:, :width], anchors[:, :width]
    most = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * width
    if most >= 2.0 ** 62:
        raise OverflowError("a score may be beyond 64 bits")
    return (rows @ anchors.T).astype(np.int64) if most < 2.0 ** 53 else rows.astype(np.int64) @ anchors.astype(np.int64).T


class Tops:
    """The best ``k`` of each group by score, then smaller id."""

    def __init__(self, groups: int, k: int):
        self.scores = np.full((groups, k), NONE)
        self.ids = np.zeros((groups, k), dtype=np.int64)

    @property
    def least(self) -> np.ndarray:
        """What a score must reach to be among the best of each group."""
        return self.scores[:, -1]

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, k = np.unique(group), self.scores.shape[1]
        group = np.concatenate([group, np.repeat(touched, k)])
        score = np.concatenate([score, self.scores[touched].ravel()])
        ids = np.concatenate([ids, self.ids[touched].ravel()])
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        best = place < k
        self.scores[group[best], place[best]], self.ids[group[best], place[best]] = score[best], ids[best]

    def filled(self) -> pa.RecordBatch:
        group, place = np.nonzero(self.scores > NONE)
        columns = [group.astype(np.int64), self.scores[group, place], self.ids[group, place]]
        return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["at", "score", "id"])


def _chunks(batches: Iterator[pa.RecordBatch], anchors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and products of a few rows at a time."""
    step = max(1, CELLS // len(anchors))
    for batch in batches:
        for low in range(0, batch.num_rows, step):
            part = batch.slice(low, step)
            yield (np.asarray(part.column(0)), np.asarray(part.column(1)),
                   products(whole(part.column(2), anchors.shape[1]), anchors))


def _near(block: Broadcast):
    """Each task's best rows of the anchor's own label."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors, k = block.value
        tops = Tops(len(ids), k)
        for vec, label, score in _chunks(batches, anchors):
            row, at = np.nonzero((label[:, None] == labels) & (vec[:, None] != ids) & (score >= tops.least))
            if len(row):
                tops.offer(at, score[row, at], vec[row])
        yield tops.filled()
    return find


def _slotted(block: Broadcast):
    """Each task's best rows of other labels, per anchor and slot; ``at`` counts both."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, anchors, upper, lowest, k = block.value
        slots = upper.shape[1]
        tops = Tops(len(ids) * slots, k)
        below = np.concatenate([upper[:, 1:], np.full((len(ids), 1), NONE)], axis=1)
        for vec, label, score in _chunks(batches, anchors):
            other = (label[:, None] != labels) & (vec[:, None] != ids) & (score >= lowest) & (score <= upper[:, 0])
            for slot in range(slots):
                row, at = np.nonzero(other & (score <= upper[:, slot]) & (score > below[:, slot]) & (score >= tops.least[slot::slots]))
                if len(row):
                    tops.offer(at * slots + slot, score[row, at], vec[row])
        yield tops.filled()
    return find


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per group; Spark cuts down to them before the shuffle already."""
    order = W.partitionBy("at").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(embeddings: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over all rows of ``embeddings``
    (``vec_id``, ``label``, ``embedding``).

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Vectors of unequal length
    are compared as if the shorter were filled up with zeros. Ties go to the smaller id. Rows with the anchor's own id are
    neither its positives nor its negatives; any other row that repeats takes places as often as it comes, and anchors that
    repeat in full count once. An anchor without positives, or a positive without negatives, has no row; an empty table
    gives an empty one. Other columns are not read. Scores are exact; one beyond 64 bits stops the job.
    """
    spark = embeddings.sparkSession
    rows = participants(embeddings)
    path, found = shared_folder(spark, "anchors"), shared_folder(spark, "negatives")
    chosen = rows.where(F.col("vec_id") % every == 0).distinct()
    stored_anchors = f"{path}/rows"
    chosen.write.parquet(stored_anchors)
    anchors = spark.read.schema(chosen.schema).parquet(stored_anchors)
    blocks = max(1, -(-anchors.count() // BLOCK))
    number = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(blocks)).cast("int").alias("block")
    anchors.select("*", number).hint("rebalance", F.col("block")).write.partitionBy("block").parquet(f"{path}/blocks")
    spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(kind).alias(name) for name, kind in RESULT.items()]).write.parquet(found)
    for block in range(blocks):
        own = spark.read.schema(chosen.schema).parquet(f"{path}/blocks/block={block}").toArrow().combine_chunks() if (
            anchors.where(number == block).limit(1).count()) else None
        if own is not None:
            _mine_block(rows, own, positives, negatives, low, high).write.mode("append").parquet(found)
    return spark.read.schema(", ".join(f"{name} {kind}" for name, kind in RESULT.items())).parquet(found)


def _mine_block(rows: DataFrame, anchors: pa.Table, k: int, negatives: int, low: int, high: int) -> DataFrame:
    spark, found = rows.sparkSession, "at long, score long, id long"
    ids, labels = (np.asarray(anchors.column(c)) for c in ("vec_id", "label"))
    vectors = whole(anchors.column("embedding").combine_chunks(), 0)
    near = _best(rows.mapInArrow(_near(spark.sparkContext.broadcast((ids, labels, vectors, k))), found), k).collect()  # k per anchor

    upper, lowest = np.full((len(ids), k), NONE), np.full(len(ids), -NONE)
    windows = [(-1, 0, 0, 0, 0, 0)]
    for row in near:
        most, least = row["score"] * high // 100, -(row["score"] * -low // 100)
        upper[row["at"], row["place"] - 1] = most
        lowest[row["at"]] = min(lowest[row["at"]], least)
        windows.append((row["at"], int(ids[row["at"]]), row["place"] - 1, row["id"], row["score"], least))
    slots = _best(rows.mapInArrow(_slotted(spark.sparkContext.broadcast((ids, labels, vectors, upper, lowest, negatives))), found), negatives)
    merged = slots.groupBy(F.expr(f"at div {k}").alias("anchor")).agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("order"), F.col("id"), (F.col("at") % k).alias("slot")))).alias("tops"))  # some per slot
    asked = spark.createDataFrame(windows, "anchor long, anchor_id long, slot int, positive_id long, positive_score long, least long")
    own = F.slice(F.filter("tops", lambda t: t["slot"] >= F.col("slot")), 1, negatives)
    answers = asked.join(merged, "anchor").select("*", F.posexplode(F.filter(own, lambda t: -t["order"] >= F.col("least"))).alias("n", "top"))
    return answers.select("anchor_id", "positive_id", (F.col("n") + 1).cast("int").alias("rank"), F.col("top.id").alias("negative_id"),
                          "positive_score", (-F.col("top.order")).alias("negative_score"))
