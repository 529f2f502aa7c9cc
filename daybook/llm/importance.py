"""Target-distribution importance resampling: documents drawn by how much their words resemble a target's.

Features are the runs of up to so many words; each falls in a bucket by the CRC-32 of its bytes. A bucket's gain is the log
ratio of its smoothed shares in the target and in the corpus, a document's weight the mean gain of its features. Gumbel
noise from a hash of the id is added to the weight, and the highest scores are drawn, which is a sample without
replacement in proportion to the exponential of the weights.

Two passes over the texts: one counts buckets (each task hands on one sum per bucket), one weighs documents. All that the
driver sees is one number per bucket. Scores are whole numbers of a bounded range, so a histogram by score gives the
lowest one that can be drawn; only documents from there on are sorted, by ranges, and numbered by partition and place.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm import crc
from daybook.llm.common import pick, stored, unpack

#: Fixed values of the contract.
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED, SCALE = 10_000, 1, 20, 10, "2024", 1000


def _codes() -> np.ndarray:
    """Bytes of words with A-Z in lower case; all others are zero. Bytes beyond ASCII belong to words."""
    table = np.zeros(256, dtype=np.uint8)
    table[128:] = np.arange(128, 256)
    for letter in string.digits + string.ascii_letters:
        table[ord(letter)] = ord(letter.lower())
    return table


CODES = _codes()


def features(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature of the texts of a column, text by text, and how many features each text has."""
    texts = column.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    codes = CODES[data[offsets[0]:offsets[-1]]]
    bounds = offsets - offsets[0]
    edge = np.zeros(len(codes) + 1, dtype=bool)
    edge[bounds] = True
    inside = np.zeros(len(codes) + 2, dtype=bool)
    np.not_equal(codes, 0, out=inside[1:-1])
    # a word ends where it meets no further byte of a word, or the end of its text
    starts = np.nonzero(inside[1:] & (~inside[:-1] | edge))[0]
    ends = np.nonzero(inside[:-1] & (~inside[1:] | edge))[0]
    places = np.searchsorted(starts, bounds)
    own = crc.sums(codes, starts, ends)
    runs, lengths, sums = [], ends - starts, own
    reach = lengths.copy()
    last = np.repeat(places[1:], np.diff(places)) - np.arange(len(starts))  # words from here to the end of the text
    for words in range(1, longest + 1):
        if words > 1:  # the run so far, a blank, the next word
            fits = np.nonzero(last >= words)[0]
            following = fits + words - 1
            step = lengths[following] + 1
            grown = crc.moved(sums[fits], step) ^ crc.moved(np.full(len(fits), crc.POSITION[32], dtype=np.uint32), step - 1) ^ own[following]
            sums, reach = sums.copy(), reach.copy()
            sums[fits], reach[fits] = grown, reach[fits] + step
        else:
            fits = np.arange(len(starts))
        runs.append((fits, (sums[fits] ^ crc.constants(reach[fits])) % np.uint32(buckets)))
    if longest == 1:
        return runs[0][1], np.diff(places)
    at, found = (np.concatenate(part) for part in zip(*runs))
    order = np.argsort(at, kind="stable")
    return found[order], np.diff(np.searchsorted(at[order], places))


def _count(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        if batch.num_rows:
            total += np.bincount(features(batch.column(0), longest, buckets)[0], minlength=buckets)
    seen = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "n"])


def counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> list[int]:
    """Features per bucket over all rows of ``texts`` (one column, never null)."""
    found = texts.mapInArrow(partial(_count, longest=longest, buckets=buckets), "bucket int, n long")
    total = [0] * buckets
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row per bucket
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: list[int], target: list[int], scale: int = SCALE) -> list[int]:
    held, wanted, buckets = sum(corpus), sum(target), len(corpus)
    return [math.floor(scale * math.log((t + 1) * (held + buckets) / ((s + 1) * (wanted + buckets))))
            for s, t in zip(corpus, target)]


def _weigh(batches: Iterator[pa.RecordBatch], worth: list[int], longest: int) -> Iterator[pa.RecordBatch]:
    table = np.array(worth, dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        found, n = features(batch.column(2), longest, len(worth))
        upto = np.concatenate([[0], np.cumsum(table[found])])
        ends = np.cumsum(n)
        weight = (upto[ends] - upto[ends - n]) // np.maximum(n, 1)
        words = n if longest == 1 else features(batch.column(2), 1, len(worth))[1]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, pa.int64()) for x in (n, words, weight)]],
                                         ["doc_id", "at", "n_features", "n_words", "weight"])


def noise(doc_id: Column, seed: str = SEED, scale: int = SCALE) -> Column:
    """Gumbel noise from a hash of the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _scored(texts: DataFrame, target: DataFrame, longest: int, buckets: int, seed: str) -> DataFrame:
    """``doc_id, at, n_features, n_words, weight, score`` of rows ``doc_id, at, text``."""
    worth = gains(counts(texts.select("text"), longest, buckets), counts(target, longest, buckets))
    weighed = texts.select("doc_id", "at", "text").mapInArrow(
        partial(_weigh, worth=worth, longest=longest), "doc_id long, at long, n_features long, n_words long, weight long")
    return stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")


def _drawn(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """The scored rows with their ``rank``."""
    fit = scored.where(F.col("n_words") >= least_words)
    down = W.orderBy(F.desc("score"))  # over one row per score: they lie within the logarithms of 64-bit counts
    histogram = fit.groupBy("score").agg(F.count(F.lit(1)).alias("n")).select(
        "score", F.sum("n").over(down).alias("upto"), F.sum("n").over(W.partitionBy()).alias("all"))
    wanted = F.expr(f"all * {percent} div 100")
    found = histogram.where((F.col("upto") - wanted >= 0) & (wanted > 0)).agg(F.max("score"), F.max(wanted)).first()
    if found[0] is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = (F.col("n_words") >= least_words) & (F.col("score") >= found[0])
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("at")]
    sorted_rows = stored(scored.where(near).repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "drawn").withColumn("part", F.shiftright("place", 33))
    parts = sorted_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))  # one row per partition
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = sorted_rows.join(F.broadcast(parts), "part").select(
        *scored.columns, F.when(rank <= found[1], rank).alias("rank"))
    return ranked.union(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))


def _texts(frame: DataFrame) -> Column:
    return F.coalesce(F.col("text"), F.lit("")).alias("text")


def weights(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT,
            least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs`` (``doc_id``, ``text``); ``target`` has ``text``.

    ``rank`` counts from 1 through the drawn rows, by score, ties by id, and is null for the others. Null texts count as
    empty and have weight 0; null ids share one noise and come last in ties; rows that repeat count, are scored and drawn
    as often as they come. Very long texts are read whole, and so are words longer than a block. An empty target leaves
    the corpus's own counts to decide; an empty table gives an empty one. Other columns are not read.
    """
    own = pick(docs, {"doc_id": "long", "text": "string"}).select("doc_id", F.monotonically_increasing_id().alias("at"), _texts(docs))
    scored = _scored(own, pick(target, {"text": "string"}).select(_texts(target)), longest, buckets, seed)
    return _drawn(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """The drawn rows of ``docs`` themselves, all columns kept, in no order; the rest as in :func:`weights`."""
    kept = stored(pick(docs, {"doc_id": "long", "text": "string"}, row=True).select(
        "doc_id", "row", F.monotonically_increasing_id().alias("at"), _texts(docs)), "resampled")
    scored = _scored(kept, pick(target, {"text": "string"}).select(_texts(target)), longest, buckets, seed)
    drawn = _drawn(scored, percent, least_words).where("rank IS NOT NULL").select("at")
    return unpack(kept.join(drawn, "at", "left_semi"), docs.columns)
