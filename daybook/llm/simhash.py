"""SimHash near-duplicates: fingerprints of whole texts, bit-sliced comparison, connected components.

Fingerprints within ``RADIUS`` bits agree on at least two of four 16-bit bands, so each distinct fingerprint is dealt to
the six pairs of bands. Within such a bucket members stand in blocks of 64 lanes; a block holds one machine word per bit
position (a vertical bit plane). A query is compared with a whole block at once: its bit, spread over the lanes, is XORed
with each plane, and carry-save counters add the 64 results up. A block in which all lanes exceed the radius is abandoned.
Buckets beyond ``SPLIT`` fingerprints are dealt out in pairs of parts, so no task meets one as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import pick, stored, unpack
from daybook.llm.graph import components

RADIUS = 2
SPLIT = 4096
#: Shingles whose bits are counted at once; bounds the memory for very long texts.
CHUNK = 1 << 15
#: Query-block comparisons made at once.
UNITS = 4096


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:])) if len(words) > 2 else [b" ".join(words)]
    hashes = np.fromiter(map(_HASH, shingles), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">u8")[0])


_HASH = partial(xxhash.xxh64_intdigest, seed=42)
_LOWER = bytes(range(256)).lower()


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(text) for text in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(prints.view(np.int64), type=pa.int64())],
            names=["doc_id", "mark", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, print`` for each row of ``docs``: a hash of the text, and the fingerprint as a signed long."""
    texts = pick(docs, {"doc_id": "long", "text": "string"}).withColumn("mark", F.xxhash64("text"))
    return texts.mapInArrow(_fingerprint_batches, "doc_id long, mark long, print long")


def _planes(lanes: np.ndarray) -> np.ndarray:
    """Blocks of 64 fingerprints each -> blocks of 64 bit planes; lane k of a plane is its bit k."""
    bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.transpose(0, 2, 1)), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").reshape(-1, 64)


def _near_lanes(planes: np.ndarray, queries: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query and the block it is held against: the lanes within the radius, as a mask. Empty masks are dropped."""
    where = np.arange(len(queries))
    ones = np.zeros(len(queries), dtype=np.uint64)
    twos, more = ones.copy(), ones.copy()
    bits = np.arange(64, dtype=np.uint64)
    for step in range(0, 64, 8):
        spread = -((queries[where, None] >> bits[step:step + 8]) & np.uint64(1)).astype(np.int64)
        unlike = planes[block[where], step:step + 8] ^ spread.view(np.uint64)
        for k in range(unlike.shape[1]):
            carry = ones & unlike[:, k]
            ones ^= unlike[:, k]
            more |= twos & carry
            twos ^= carry
        alive = (more | (ones & twos)) != np.uint64(0xFFFFFFFFFFFFFFFF)
        if not alive.all():
            where, ones, twos, more = where[alive], ones[alive], twos[alive], more[alive]
        if not len(where):
            break
    return where, ~(more | (ones & twos))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n indices is linked to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def links(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of each run ``starts[k]:ends[k]``: places of two ends, enough to connect all near ones."""
    starts, ends = starts[ends - starts > 1], ends[ends - starts > 1]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blocks = -(-(ends - starts) // 64)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    place = np.repeat(starts, blocks) + 64 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    size = np.minimum(64, np.repeat(ends, blocks) - place)
    lanes = place[:, None] + np.minimum(np.arange(64), size[:, None] - 1)
    planes = _planes(prints[lanes])
    tos, froms = [], []
    pairs = 0
    for query, block in _units(starts, ends, first, place):
        where, mask = _near_lanes(planes, prints[query], block)
        hit = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)
        row, lane = np.nonzero(hit)
        tos.append(query[where[row]])
        froms.append(lanes[block[where[row]], lane])
        pairs += len(row)
        if pairs > 1 << 20:  # many links: keep a star for each connected part
            root = _roots(len(prints), np.concatenate(tos), np.concatenate(froms))
            linked = np.nonzero(root != np.arange(len(prints)))[0]
            tos, froms, pairs = [linked], [root[linked]], 0
    root = _roots(len(prints), np.concatenate(tos), np.concatenate(froms))
    linked = np.nonzero(root != np.arange(len(prints)))[0]
    return linked, root[linked]


def _units(starts, ends, first, place) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries and the blocks to hold them against: each member of a run against its own block and all later ones."""
    query, block, n = [], [], 0
    for start, end, at in zip(starts.tolist(), ends.tolist(), first.tolist()):
        for own in range(-(-(end - start) // 64)):
            members = np.arange(start + 64 * own, min(end, start + 64 * own + 64))
            against = np.arange(at + own, at - (-(end - start) // 64))
            query.append(np.repeat(members, len(against)))
            block.append(np.tile(against, len(members)))
            n += len(query[-1])
            if n >= UNITS:
                yield np.concatenate(query), np.concatenate(block)
                query, block, n = [], [], 0
    if n:
        yield np.concatenate(query), np.concatenate(block)


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> links. A bucket that goes on in the next batch is carried over; it has two parts at most."""
    keys, prints = np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)

    def out(upto: int) -> pa.RecordBatch:
        own = keys[:upto]
        cut = np.nonzero((own[1:] != own[:-1]).any(axis=1))[0] + 1
        a, b = links(prints[:upto], np.concatenate(([0], cut)), np.concatenate((cut, [upto])))
        return pa.RecordBatch.from_arrays([pa.array(prints[x].view(np.int64)) for x in (a, b)], names=["a", "b"])

    for batch in batches:
        columns = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("bands", "bucket", "part", "print")]
        keys = np.concatenate((keys, np.column_stack([c.astype(np.int64) for c in columns[:3]])))
        prints = np.concatenate((prints, np.ascontiguousarray(columns[3]).view(np.uint64)))
        if not len(keys):
            continue
        open_from = len(keys) - np.argmax((keys[::-1] != keys[-1]).any(axis=1)) if (keys != keys[-1]).any() else 0
        if open_from:
            yield out(open_from)
            keys, prints = keys[open_from:], prints[open_from:]
    if len(keys):
        yield out(len(keys))


def near_links(prints: DataFrame, split: int = SPLIT) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct fingerprints ``print`` within the radius of one another."""
    band = [F.shiftrightunsigned("print", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    pairs = [(i, j) for i in range(4) for j in range(i)]
    keyed = prints.select("print", F.inline(F.array(*[
        F.struct(F.lit(k).alias("bands"), (band[i] * 65536 + band[j]).alias("bucket")) for k, (i, j) in enumerate(pairs)])))
    large = stored(keyed.groupBy("bands", "bucket").count().where(F.col("count") > split).select(
        "bands", "bucket", F.ceil(F.col("count") / split).cast("int").alias("parts")), "large-buckets")
    if large.isEmpty():
        dealt = keyed.withColumn("part", F.lit(0).cast("long"))
    else:
        own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
        dealt = keyed.join(large, ["bands", "bucket"], "left").withColumn("parts", F.coalesce("parts", F.lit(1))).select(
            "print", "bands", "bucket", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        dealt = dealt.select("print", "bands", "bucket", (
            F.greatest("own", "other").cast("long") * 2**31 + F.least("own", "other")).alias("part"))
    return dealt.repartition("bands", "bucket", "part").sortWithinPartitions("bands", "bucket", "part").mapInArrow(
        _link_batches, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, print, root, component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    ``root`` is the smallest fingerprint of the class, ``component_id`` its smallest document id. Null text counts as
    empty, and empty texts are linked like any other (fingerprint zero). Rows with a null id get a class like the others;
    its id is null if no member has one. Repeated rows come out repeated. An empty table gives an empty one.
    """
    marked = stored(fingerprints(docs), "fingerprints")
    lowest = marked.groupBy("print").agg(F.min("doc_id").alias("low"))
    roots = components(near_links(lowest.select("print")))
    named = lowest.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "low", F.coalesce("root", "print").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    owners = stored(named.select("print", "root").join(least, "root").select("print", "root", "component_id"), "owners")
    return marked.join(owners, "print").select("doc_id", "mark", "print", "root", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each class stays, with all its columns: that of the smallest id.

    Rows with a null id come last; of rows with the same id that of the smallest text hash stays, once. Null texts count as
    empty; very long texts are rows like others, an empty table gives an empty one.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")).alias("first")
    chosen = classes(docs).groupBy("root").agg(first).select(*_key(F.col("first.doc_id"), F.col("first.mark")))
    whole = pick(docs, {"doc_id": "long", "text": "string"}, row=True).select(*_key(F.col("doc_id"), F.xxhash64("text")), "row")
    # the same columns without nulls serve the join and the grouping, so the texts move once
    single = whole.join(chosen, KEY, "left_semi").groupBy(*KEY).agg(F.first("row").alias("row"))
    return unpack(single, docs.columns)


KEY = ["id", "unnamed", "mark"]


def _key(doc_id: Column, mark: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("unnamed"), F.coalesce(mark, F.lit(0)).alias("mark")]
