"""Best-fit packing of tokenised documents into sequences, after Martello and Toth's dominance reduction.

Lengths are whole numbers up to the capacity, so the whole instance is the number of pieces of each length. That
histogram, at most one entry per length however large the corpus, is all the driver sees. Dominance first fixes sets
that are at least as good as any other choice for their largest piece; the shrunk rest goes best-fit, longest first. Both
work on counts: a decision holds for as many bins at once as there are equal pieces. The plan is a table of runs (so many
pieces of one length, from this rank on, go to consecutive bins at this offset), bounded by the capacity as well. Each
piece finds its run by its rank among the pieces of its length: a running number within its task plus the count in
earlier tasks.
"""

from __future__ import annotations

import os
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import only_cache, pick, stored

CAPACITY = 2048
#: Id after each document.
END = 0
#: Words whose ids a Python worker remembers; on overflow it keeps those that it learned first.
REMEMBERED, COMMON = 500_000, 250_000
#: Words of the texts that are looked through for new words at once.
LEARNED = 1 << 14
#: Pieces in one Arrow batch that goes back to Spark.
BATCH = 512

#: ASCII marks; a run of them is one token of the tokenizer's first cut, apart from the letters before it.
MARKS = string.punctuation

_words: dict[str, dict[str, bytes]] = {}


class _Encoder:
    """Ids of texts as little-endian bytes. The tokenizer drops white space and never joins across it, so words between
    blanks are encoded once each and remembered. It also parts letters from punctuation and lowers case, so what a new
    word of letters, with marks after them or not, leaves to be encoded is its lower-cased letters; many are encoded as
    one text, and the ids that end a word show where to part them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = only_cache(f"packing {path}", _words.setdefault(path, {}))
        if not self.known:
            self._reset()

    def _reset(self) -> None:
        self.known.clear()
        self.known[""] = b""

    def _one(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, missing: set[str]) -> None:
        known, plain, odd, new = self.known, [], [], set()
        for word in missing:
            core = word.rstrip(MARKS)
            tail = word[len(core):]
            if core.isalpha() and (core.isascii() or max(core) < "\u0250" and "\u0130" not in core):  # lower case is letter by letter
                core = core.lower()
                plain.append((word, core, tail))
                if core not in known:
                    new.add(core)
            else:
                odd.append(word)
        for word, found in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            known[word] = np.array(found.ids, dtype="<u4").tobytes()
        if new:
            cores = list(new)
            joint = self.tokenizer.encode_batch_fast([" ".join(cores)], add_special_tokens=False)
            ids = np.array(joint[0].ids, dtype="<u4")
            cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cuts) == len(cores):
                joined, at = ids.tobytes(), 0
                for core, cut in zip(cores, cuts.tolist()):
                    known[core] = joined[at:cut]
                    at = cut
            else:
                known.update((core, self._one(core)) for core in cores)
        for word, core, tail in plain:
            if tail not in known:
                known[tail] = self._one(tail)
            known[word] = known[core] + known[tail]

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        lot: list[list[str]] = []
        size = 0
        for text in texts:
            lot.append((text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
            size += len(lot[-1])
            if size >= LEARNED:
                yield from self._encoded(lot)
                lot, size = [], 0
        yield from self._encoded(lot)

    def _encoded(self, lot: list[list[str]]) -> Iterator[bytes]:
        """The texts of a lot, after all words that are new in it have been learned at once."""
        missing = set().union(*lot).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > REMEMBERED:  # the words learned first are the common ones
                for word in list(islice(self.known, COMMON, None)):
                    del self.known[word]
                missing = set().union(*lot).difference(self.known)
            self._learn(missing)
        for words in lot:
            yield b"".join(map(self.known.__getitem__, words))


def _pieces_of(path: str, capacity: int, keep_ids: bool):
    end = np.array([END], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _Encoder(path), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"][:8 if keep_ids else 7]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            ids_of = encode(text.as_py() for text in batch.column("text"))  # no more texts at once than words are learned of
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    length = len(own) // 4
                    row = (doc, piece, at // 4, length, zlib.crc32(own), part, seen[length])
                    rows.append(row + (np.frombuffer(own, dtype="<u4").astype(np.int32),) if keep_ids else row)
                    seen[length] += 1
                    if len(rows) >= BATCH:
                        yield out()
                        rows.clear()
        if rows:
            yield out()

    return cut


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """The token pieces of each document: ``doc_id, piece, start, length, ids_crc32`` and the task and running number."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return pick(docs, {"doc_id": "long", "text": "string"}).mapInArrow(
        _pieces_of(tokenizer, capacity, keep_ids), schema + (", ids array<int>" if keep_ids else ""))


@dataclass
class Plan:
    """Runs of pieces: ``length, first rank, first bin, bins, offset``; the number of bins, and of those fixed by dominance."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    bins: int = 0
    fixed: int = 0
    taken: dict[int, int] = field(default_factory=dict)

    def place(self, length: int, first_bin: int, bins: int, offset: int) -> None:
        rank = self.taken.get(length, 0)
        self.taken[length] = rank + bins
        self.runs.append((length, rank, first_bin, bins, offset))


def _dominant(counts: np.ndarray, largest: int, capacity: int) -> tuple[int, ...] | None:
    """A set with the piece ``largest`` that dominates every other feasible set with it, or None if none is found.

    Set A dominates B if the pieces of B can be put into pieces of A: what A leaves free is then never worse.
    """
    room = capacity - largest
    left = counts.copy()
    left[largest] -= 1
    there = np.flatnonzero(left)
    fit = there[:np.searchsorted(there, room, side="right")]
    if not len(fit):
        return (largest,)
    first = int(fit[-1])
    if first == room:  # fills the bin
        return (largest, first)
    smallest = np.repeat(there[:3], np.minimum(left[there[:3]], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:  # one more piece at most: the longest that fits
        return (largest, first)
    if len(smallest) > 2 and smallest.sum() <= room:
        return None
    if first >= _best_pair(left, fit, room):  # two more at most, and no two are more than the longest alone
        return (largest, first)
    left[first] -= 1
    partners = np.flatnonzero(left[:room - first + 1])
    if len(partners):
        second = int(partners[-1])
        left[first] += 1
        above = second + 1 + np.flatnonzero(left[second + 1:room + 1])
        two = np.repeat(above[:2], np.minimum(left[above[:2]], 2))[:2]
        if len(two) < 2 or two.sum() > room:  # each other pair has one piece within first, one within second
            return (largest, first, second)
    return None


def _best_pair(left: np.ndarray, fit: np.ndarray, room: int) -> int:
    best, low, high = 0, 0, len(fit) - 1
    while low <= high:
        total = int(fit[low] + fit[high])
        if total <= room and (low < high or left[fit[low]] > 1):
            best = max(best, total)
            low += 1
        else:
            high -= 1
    return best


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where all pieces go. ``histogram``: pieces of each length from 1 to ``capacity``."""
    made = Plan()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        counts[length] = count
    for largest in range(capacity, 0, -1):
        while counts[largest] and (found := _dominant(counts, largest, capacity)):
            times = min(int(counts[length]) // found.count(length) for length in found)
            offset = 0
            for length in found:
                made.place(length, made.bins, times, offset)
                counts[length] -= times
                offset += length
            made.bins += times
    made.fixed = made.bins
    _best_fit(made, counts, capacity)
    return made


def _best_fit(made: Plan, counts: np.ndarray, capacity: int) -> None:
    """Longest first, each into the fullest open bin that has room; runs of equal bins are filled together."""
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, int]]] = {}

    def leave(room: int, first: int, bins: int) -> None:
        if bins and room:
            if room not in open_bins:
                insort(rooms, room)
            open_bins.setdefault(room, []).append((first, bins))

    for length in range(capacity, 0, -1):
        count = int(counts[length])
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                room, first, bins = capacity, made.bins, -(-count // (capacity // length))
                made.bins += bins
            each = room // length
            full = min(bins, count // each)
            for k in range(each if full else 0):
                made.place(length, first, full, capacity - room + k * length)
            count -= each * full
            leave(room - each * length, first, full)
            first, bins = first + full, bins - full
            if bins and count:
                for k in range(count):
                    made.place(length, first, 1, capacity - room + k * length)
                leave(room - count * length, first, 1)
                first, bins, count = first + 1, bins - 1, 0
            leave(room, first, bins)


def _place(runs: list[tuple[int, int, int, int, int]]):
    """Lengths and ranks of pieces -> their bins and offsets, by the last run of their length that starts at or before them."""
    table = np.array(sorted(runs) or [(0, 0, 0, 0, 0)], dtype=np.int64)

    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        only_cache("packing places", {})  # the texts are cut: their words are let go
        starts, rank = (table[:, 0] << 44) + table[:, 1], ranks.to_numpy()
        run = table[np.searchsorted(starts, (lengths.to_numpy() << 44) + rank, side="right") - 1]
        return pa.StructArray.from_arrays([pa.array(run[:, 2] + rank - run[:, 1]), pa.array(run[:, 4])], ["sequence_id", "offset"])

    return F.arrow_udf(place, "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    Null or empty text gives one piece, the closing id alone. Repeated rows are packed each. A null id is kept. An empty
    table gives an empty one. Texts of any length are cut into pieces as they come out of the tokenizer.
    """
    cut = stored(pieces(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"), capacity, keep_ids), "pieces")
    counts = cut.groupBy("part", "length").count()
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    earlier = F.coalesce(F.sum("count").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = cut.join(counts.select("part", "length", earlier.alias("earlier")), ["part", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    place = _place(plan(histogram, capacity).runs)  # the ids themselves stay in the JVM
    return ranked.select(*columns, place("length", F.col("nth") + F.col("earlier")).alias("place")).select(*columns, "place.*")
