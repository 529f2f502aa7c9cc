"""Benchmark decontamination: latent semantic retrieval, then longest common subsequences.

Passages are weighted by TF-IDF over hashed words, with document frequencies counted over all documents. A randomised SVD
of passages gives each word a place in a latent space: it is fitted on every passage of the items and of all documents, in
distributed products with a thin matrix. The items' passages weigh as much as all documents' together, or their words would
have no axes in a large table. Every stretch of every document, at window sizes that follow the items' lengths,
is compared with the items by the cosine in that space. A candidate leaks an item if enough of the item's words, in
order, are found around the window, or somewhat fewer and its answer (its last sentence, or the column ``answer``).

Items are a stated query set: they are held against all rows, in blocks of ``BLOCK`` items.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import only_cache, pick, stored, unpack
from daybook.session import shared_folder

BUCKETS = 1 << 14
RANK, MORE, ROUNDS = 64, 8, 2
#: Tasks that share the products, or two for each core if that is more; each sends one thin matrix in single precision.
SHARES = 32
PASSAGE = 48
#: Passages worked on at once in a product, and rows gathered at once.
LOT, PART = 8192, 2048
#: Rows that are added up one after the other before what they came to is added up.
LAYERS = 64
BLOCK = 2000
#: Cosine of a candidate; shares of an item's words in order that make a leak, alone or with the answer's.
CANDIDATE = 0.5
COMMON, PARTLY, ANSWER = 0.8, 0.6, 0.8
#: Bytes of the texts that are cut at once.
TEXT = 1 << 21
#: Words of a block, whose sums windows are made of; words worked on at once; words remembered by a Python worker.
STEP, SPAN, REMEMBERED = 4, 1 << 16, 200_000
#: Passages that an axis is taken to have beside those that it is made of.
FEW = 8.0
SEED = 20
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
ASCII_EDGES = string.punctuation
#: White space that ASCII's does not hold.
RARE_BLANK = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def word(chunk: str) -> str:
    """A blank-separated chunk in lower case, without what is no letter or digit at its ends."""
    lower = chunk.lower()
    return lower if lower.isalnum() else EDGES.sub("", lower)


class _Hashed(dict):
    """Chunk -> bucket of its word; ``BUCKETS`` for a chunk without one."""

    def __missing__(self, chunk: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        own = word(chunk)
        self[chunk] = found = xxhash.xxh32_intdigest(own.encode("utf-8", "surrogatepass")) % BUCKETS if own else BUCKETS
        return found


_hashed = _Hashed()


def buckets_of(chunks: list[str]) -> np.ndarray:
    known = only_cache("decontaminate", _hashed)
    return np.fromiter(map(known.__getitem__, chunks), dtype=np.int32, count=len(chunks))


def _cut(texts: pa.Array) -> pa.ListArray:
    """The chunks of each text, cut where Python's ``str.split`` does."""
    rare = pc.any(pc.match_substring_regex(texts, RARE_BLANK)).as_py()
    return pc.utf8_split_whitespace(texts) if rare else pc.ascii_split_whitespace(texts)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of a column of texts: where each one's chunks start, all chunks' buckets, their codes, and the chunk of each code.

    Each different chunk is looked at once, and in Python each that still differs without case and edges in ASCII, which
    changes no word.
    """
    cut = _cut(pc.fill_null(texts, ""))
    coded = cut.flatten().dictionary_encode()
    bare = pc.ascii_trim(pc.ascii_lower(coded.dictionary), characters=ASCII_EDGES).dictionary_encode()
    buckets = buckets_of(bare.dictionary.to_numpy(zero_copy_only=False).tolist())[bare.indices.to_numpy()]
    codes = coded.indices.to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))))
    return starts, buckets[codes], codes, coded.dictionary


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in their order, about ``TEXT`` bytes of text at a time; a longer text is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes, dtype=np.int64) - sizes) // TEXT)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _parts(batch):  # what a whole batch's chunks take would be many times its texts
            starts, ids, _, _ = tokens_of(part.column("text"))
            coded = pa.Array.from_buffers(pa.binary(), part.num_rows, [
                None, pa.py_buffer((2 * starts).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))])
            yield pa.RecordBatch.from_arrays([*part.columns, coded], names=[*part.schema.names, "ids"])
        pa.default_memory_pool().release_unused()


def with_buckets(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the buckets of all chunks, two bytes each, so that texts are cut once for all that follows."""
    return docs.select("doc_id", "text").mapInArrow(_code, "doc_id long, text string, ids binary")


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of a column of buckets, as ``with_buckets`` writes them or as lists: where each row's start, and all of them."""
    if pa.types.is_list(column.type):
        return np.concatenate(([0], np.cumsum(pc.list_value_length(column)))), column.flatten().to_numpy().astype(np.uint16)
    rows = column.to_pylist()
    return np.cumsum([0, *map(len, rows)]) // 2, np.frombuffer(b"".join(rows), "<u2")


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of the task each bucket is; the last row counts the documents."""
    only_cache("latent words", {})  # the texts are cut: their words are let go
    counts = np.zeros(BUCKETS + 2, dtype=np.int64)
    for batch in batches:
        starts, ids = _ids_of(batch.column("ids"))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            there = np.zeros(BUCKETS + 2, dtype=bool)
            there[ids[a:b]] = True
            counts += there
        counts[BUCKETS + 1] += batch.num_rows
    there = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["bucket", "held"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """IDF of each bucket over all documents (with their texts, or ``with_buckets``); zero for chunks without a word only, so
    that a word which every document holds still counts. One number per bucket comes to the driver."""
    coded = docs if "ids" in docs.columns else with_buckets(docs)
    found = coded.select("ids").mapInArrow(_held, "bucket long, held long").groupBy("bucket").agg(F.sum("held").alias("held")).collect()
    held = np.zeros(BUCKETS + 2)
    for row in found:
        held[row["bucket"]] = row["held"]
    idf = np.log1p(held[BUCKETS + 1] / np.maximum(held[:BUCKETS + 1], 1))
    idf[BUCKETS] = 0
    return idf


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ids = _ids_of(batch.column("ids"))
        cuts = [ids[at:min(at + PASSAGE, b)] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()) for at in range(a, b, PASSAGE)]
        yield pa.RecordBatch.from_arrays([pa.array(cuts, type=pa.list_(pa.int32()))], names=["ids"])


def _count_passages(coded: DataFrame) -> int:
    return coded.agg(F.sum(F.ceil(F.octet_length("ids") / (2 * PASSAGE)))).first()[0] or 0


def sample_passages(docs: DataFrame) -> DataFrame:
    """Every passage of every document as a list of buckets: the rows that :func:`latent_words` makes of documents, and
    despite the name no sample."""
    return with_buckets(docs).select("ids").mapInArrow(_passages, "ids array<int>")


def _weighted(ids: list[np.ndarray], weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """TF-IDF rows of length one, as buckets and weights."""
    for own in ids:
        there, counts = np.unique(own, return_counts=True)
        row = counts * weights[there]
        norm = np.sqrt((row * row).sum())
        if norm:
            yield there, row / norm


def _lots(batches: Iterator[pa.RecordBatch], squared: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Passages of the rows, ``LOT`` at a time: their buckets, filled up with ``BUCKETS``, and their rows' ``mass`` (one, if there
    is no such column) over the squared lengths."""
    for batch in batches:
        starts, ids = _ids_of(batch.column("ids"))
        many = -(-np.diff(starts) // PASSAGE)
        first = np.repeat(starts[:-1], many) + PASSAGE * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        last = np.repeat(starts[1:], many)
        mass = np.repeat(batch.column("mass").to_numpy() if "mass" in batch.schema.names else np.ones(len(many)), many)
        for at in range(0, len(first), LOT):
            place = first[at:at + LOT, None] + np.arange(PASSAGE)
            inside = place < last[at:at + LOT, None]
            rows = np.where(inside, ids[np.minimum(place, len(ids) - 1)], np.uint16(BUCKETS))
            ordered, before = np.ascontiguousarray(np.sort(rows, axis=1).T), np.zeros(len(rows))
            square = squared[ordered[0]]
            for k in range(1, PASSAGE):  # n equal buckets: n * n is the sum of the first n odd numbers
                before = (before + 1) * (ordered[k] == ordered[k - 1])
                square += squared[ordered[k]] * (2 * before + 1)
            yield rows, np.divide(mass[at:at + LOT], square, out=np.zeros(len(rows)), where=square > 0)


def _times(rows: np.ndarray, thin: np.ndarray) -> np.ndarray:
    """Sums of the thin matrix's rows over each passage's buckets."""
    out, more = np.zeros((len(rows), thin.shape[1]), np.float32), np.empty((PART, thin.shape[1]), np.float32)
    for at in range(0, len(rows), PART):
        part = out[at:at + PART]
        for own in np.ascontiguousarray(rows[at:at + PART].T):
            part += np.take(thin, own, axis=0, out=more[:len(own)], mode="clip")
    return out


def _add_by(buckets: np.ndarray, which: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Add ``rows[which]`` to the rows of ``out`` that the buckets name: the equal ones ``LAYERS`` at a time, then their sums."""
    order = np.argsort(buckets, kind="stable")
    which, counts = which[order], np.bincount(buckets, minlength=len(out))
    lots, ends = -(-counts // LAYERS), np.cumsum(counts)
    own = np.repeat(np.arange(len(out)), lots)
    begin = (ends - counts)[own] + LAYERS * (np.arange(len(own)) - np.repeat(np.cumsum(lots) - lots, lots))
    size = np.minimum(LAYERS, ends[own] - begin)
    order = np.argsort(-size, kind="stable")
    own, begin, size = own[order], begin[order], -size[order]
    sums, more = np.empty((len(own), rows.shape[1]), np.float32), np.empty((PART, rows.shape[1]), np.float32)
    for at in range(0, len(own), PART):
        part, place = sums[at:at + PART], begin[at:at + PART]
        np.take(rows, which[place], axis=0, out=part, mode="clip")
        for k in range(1, -int(size[at])):
            many = int(np.searchsorted(size[at:at + PART], -k))  # with more than k rows
            part[:many] += np.take(rows, which[place[:many] + k], axis=0, out=more[:many], mode="clip")
    if lots.max(initial=0) > 1:
        _add_by(own, np.arange(len(own)), sums, out)
    else:
        out[own] += sums


def _product(weights: np.ndarray, thin: np.ndarray):
    """Rows of documents -> a task's share of A'A times ``thin``, A being the TF-IDF rows of their passages, in blocks of rows."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, weighted = np.zeros(thin.shape), (thin * weights[:, None]).astype(np.float32)
        for rows, inverse in _lots(batches, weights ** 2):
            image = _times(rows, weighted) * inverse[:, None].astype(np.float32)
            worded = np.flatnonzero(rows != BUCKETS)
            _add_by(rows.ravel()[worded], worded // PASSAGE, image, out)
        out *= weights[:, None]
        at = list(range(0, len(out), 1024))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array([out[k:k + 1024].astype(np.float32).tobytes() for k in at])], names=["block", "part"])
    return multiply


def _spread(weights: np.ndarray, thin: np.ndarray):
    """Rows of documents -> a task's share of (A thin)'(A thin)."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weighted = np.zeros((thin.shape[1],) * 2), (thin * weights[:, None]).astype(np.float32)
        for rows, inverse in _lots(batches, weights ** 2):
            image = _times(rows, weighted) * np.sqrt(inverse)[:, None].astype(np.float32)
            total += image.T @ image
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["part"])
    return multiply


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(part, np.float32).astype(np.float64) for part in table.column("part").to_pylist())
    return pa.table({"block": [table.column("block")[0].as_py()], "part": [total.tobytes()]})


def latent_words(passages: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Each bucket's IDF-weighted place in the latent space, by a randomised SVD of all passages.

    Rows of ``passages`` are the ``ids`` of whole documents, or of single passages: each is cut into passages, which count
    as often as the column ``mass`` says, if there is one. The range of A'A
    is found by products with a thin random matrix, orthogonalised between rounds; the thin matrix is all that the driver
    holds. Axes are scaled to the same spread, but for those that no more than a ``FEW`` passages make: they would part near
    copies in a small table.
    """
    shares = max(SHARES, 2 * passages.sparkSession.sparkContext.defaultParallelism)
    passages = passages.coalesce(shares)
    rng = np.random.default_rng(SEED)
    basis, _ = np.linalg.qr(rng.standard_normal((BUCKETS + 1, RANK + MORE)))
    for _ in range(ROUNDS):
        parts = passages.mapInArrow(_product(weights, basis), "block long, part binary").groupBy("block").applyInArrow(
            _add, "block long, part binary").collect()
        image = np.concatenate([np.frombuffer(row["part"]) for row in sorted(parts, key=lambda row: row["block"])])
        basis, _ = np.linalg.qr(image.reshape(basis.shape))
    spreads = passages.mapInArrow(_spread(weights, basis), "part binary").collect()
    squares, turn = np.linalg.eigh(sum(np.frombuffer(row["part"]) for row in spreads).reshape(basis.shape[1], -1))
    order = np.argsort(-squares)[:RANK]
    order = order[squares[order] > 1e-9 * max(1.0, squares.max())]
    axes = basis @ turn[:, order] / np.sqrt(squares[order] + FEW)
    return np.ascontiguousarray(axes * weights[:, None], dtype=np.float32)


@dataclass
class Item:
    number: int
    words: list[str]
    answer: list[str]

    @cached_property
    def masks(self) -> tuple[dict[str, int], dict[str, int]]:
        return _masks(self.words), _masks(self.answer)


def _masks(words: list[str]) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, own in enumerate(words):
        found[own] = found.get(own, 0) | 1 << i
    return found


def common(masks: dict[str, int], size: int, words: list[str]) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    row = full = (1 << size) - 1
    for own in words:
        if mask := masks.get(own):
            hit = row & mask
            row = (row + hit | row - hit) & full
    return size - row.bit_count()


def item_of(number: int, text: str | None, answer: str | None) -> Item:
    words = [own for own in map(word, (text or "").split()) if own]
    if answer is None:
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", (text or "").strip()) if s]
        answer = sentences[-1] if sentences else ""
    return Item(number, words, [own for own in map(word, answer.split()) if own])


def sizes_of(items: list[Item]) -> dict[int, list[int]]:
    """Window size -> the items that it is for: the next of 8, 12, 16, 24, 32, 48, ... words."""
    found: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        if item.words:
            size, other = 8, 12
            while size < len(item.words):
                size, other = other, 2 * size
            found.setdefault(size, []).append(i)
    return found


def stride_of(size: int) -> int:
    """Words between two windows: a quarter of the window, in whole blocks."""
    return max(STEP, size // 4 // STEP * STEP)


def _windows(blocks: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Sums over windows of each size that begin at each block, by doubling."""
    doubled, n = {STEP: blocks}, STEP
    while 2 * n <= max(sizes):
        step = n // STEP
        doubled[2 * n] = doubled[n][:-step] + doubled[n][step:]
        n *= 2
    found = {}
    for size in sizes:
        large = max(n for n in doubled if n <= size)
        rest = size - large  # none, or half of the large one
        found[size] = doubled[large] if not rest else doubled[large][:len(doubled[rest]) - large // STEP] + doubled[rest][large // STEP:]
    return found


def _search(items: list[Item], places: np.ndarray):
    """Rows of documents -> their leaks. Only the items and the latent places travel; the worker makes its tables of them."""
    by_size = sizes_of(items)
    longest = max(by_size)
    targets: dict[int, tuple] = {}
    blank = np.full(2 * longest, BUCKETS, dtype=np.uint16)

    def unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets.update({size: (np.array(own), unit(np.stack([places[buckets_of(items[i].words)].sum(axis=0) for i in own])).T.copy(),
                               _shared_words([items[i] for i in own])) for size, own in by_size.items()})
        for batch in batches:
            docs, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            starts, ids = _ids_of(batch.column("ids"))
            around = np.concatenate([blank, ids, blank])
            found: dict[tuple[int, int], tuple] = {}
            chunks = cache(lambda row: _cut(texts.slice(row, 1)).flatten())  # of the few texts with a candidate
            for low in range(0, len(ids), SPAN):
                for i, first, cosine in _candidates(ids, around, low):
                    _confirm(items[i], i, starts, chunks, first, cosine, found)
            rows = [(docs[row], items[i].number, *best) for (row, i), best in found.items()]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=NAMES)

    def _candidates(ids: np.ndarray, around: np.ndarray, low: int) -> Iterator[tuple[int, int, float]]:
        """Windows that begin in a span and are close to an item, and hold enough of its words, in whatever order."""
        own = np.full(-(-min(SPAN + longest, len(ids) - low + longest) // STEP) * STEP, BUCKETS, dtype=np.int32)
        own[:min(len(own), len(ids) - low)] = ids[low:low + len(own)]
        blocks = places[own[0::STEP]]
        more = np.empty_like(blocks)
        for k in range(1, STEP):
            blocks += np.take(places, own[k::STEP], axis=0, out=more, mode="clip")
        sums = _windows(blocks, list(targets))
        for size, (which, target, held_words) in targets.items():
            stride = stride_of(size)
            windows = sums[size][:-(-min(SPAN, len(ids) - low) // STEP):stride // STEP]
            norms = np.sqrt(np.einsum("ij,ij->i", windows, windows))
            near = windows @ target
            w, k = np.divmod(np.flatnonzero(near > CANDIDATE * np.maximum(norms, 1e-12)[:, None]), len(which))
            first = low + w * stride
            enough = held_words(around, len(blank) + first, size, k) >= PARTLY * np.array([len(items[i].words) for i in which])[k]
            for a, b, at in zip(w[enough].tolist(), k[enough].tolist(), first[enough].tolist()):
                yield int(which[b]), at, float(near[a, b] / max(norms[a], 1e-12))

    return search


def _around(first: int | np.ndarray, size: int):
    """Where the words around a window begin, and how many they are."""
    return first - size // 4, size + 2 * (size // 4)


def _shared_words(items: list[Item]):
    """A function that counts how many of an item's words there are around windows of buckets that go on beyond the windows: no
    common subsequence is longer."""
    own = [np.unique(buckets_of(item.words), return_counts=True) for item in items]
    most = max(len(buckets) for buckets, _ in own)
    slots = np.full((len(items), BUCKETS + 1), most, dtype=np.int32 if most > 60_000 else np.uint16)
    limits = np.zeros((len(items), most + 1), dtype=np.int64)
    for k, (buckets, counts) in enumerate(own):
        slots[k, buckets], limits[k, :len(buckets)] = np.arange(len(buckets)), counts

    flat_slots = slots.ravel()

    def count(ids: np.ndarray, first: np.ndarray, size: int, item: np.ndarray) -> np.ndarray:
        begin, n = _around(first, size)
        out = np.zeros(len(first), dtype=np.int64)
        lot = max(1, (1 << 17) // (n + most))
        for a in range(0, len(first), lot):
            part = item[a:a + lot]
            slot = flat_slots[ids[begin[a:a + lot, None] + np.arange(n)] + (BUCKETS + 1) * part[:, None]]
            flat = slot + (most + 1) * np.arange(len(part))[:, None]
            held = np.bincount(flat.ravel(), minlength=len(part) * (most + 1)).reshape(len(part), -1)
            out[a:a + lot] = np.minimum(held, limits[part]).sum(axis=1)
        return out

    return count


def _confirm(item: Item, i: int, starts: np.ndarray, chunks: Callable[[int], pa.Array], first: int, cosine: float,
             found: dict[tuple[int, int], tuple]) -> None:
    """Note the leak in each document around a window, if there is one."""
    size = next(n for n, own in sizes_of([item]).items())
    begin, n = _around(first, size)
    low, high = max(0, begin), min(int(starts[-1]), begin + n)
    words, answers = item.masks
    row = int(np.searchsorted(starts, low, side="right")) - 1
    while row < len(starts) - 1 and starts[row] < high:
        a, b = max(low, int(starts[row])), min(high, int(starts[row + 1]))
        seen = [word(chunk) for chunk in chunks(row).slice(a - int(starts[row]), b - a).to_pylist()] if a < b else []
        share = common(words, len(item.words), seen) / len(item.words)
        answer = common(answers, len(item.answer), seen) / len(item.answer) if item.answer else 1.0
        if share >= COMMON or share >= PARTLY and answer >= ANSWER:
            best = (share, answer, cosine, a - int(starts[row]), b - int(starts[row]))
            found[row, i] = max(found.get((row, i), best), best)
        row += 1


NAMES = ["doc_id", "item_id", "common", "answer", "cosine", "start_word", "end_word"]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, common, answer, cosine, start_word, end_word``: the items that each document leaks.

    ``common`` and ``answer`` are the shares of the item's and its answer's words found in order between the two words.
    Null text counts as empty and leaks nothing; an item without a word is never leaked, and if none has one there are no
    rows; null ids are kept; each of repeated rows is reported. Words are parted by Unicode white space on both sides. Texts of any length are searched whole, in overlapping parts. Empty tables give an empty one.
    """
    schema = "doc_id long, item_id long, common double, answer double, cosine double, start_word long, end_word long"
    texts = pick(docs, {"doc_id": "long", "text": "string"})
    wanted = {"item_id": "long", "text": "string"} | ({"answer": "string"} if "answer" in benchmark.columns else {})
    asked = pick(benchmark, wanted)
    n = asked.count()
    none = texts.sparkSession.createDataFrame([], schema)
    if not n:
        return none
    texts = stored(with_buckets(texts), "buckets")
    weights = inverse_frequencies(texts)
    known = stored(with_buckets(asked.select(F.col("item_id").alias("doc_id"), "text")), "item_buckets")
    mass = max(1.0, _count_passages(texts) / max(1, _count_passages(known)))
    places = latent_words(texts.select("ids", F.lit(1.0).alias("mass")).union(known.select("ids", F.lit(mass))), weights)
    blocks, path = -(-n // BLOCK), shared_folder(docs.sparkSession, "leaks")
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        items = [item_of(row["item_id"], row["text"], row["answer"] if "answer" in wanted else None) for row in rows]
        items = [item for item in items if item.words]
        found = texts.mapInArrow(_search(items, places), schema) if items else none
        if blocks == 1:
            return found
        found.write.mode("append").parquet(path)  # one block at a time
    return docs.sparkSession.read.schema(schema).parquet(path)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns.

    Documents with a null or empty text stay. Rows are told apart by id: all rows of an id that leaks go, and so do all rows
    without an id if one of them leaks. Repeats, long texts and empty tables are as in :func:`leaks`.
    """
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("bad_id")).distinct()
    return unpack(pick(docs, {"doc_id": "long"}, row=True).join(stored(bad, "leaking"), F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti"), docs.columns)
