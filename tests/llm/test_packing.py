"""Packing: ids against the tokenizer itself, plans against bounds and brute force, an exact round trip of the query."""

import itertools
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import packing
from daybook.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
NASTY = ["a\x1cb don't I'LL  <|endoftext|>x <|startoftext|> é́   x y 'S", "", None, "  \n", "ΣΑΣ ΑΣ. 123 12a İstanbul. ŉ ß,",
         "́ a ́b", "<|ENDOFTEXT|> 'S. , . ,. a., word..", "x" * 9000, "word, word. Word", "word### end.' dog'S' _a_ a_b_ x)). it's, it'S' l'll. '' ' a'' ab<| ab|> cd<|endoftext|>.", "한글 日本語, ªº. Ⅷ ²", "퟿ é́é́,"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder(tokenizer):
    encode = packing._Encoder(PATH)
    for text, ids in zip(NASTY * 2, encode(NASTY * 2)):
        assert np.frombuffer(ids, "<u4").tolist() + [0] == ids_of(tokenizer, text), text


def bins_of(plan, capacity):
    bins, placed = {}, Counter()
    for length, rank, first, n, offset in plan.runs:
        for k in range(n):
            bins.setdefault(first + k, []).append((offset, length))
        placed[length] += n
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(bins) == list(range(plan.bins))
    return bins, placed


def fewest(items, capacity):
    """The optimum of a small instance, by search."""
    items = sorted(items, reverse=True)
    for bins in itertools.count(-(-sum(items) // capacity)):
        def fits(i, rooms):
            if i == len(items):
                return True
            return any(fits(i + 1, rooms[:k] + (rooms[k] - items[i],) + rooms[k + 1:])
                       for k in {room: k for k, room in enumerate(rooms) if room >= items[i]}.values())
        if fits(0, (capacity,) * bins):
            return bins


def test_reduction_keeps_the_optimum():
    rng = random.Random(5)
    fixed = 0
    for _ in range(150):
        capacity = rng.choice([7, 20, 50])
        items = [rng.randint(max(1, capacity // rng.choice([2, 4, 9])), capacity) for _ in range(rng.randint(0, 10))]
        plan = packing.plan(Counter(items), capacity)
        bins, placed = bins_of(plan, capacity)
        assert placed == Counter(items)
        rest = [length for b, members in bins.items() if b >= plan.fixed for _, length in members]
        assert plan.fixed + (fewest(rest, capacity) if rest else 0) == (fewest(items, capacity) if items else 0)
        fixed += plan.fixed
    assert fixed > 100


def test_large_plan_is_close_to_the_bound():
    rng = random.Random(1)
    histogram = Counter(min(2048, max(1, int(rng.expovariate(1 / 700)))) for _ in range(50_000))
    plan = packing.plan(histogram)
    bins_of(plan, 2048)
    assert plan.bins <= 1.001 * sum(length * n for length, n in histogram.items()) / 2048 + 1


def check(rows, texts, tokenizer, capacity):
    """Rows of the query against the ids of each document, and gapless sequences."""
    want = Counter()
    for doc, text in texts:
        ids = ids_of(tokenizer, text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at:at + capacity], "<u4")
            want[doc, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_edges(frame, tokenizer):
    texts = list(enumerate(NASTY)) + [(None, "null id"), (3, "again"), (3, "again")]
    docs = frame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, TEXT string, piece int")
    rows = packing.pack(docs.repartition(3), capacity=64, keep_ids=True).collect()
    check(rows, texts, tokenizer, 64)
    for row in rows:
        assert zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32
    assert packing.pack(frame([], "doc_id long, text string")).count() == 0


def test_query(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    texts = [(d.doc_id, d.text) for d in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = QUERIES["op5_best_fit_packing"](spark, folder).collect()
    assert check(rows, texts, tokenizer, 2048) <= 1.02 * sum(r.length for r in rows) / 2048 + 1


def test_ids_stay_out_of_the_last_python_step(frame):
    """Places are found from lengths and ranks; pieces do not go through Python again for them."""
    packed = packing.pack(frame([(1, "a b")], "doc_id long, text string"), keep_ids=True)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython [place(length" in plan


#: Two batches of 20 MB, 800,000 words that do not repeat among them: MB that a worker needs beside one batch.
MEASURE = """
import random, resource, string
import public_tokenizers
import pyarrow as pa
from daybook.llm import packing
class Task:
    get = classmethod(lambda cls: cls)
    partitionId = staticmethod(lambda: 0)
packing.TaskContext = Task
rng = random.Random(5)
def batches():
    for _ in range(2):
        texts = [" ".join(["".join(rng.choices(string.ascii_letters, k=8)) for _ in range(80)] + ["common word"] * 250) for _ in range(5000)]
        yield pa.RecordBatch.from_pydict({"doc_id": list(range(5000)), "text": texts})
made = sum(batch.num_rows for batch in batches())  # what making them takes is no part of it
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
cut = packing._pieces_of(public_tokenizers.path("word_bpe_49k.json"), packing.CAPACITY, True)
assert sum(part.num_rows for part in cut(batches())) == made == 10000
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""


def test_memory_of_a_worker():
    """Two workers share an executor's memory with the JVM: words remembered, and rows kept, are a few times a batch."""
    folder = packing.__file__.replace("/daybook/llm/packing.py", "")
    done = subprocess.run([sys.executable, "-c", MEASURE], cwd=folder, capture_output=True, text=True, check=True, timeout=300)
    assert float(done.stdout) < 120
