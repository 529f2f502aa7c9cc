"""Checksums against zlib, weights and draws against a plain count in Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from daybook.llm import importance
from daybook.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets_of(text, longest=1):
    words = words_of(text)
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10_000
            for i in range(len(words)) for n in range(1, longest + 1) if i + n <= len(words)]


def weighed(rows, target, longest=1, percent=10, least=20):
    own = [buckets_of(text, longest) for _, text in rows]
    held, wanted = Counter(b for found in own for b in found), Counter(b for text in target for b in buckets_of(text, longest))
    gain = lambda b: math.floor(1000 * math.log(
        (wanted[b] + 1) * (held.total() + 10_000) / ((held[b] + 1) * (wanted.total() + 10_000))))
    scored = []
    for (doc, text), found in zip(rows, own):
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        scored.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    fit = sorted((i for i, (_, text) in enumerate(rows) if len(words_of(text)) >= least),
                 key=lambda i: (-scored[i][3], scored[i][0] is None, scored[i][0] or 0))
    ranks = {i: place for place, i in enumerate(fit[:len(fit) * percent // 100], 1)}
    return [(*row, ranks.get(i)) for i, row in enumerate(scored)]


EDGE = [None, "", " ", "A", "Ab9 cD", "é É 😀 x", "a\x00b", "q" * 1000 + " " + "z" * 64 + " " + "y" * 65 + " " + "x" * 128, "  　",
        "w " * 30_000, "long" * 50_000, "end."]


def test_checksums():
    rng = random.Random(1)
    texts = [t or "" for t in EDGE] + ["".join(rng.choices("ab CD1é\n.", k=rng.randint(0, 300))) for _ in range(200)]
    for longest in (1, 2, 3):
        for skipped in (0, 3):  # a slice of an Arrow array
            found, n = importance.features(pa.array(texts).slice(skipped), longest, 10_000)
            want = [buckets_of(text, longest) for text in texts[skipped:]]
            assert list(n) == [len(x) for x in want] and list(found) == [b for x in want for b in x]
    assert [len(x) for x in importance.features(pa.array([], pa.string()), 1, 10_000)] == [0, 0]


def plain(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def rows_of(n, seed=2):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    return [(i, " ".join(rng.choices(pool[:100] if i % 3 else pool, k=rng.choice([5, 25, 60])))) for i in range(n)]


def test_edges(frame):
    rows = [*enumerate(EDGE), *((100 + i, t) for i, t in rows_of(300)), *[(None, "w " * 25)] * 60, *[(7, "w v " * 20)] * 60]
    target = [None, "", *[text for _, text in rows_of(300)[::3]]]
    docs = frame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).withColumnRenamed("lang", "TEXT")
    aim = frame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert plain(importance.weights(docs, aim)) == sorted(weighed(rows, target), key=str)
    assert plain(importance.weights(docs, aim.limit(0))) == sorted(weighed(rows, []), key=str)
    assert plain(importance.weights(docs, aim, longest=2, percent=50)) == sorted(weighed(rows, target, 2, 50), key=str)
    assert importance.weights(docs.limit(0), aim).count() == 0


def test_the_target_draws_its_like(frame):
    rows = rows_of(3000)
    aim = [text for i, text in rows_of(3000, 2) if i % 3 == 0][:200]
    docs = frame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    drawn = importance.resample(docs, frame([(0, t) for t in aim], "item_id long, text string"))
    got = drawn.collect()
    assert drawn.columns == docs.columns and len(got) == sum(len(words_of(t)) >= 20 for _, t in rows) // 10
    assert sum(row.doc_id % 3 == 0 for row in got) > 0.5 * len(got) and {(r.doc_id, r.text) for r in got} <= set(rows)
    want = {row[0] for row in weighed(rows, aim) if row[4]}
    assert {row.doc_id for row in got} == want


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs, aim = (spark.read.parquet(f"{folder}/{name}.parquet").collect() for name in ("documents", "benchmark"))
    assert plain(QUERIES["op12_importance_resampling"](spark, folder)) == sorted(
        weighed([(d.doc_id, d.text) for d in docs], [b.text for b in aim]), key=str)
