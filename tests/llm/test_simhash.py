"""Near-duplicates against all pairs of fingerprints, and components against a plain union of sets."""

import random

import numpy as np
import xxhash

from daybook.llm import graph, simhash
from daybook.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        {c: " " for c in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


TEXTS = [None, "", " \x0b\x0c ", "one", "One two", "one two three", "a b c d e", "É \x1c é x", "é😀 a b", "w " * 40_000,
         " ".join(map(str, range(70_000))), "a\tb\nc\rd"]


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint(text) == plain_print(text), text


def test_links_within_runs():
    for trial in range(60):
        rng = random.Random(trial)
        prints, starts, ends = [], [], []
        for _ in range(rng.randint(1, 10)):
            m = rng.choice([1, 2, 3, 5, 63, 64, 65, 130, 200])
            base = [rng.getrandbits(64) for _ in range(max(1, m // 5))]
            starts.append(len(prints))
            for _ in range(m):
                own = rng.choice(base)
                for _ in range(rng.randint(0, 3)):
                    own ^= 1 << rng.randrange(64)
                prints.append(own)
            ends.append(len(prints))
        a, b = simhash.links(np.array(prints, np.uint64), np.array(starts), np.array(ends))
        want = [(i, j) for s, e in zip(starts, ends) for i in range(s, e) for j in range(s, i) if (prints[i] ^ prints[j]).bit_count() <= 2]
        assert roots(len(prints), zip(a.tolist(), b.tolist())) == roots(len(prints), want)


def test_split_buckets_lose_no_link(frame):
    rng = random.Random(9)
    prints = {rng.getrandbits(16) | 0xABCD12340000 << 16 for _ in range(300)}
    prints |= {p ^ 1 << rng.randrange(64) for p in list(prints)[:150]}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    place = {p: i for i, p in enumerate(signed)}
    want = roots(len(signed), [(i, j) for i, a in enumerate(signed) for j, b in enumerate(signed[:i])
                               if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2])
    for split in (20, 4096):
        rows = simhash.near_links(frame([(p,) for p in signed], "print long"), split).collect()
        assert roots(len(signed), [(place[r.a], place[r.b]) for r in rows]) == want


def test_components(frame):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (None, 5), (302, 300)]
    edges += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    names = list(range(600))
    want = roots(600, [(a, b) for a, b in edges if a is not None])
    got = {row.node: row.root for row in graph.components(frame(edges, "a long, b long")).collect()}
    assert got == {n: want[n] for n in names if want[n] != n}
    assert graph.components(frame([], "a long, b long")).count() == 0


def classes(rows):
    prints = [simhash.fingerprint(text) for _, text in rows]
    root = roots(len(rows), [(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if (a ^ b).bit_count() <= 2])
    low = {}
    for (doc, _), r in zip(rows, root):
        if doc is not None:
            low[r] = min(low.get(r, doc), doc)
    return sorted(((doc, p, low.get(r)) for (doc, _), p, r in zip(rows, prints, root)), key=str)


def unsigned(value):
    return value & (1 << 64) - 1


def edge_rows():
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(10 + i, text) for i, text in enumerate(TEXTS)] + [(5, long), (4, long + " x"), (None, long), (7, "alone in the world"),
                                                              (7, "alone in the world"), (None, "no id here at all"), (3, None)]
    return rows


def test_classes(frame):
    rows = edge_rows()
    got = sorted(((r.doc_id, unsigned(r.print), r.component_id) for r in simhash.classes(frame(rows, SCHEMA)).collect()), key=str)
    assert got == classes(rows)
    assert simhash.classes(frame([], SCHEMA)).count() == 0


def test_one_row_of_each_class_stays(frame):
    rows = edge_rows()
    docs = frame([(d, t, "x", 1) for d, t in rows], SCHEMA + ", TEXT string, print int")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = sorted((r[0] for r in kept.collect()), key=str)
    want = sorted({r[2] for r in classes(rows) if r[2] is not None})
    assert got == sorted([*want, None], key=str)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op9_simhash_near_dedup"](spark, folder).collect()), key=str)
    assert got == classes(rows)
