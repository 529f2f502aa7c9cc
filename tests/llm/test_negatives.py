"""Hard negatives against all pairs."""

import math
import random

import pytest

from daybook.llm import negatives
from daybook.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, LABEL string"


def mined(rows, every=50, k=5, top=3):
    """(id, vector, label) rows -> the result, pair by pair."""
    taking = [(i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows
              if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in taking if i % every == 0}:
        scored = sorted(((-sum(a * b for a, b in zip(v, other)), j, own == label) for j, other, own in taking if j != i))
        for p, positive, _ in [row for row in scored if row[2]][:k]:
            hard = [(n, j) for n, j, same in scored if not same and 50 * -p <= 100 * -n <= 95 * -p][:top]
            out += [(i, positive, rank, j, -p, -n) for rank, (n, j) in enumerate(hard, 1)]
    return sorted(out)


def check(frame, rows, **options):
    found = negatives.mine(frame([(*row, "x") for row in rows], SCHEMA), **options)
    got = sorted(tuple(row) for row in found.collect())
    assert got == mined(rows, **({"every": options["every"]} if options else {}))
    return got


def vectors(n, seed=1, width=8, step=8):
    """Few different components, so that scores tie and windows touch."""
    rng = random.Random(seed)
    return [(i, [rng.randint(-2, step) / step for _ in range(width)], rng.randint(0, 9)) for i in range(n)]


def test_ties(frame):
    assert len(check(frame, vectors(400, step=2))) > 50
    assert len(check(frame, vectors(400), every=3)) > 50


def test_edges(frame):
    rows = vectors(200)
    bad = [(None, [1.0] * 8, 1), (1000, None, 1), (1050, [1.0] * 8, None), (1100, [1.0, None] + [1.0] * 6, 1), (1150, [float("nan")] * 8, 2),
           (1200, [float("inf")] * 8, 2), (1250, [], 3), (1300, [0.5, 0.5], 3), (1350, [0.5] * 12, 4), (1400, [0.0] * 8, 5)]
    again = [rows[0], rows[0], (50, [0.9] * 8, 1), (51, rows[3][1], rows[3][2]), *[rows[7]] * 20]
    check(frame, rows + bad + again)
    assert check(frame, [(50, [1.0], 1)]) == []
    empty = frame([], SCHEMA)
    assert negatives.mine(empty).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.mine(empty).count() == 0


def test_large_scores(frame):
    rows = [(i, [x * 2.0 ** 17 for x in v], label) for i, v, label in vectors(150)]
    assert max(row[4] for row in check(frame, rows)) > 2 ** 50
    with pytest.raises(Exception, match="64 bits"):
        check(frame, [(i, [x * 2.0 ** 30 for x in v], label) for i, v, label in rows])


def test_blocks_and_chunks(frame, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 4)
    monkeypatch.setattr(negatives, "CELLS", 64)
    check(frame, vectors(300), every=20)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, folder).collect()) == mined(rows)
