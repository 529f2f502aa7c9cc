"""Quality classifier: held-out accuracy, and the shrinkage against a plain computation."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from daybook.llm import classifier
from daybook.llm.queries import QUERIES

DOCS, LABELS = "doc_id long, text string, lang string, source string", "doc_id long, quality int, toxic int"


def test_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(10))
    out = classifier.judge(docs, labels.where(fold < 7)).drop("quality", "toxic")
    rows = out.join(labels.where(fold >= 7), "doc_id").select("quality", "toxic", "kept").collect()
    good = [row.kept for row in rows if row.quality == 1 and row.toxic == 0]
    bad = [not row.kept for row in rows if row.quality == 0 or row.toxic == 1]
    assert len(good) > 500 and sum(good) >= 0.99 * len(good)
    assert len(bad) > 150 and sum(bad) >= 0.9 * len(bad)


def test_shrinkage(spark, frame):
    rows = [(i, f"word{i % 7} and {'###' * (i % 3)} more", "en" if i % 4 else None, f"s{i % 11 if i % 2 else 0}") for i in range(300)]
    rows += [(None, None, None, None), (1, rows[1][1], "en", rows[1][3])]
    labels = frame([(i, int(i % 3 == 0), 0) for i in range(0, 300, 2)], LABELS)
    docs = frame(rows, DOCS)
    found = classifier.evidence(docs, classifier.fit(docs, labels)).collect()
    assert min(r.p for r in found if r.doc_id == 0) > 0.5 > max(r.p for r in found if r.doc_id == 2)
    prior = sum(r.p for r in found) / len(found)

    def groups(key):
        out = defaultdict(list)
        for r in found:
            out[key(r)].append(r.p)
        return out

    def strength(sites, above):
        sites = {k: v for k, v in sites.items() if len(v) > 1}
        docs = sum(map(len, sites.values()))
        between = sum(len(v) * (sum(v) / len(v) - above(k)) ** 2 for k, v in sites.items())
        within = sum(sum(x * x for x in v) - sum(v) ** 2 / len(v) for v in sites.values()) / (docs - len(sites))
        spread = (between - len(sites) * within) / docs
        return min(10_000, max(5, within / spread)) if spread > 0 else 10_000

    hosts, paths = groups(lambda r: r.host), groups(lambda r: (r.host, r.path))
    by_host = strength(hosts, lambda k: prior)
    mean = {k: (sum(v) + by_host * prior) / (len(v) + by_host) for k, v in hosts.items()}
    by_path = strength(paths, lambda k: mean[k[0]])
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    want = []
    for r in found:
        own = paths[r.host, r.path]
        site = (sum(own) - r.p + by_path * mean[r.host]) / (len(own) - 1 + by_path)
        want.append((r.doc_id, site, 1 / (1 + math.exp(-logit(r.p) - logit(site) + logit(prior)))))
    got = sorted(((r.doc_id, r.site, r.score) for r in classifier.judge(docs, labels).collect()), key=str)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[0] == w[0] and g[1:] == pytest.approx(w[1:], rel=1e-6)


def test_edges(frame):
    docs = frame([(1, "a", "en", "s"), (2, None, None, None), (3, "x " * 200_000, "en", "s")], DOCS)
    for labels in ([], [(1, None, None)], [(1, 1, 0), (2, 1, 0)], [(None, 0, 1)]):
        rows = classifier.judge(docs, frame(labels, LABELS)).collect()
        assert len(rows) == 3 and all(row.kept for row in rows)
    assert classifier.judge(frame([], DOCS), frame([(1, 1, 0)], LABELS)).count() == 0
    clash = frame([(1, "a b c", "en", "s", 1, 2)], DOCS + ", words int, TEXT int")
    assert classifier.judge(clash, frame([(1, 1, 0)], LABELS)).count() == 1


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op10_quality_classifier"](spark, folder).collect()
    assert sorted(row.doc_id for row in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
