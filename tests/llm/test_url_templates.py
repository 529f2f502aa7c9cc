"""URL filter against a plain tree in Python, and the rules by hand."""

import random
import re
from collections import defaultdict

import pytest

from daybook.llm import url_templates as U
from daybook.llm.queries import QUERIES

PAGES, LABELS = "page_id long, url string, html string", "doc_id long, quality int, toxic int"


def parts(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1], match[2]) if match else ("", "")
    return "".join(c.lower() if c.isascii() else c for c in host), path


def ruled(host, path):
    fit = [(own + prefix, verdict) for verdict, own, prefix in U.RULES
           if (host == own or host.endswith("." + own)) and path.startswith(prefix)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


def plain(pages, labels):
    worst = {}
    for doc, quality, toxic in labels:
        known = [x for x in (None if quality is None else 1 - quality, toxic) if x is not None]
        if doc is not None and known:
            worst[doc] = max(worst.get(doc, 0), *known)
    rows = []
    for page, url in pages:
        host, path = parts(url)
        shape = re.sub(r"(?<![0-9A-Za-z])[0-9a-fA-F]{8,}(?![0-9A-Za-z])", "{h}", path)
        rows.append([page, host, path, [s for s in re.sub("[0-9]+", "{n}", shape).split("/") if s], worst.get(page), ""])
    for level in range(max((len(r[3]) for r in rows), default=0)):
        node, child = defaultdict(list), defaultdict(list)
        deep = [r for r in rows if len(r[3]) > level]
        for r in deep:
            node[r[1], r[5]].append(r[4])
            child[r[1], r[5], r[3][level]].append(r[4])
        kept = set()
        for (host, template, segment), bad in child.items():
            every = node[host, template]
            own, all_ = [b for b in bad if b is not None], [b for b in every if b is not None]
            rest, pool = len(all_) - len(own), sum(all_) / len(all_) if all_ else 0
            if len(own) >= U.SUPPORT and rest >= U.SUPPORT:
                error = (pool * (1 - pool) * (1 / len(own) + 1 / rest)) ** 0.5
                if abs(sum(own) / len(own) - (sum(all_) - sum(own)) / rest) > U.DISTINCT * error:
                    kept.add((host, template, segment))
        for r in deep:
            r[5] += "/" + (r[3][level] if (r[1], r[5], r[3][level]) in kept else "*")
    labelled = [r[4] for r in rows if r[4] is not None]
    share = sum(labelled) / len(labelled) if labelled else 0
    by_host, by_template = defaultdict(list), defaultdict(list)
    for r in rows:
        if r[4] is not None:
            by_host[r[1]].append(r[4])
            by_template[r[1], r[5]].append(r[4])
    out = []
    for page, host, path, _, _, template in rows:
        above = (sum(by_host[host]) + U.PRIOR * share) / (len(by_host[host]) + U.PRIOR)
        own = (sum(by_template[host, template]) + U.PRIOR * above) / (len(by_template[host, template]) + U.PRIOR)
        rule, verdict = ruled(host, path)
        out.append((page, host, path, rule, verdict or ("block" if own > U.LIMIT else "allow"), template, round(own, 9)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((*row[:6], round(row[6], 9)) for row in frame.collect()), key=str)


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://net/", "net", "/", "net/", "block"), ("http://a.NET/x?y", "a.net", "/x", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"), ("http://www.example.net/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://notexample.net/en/1", "notexample.net", "/en/1", "net/", "block"), ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
    ("x://example.com/de", "example.com", "/de", None, "allow"), ("https://a.org/fr/?q", "a.org", "/fr/", "org/fr/", "allow"),
    ("a.net/x", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://É.net#://b", "É.net", "", None, "allow"),
    ("a://b://c", "b:", "//c", None, "allow"), ("x\n://h/p\nq", "h", "/p\nq", None, "allow")])
def test_rules(frame, url, host, path, rule, verdict):
    row = U.judge(frame([(1, url, "")], PAGES), frame([], LABELS)).first()
    assert row[1:5] == (host, path, rule, verdict)


def test_tree(frame):
    rng = random.Random(4)
    pages, labels = [], []
    for i in range(1500):
        kind = rng.choice(["news", "spam", "shop", "slug%s" % "".join(rng.choices("abcdefxyz", k=7)), "mixed"])
        host = rng.choice(["a.org", "a.org", "a.org", "b.example.com", "c.de"])
        tail = rng.choice(["/%d" % i, "/%d.html" % i, "/deadbeef%04d" % i, "", "/x/y/z/%d/a/b/c/d/e/f" % i])
        pages.append((i, f"http://{host}/{kind}{tail}"))
        if rng.random() < 0.6:
            bad = rng.random() < {"spam": 0.95, "shop": 0.55}.get(kind, 0.05)
            labels.append((i, int(not bad), int(bad and rng.random() < 0.5)))
    pages += [(None, None), (3, "http://a.org/spam/1"), (3, "http://a.org/spam/1"), (5000, "http://a.org/" + "s/" * 5000)]
    labels += [(1, None, None), (2, None, 1), (2, 1, 0), (None, 0, 0), (3, 0, None)]
    want = plain(pages, labels)
    assert {"/spam/*", "/*/*"} <= {row[5] for row in want if row[1] == "a.org"} and {row[4] for row in want} == {"block", "allow"}
    assert got(U.judge(frame([(*p, "") for p in pages], PAGES), frame(labels, LABELS))) == want
    assert U.judge(frame([], PAGES), frame(labels, LABELS)).count() == 0


def test_small_branches_of_a_large_host(frame):
    """Bad sections with a fortieth or 3 % of a host's pages, beside clean ones as small."""
    sections = [("one.org", f"s{'abcdefghij'[i % 10]}{'wxyz'[i // 10]}", i == 7) for i in range(40)]
    sections += [("ten.org", f"t{'abcdefghij'[i % 10]}{'wxyz'[i // 10]}", i < 10) for i in range(33)]
    rows = [(host, name, bad) for host, name, bad in sections for _ in range(30)]
    pages = [(i, f"http://{host}/{name}/{i}") for i, (host, name, _) in enumerate(rows)]
    labels = [(i, int(not bad), 0) for i, (_, _, bad) in enumerate(rows)]
    out = got(U.judge(frame([(*p, "") for p in pages], PAGES), frame(labels, LABELS)))
    assert out == plain(pages, labels)
    blocked = {row[0] for row in out if row[4] == "block"}
    assert blocked == {i for i, (_, _, bad) in enumerate(rows) if bad} and len(blocked) == 330


def test_deep_branches(frame):
    """A bad branch that parts from a clean one at its twentieth segment, and labels too few for a test."""
    stem = "/".join("abcdefghijklmnopqrs")
    pages = [(i, f"http://a.org/{stem}/{'bad' if i % 4 == 0 else 'good'}/{i}") for i in range(400)]
    pages += [(1000 + i, f"http://b.org/{'bad' if i == 0 else 'good'}/{i}") for i in range(30)]
    labels = [(page, int("bad" not in url), 0) for page, url in pages]
    out = got(U.judge(frame([(*p, "") for p in pages], PAGES), frame(labels, LABELS)))
    assert out == plain(pages, labels)
    assert {row[0] for row in out if row[4] == "block"} == {i for i in range(0, 400, 4)}
    assert {row[5].count("/") for row in out} == {21, 2} and {row[5] for row in out if row[1] == "b.org"} == {"/*/*"}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    pages = [(p.page_id, p.url) for p in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    labels = [tuple(x) for x in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert got(QUERIES["op7_url_filters"](spark, folder)) == plain(pages, labels)
