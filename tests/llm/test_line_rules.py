"""Quality rules against a plain count in Python."""

import random
import re
from collections import Counter, defaultdict

from daybook.llm import line_rules
from daybook.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)]


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")


def judged(rows):
    """doc rows (id, text, source) -> figures and verdicts."""
    hosts, holders = defaultdict(set), defaultdict(set)
    for doc, text, source in rows:
        hosts[source or ""].add(doc)
        for line in (text or "").split("\n"):
            if normal(line):
                holders[source or "", normal(line)].add(doc)
    out = []
    for doc, text, source in rows:
        found = figures(text)
        removed = sum(len(normal(line).split(" ")) for line in (text or "").split("\n") if normal(line)
                      and len(holders[source or "", normal(line)]) >= 20
                      and len(holders[source or "", normal(line)]) > line_rules.SHARE * len(hosts[source or ""]))
        failed = found[0] < 10 or 100 * found[4] > 20 * found[0]
        left = found[0] - removed
        out.append((doc, *found, failed, not failed and left >= 10 and left >= 0.5 * found[0], removed))
    return sorted(out, key=str)


def plain(frame):
    return sorted((tuple(row) for row in frame.drop("host", "mark", "shared").collect()), key=str)


EDGE = [None, "", " ", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a", "x\n\nx\n \nx \nx", "\x0b\x0c\r\t", "\x1c \x85 \xa0 é😀 #|<>",
        "w " * 30_000, " ".join(str(i) for i in range(30_000)), "z" * 200_000, "a b c d e f g h i j k\n" * 50]


def test_edges(frame):
    rows = [(i, text, "s") for i, text in enumerate(EDGE)] + [(None, "a b", None), (1, "a b", None), (1, "a b", None)]
    assert plain(line_rules.judge(frame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA))) == judged(rows)
    assert line_rules.judge(frame([], SCHEMA)).count() == 0


def shared_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = []
    for i in range(150):
        own = " ".join(word() for _ in range(rng.choice([4, 12, 30])))
        rows.append((i, rng.choice(["Menu %d  home about" % i, "Other line"]) + "\n" + own, "hot"))
    rows += [(200 + i, "Copied whole line of ten words a b c d", "copies") for i in range(60)]
    rows += [(300 + i, f"few hold this line {word()}\nfew hold", "rare") for i in range(19)]
    return rows


def test_shared_lines(frame, monkeypatch):
    rows = shared_rows()
    assert all(row[-2] is False and row[-1] == 10 for row in judged(rows) if 200 <= row[0] < 260)  # copies count as documents
    want = judged(rows)
    assert {row[-1] for row in want} >= {0, 2, 4} and {row[-2] for row in want} == {True, False}
    assert plain(line_rules.judge(frame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA))) == want
    monkeypatch.setattr(line_rules, "SHARE", 0.55)  # one of the two menu lines is beyond it
    want = judged(rows)
    assert {row[-1] for row in want if row[0] < 150} in ({0, 2}, {0, 4})
    assert plain(line_rules.judge(frame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA))) == want


def test_the_rule_acts_on_the_given_tables(spark):
    found = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.1").toPandas()
    passed = found[~found.base_failed]
    assert (found.n_removed > 0).sum() > 500
    assert 0 < (~passed.kept).sum() < 0.02 * len(passed)


def test_clean(frame):
    rows = shared_rows()
    docs = frame([(i, t, "en", s, len(t)) for i, t, s in rows] + [(0, rows[0][1], "en", "hot", 0)], SCHEMA).withColumnRenamed("lang", "TEXT")
    kept = {row[0]: row for row in judged(rows) if row[-2]}
    out = line_rules.clean(docs)
    assert out.columns == docs.columns
    got = {row[0]: row for row in out.collect()}
    assert set(got) == set(kept)
    for doc, row in got.items():
        text = rows[doc][1] if doc < 200 else next(t for i, t, _ in rows if i == doc)
        assert row[1] == (text.split("\n", 1)[1] if kept[doc][-1] else text) and (doc == 0 or row[4] == len(row[1]))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = sorted((tuple(row) for row in QUERIES["op8_quality_rules"](spark, folder).collect()), key=str)
    assert got == judged([(d.doc_id, d.text, d.source) for d in docs])
