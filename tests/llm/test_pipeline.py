"""The pipeline against its brute-force version: each stage by the plain counterpart of its own tests."""

import random
import re

import corpus_pipeline
from daybook.llm import decontaminate, line_rules, secrets
from daybook.session import shared_folders
from test_decontaminate import DOCS, ITEMS, every_window, many_documents
from test_line_rules import judged, normal
from test_packing import check, tokenizer  # noqa: F401  (a fixture)
from test_secrets import base_spans
from test_simhash import classes

FOLDER = "/root/testdata/sf0.001"


def shared_lines(rows):
    holders, hosts = {}, {}
    for doc, text, source in rows:
        hosts.setdefault(source, set()).add(doc)
        for line in text.split("\n"):
            holders.setdefault((source, normal(line)), set()).add(doc)
    return {key for key, own in holders.items() if key[1] and len(own) >= line_rules.SHARED
            and len(own) > line_rules.SHARE * len(hosts[key[0]])}


def redacted(text):
    """The strong spans replaced; overlapping ones by one placeholder."""
    out, upto = [], 0
    for start, _, end in base_spans(text):
        if start >= upto:
            out += [text[upto:start], secrets.PLACEHOLDER]
        upto = max(upto, end)
    return "".join(out) + text[upto:]


def plain(docs, items):
    rows = [(d.doc_id, d.text, d.source) for d in docs]
    common = shared_lines(rows)
    kept = {row[0] for row in judged(rows) if row[-2]}
    rows = [(doc, "\n".join(line for line in text.split("\n") if (source, normal(line)) not in common)) for doc, text, source in rows if doc in kept]
    first = {component for _, _, component in classes(rows)}
    rows = [row for row in rows if row[0] in first]
    leaking = {doc for doc, _ in every_window(rows, items)}
    return [(doc, redacted(text)) for doc, text in rows if doc not in leaking]


def test_run(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = [decontaminate.item_of(r.item_id, r.text, None) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = plain(docs, items)
    made = len(shared_folders())
    result = corpus_pipeline.run(spark, FOLDER)
    # of the first four stages only the last one's output is left; packing keeps what its own result reads
    left = [folder.rsplit("/", 1)[1].rsplit("-", 1)[0] for folder in shared_folders()[made:]]
    assert left[0] == "secret_scans" and not {name for name, _ in corpus_pipeline.STAGES[:3]} & set(left)
    rows = result.collect()
    assert 0 < len(want) < len(docs) and any(secrets.PLACEHOLDER in text for _, text in want)
    check(rows, want, tokenizer, 2048)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert out.where(f"n_chars <> length(text)").count() == docs.where("n_chars <> length(text)").count() == 0


def test_empty_and_extra_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    wide = docs.selectExpr("*", "1 AS TEXT", "2 AS row", "3 AS mark", "4 AS spans", "5 AS print").limit(30)
    for frame in (docs.where("false"), wide):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, FOLDER)
        rows = corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count()
        assert (rows > 0) == ("mark" in frame.columns)


def test_nulls_in_every_column(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(20)
    words = " ".join(f"word{chr(97 + i)}" for i in range(20))
    odd = spark.createDataFrame([(None, words, None, None, None), (None, None, None, None, None), (10**9, None, "en", "s", 0),
                                 (10**9 + 1, "", "en", "s", 0)], docs.schema)
    frame = docs.union(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, FOLDER)
        assert [row.text for row in frame.where("doc_id IS NULL").collect()] == [words]
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER)
    assert packed.where("doc_id IS NULL").count() == 1 and packed.where("doc_id >= 1000000000").count() == 0


def test_nothing_of_the_library_needs_it():
    for line in open(corpus_pipeline.__file__.replace("corpus_pipeline.py", "daybook/__init__.py")):
        assert not re.search(r"\bllm\b", line)


def test_decontamination_among_many_documents(spark, frame, tmp_path):
    """The stage's model is made of all documents: paraphrases go, however many others there are."""
    docs, items = many_documents(random.Random(14), "q")
    frame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    leaking = {doc for doc, _ in every_window(docs[-len(items):], [decontaminate.item_of(n, text, None) for n, text in items])}
    kept = {row.doc_id for row in corpus_pipeline.benchmark_decontamination(spark, frame(docs, DOCS), str(tmp_path)).collect()}
    every = {doc for doc, _ in docs}
    assert len(leaking) > 100 and every - leaking <= kept and len(kept & leaking) <= 0.01 * len(leaking)
