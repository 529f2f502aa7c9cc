"""Secret scan: spans of credentials, and weak candidates that only count beside their complementary parts.

Strong spans stand on their own (``assign``, ``access``, ``hex``). Weak parts, an account name, a key-like string or an
endpoint, are ordinary text by themselves. They are linked within a scope, a stretch of text without a blank line: an
interval join looks up the nearest identifier, secret and endpoint on either side of each part, at most ``REACH`` code
points away. Of each class only the nearest can matter, so the join runs as running maxima and minima over the parts
sorted by place, without listing pairs. Spans count code points; the end is exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.common import kept, pick, text_of, unpack

#: Fixed values of the contract: the strong kinds. A hex or access run that is long enough is the whole run.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGNED = 12

#: Weak kinds: an account name or key id given by name; a run of 20 or more key characters; a URL, or a host with a port.
#: They start at a boundary and never give back, so that long runs cost no more than their length.
IDENTIFIER = r"""(?<![A-Za-z0-9_])(?i:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]++"""
KEY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
ENDPOINT = (r"(?<![A-Za-z0-9+])[a-z][a-z0-9+]*+://[^\x20\x09-\x0D\x22'<>]++"
            r"|(?<![A-Za-z0-9.-])[A-Za-z0-9-]++\.[A-Za-z0-9.-]++:[0-9]{2,5}")
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*+\n"

KINDS = ["assign", "access", "hex", "identifier", "key", "endpoint", "break"]
BREAK = KINDS.index("break")
IDENTIFIERS, SECRETS, ENDPOINTS = (1, 3), (0, 2, 4), (5,)
#: Code points between two parts that belong together.
REACH = 200
PLACEHOLDER = "<SECRET>"
#: Rows that repeat one another and are written out in one go.
LOT = 4096


def _parts(text: Column, kind: str, pattern: str, gate: Column, counts) -> Column:
    """The matches of one kind, each with its length and that of the text since the last one; whether it counts at all."""
    found = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return found.alias(kind), lambda: F.transform(
        F.arrays_zip(F.col(kind).alias("own"), F.slice(F.split(text, pattern, -1), 1, F.size(kind)).alias("gap")),
        lambda pair, n: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), n.alias("n"), F.length(pair["gap"]).alias("gap"),
            F.length(pair["own"]).alias("own"), counts(pair["own"]).alias("counts")))


def _located(docs: DataFrame) -> DataFrame:
    """Every part of every document: ``doc_id, mark, copies, kind, start, end``.

    A part that does not count has no kind; a document without parts has one such row.
    """
    text = F.col("text")
    always = lambda _: F.lit(True)
    named = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    parts = [
        _parts(text, "assign", ASSIGN, named, lambda own: F.length(F.regexp_extract(own, ASSIGN, 2)) >= ASSIGNED),
        _parts(text, "access", ACCESS, F.contains(text, F.lit("AKIA")), always),
        _parts(text, "hex", HEX, F.lit(True), always),
        _parts(text, "identifier", IDENTIFIER, named, always),
        _parts(text, "key", KEY, F.lit(True), lambda own: own.rlike("[0-9]") & own.rlike("[A-Za-z]")),
        _parts(text, "endpoint", ENDPOINT, F.contains(text, F.lit(":")), always),
    ]
    found = docs.select("doc_id", "mark", "text", *[column for column, _ in parts])
    weak = F.size("identifier") + F.size("key") + F.size("endpoint") > 0
    breaks, broken = _parts(text, "break", BLANK_LINE, weak, always)
    none = F.array().cast("array<struct<kind:int,n:int,gap:int,own:int,counts:boolean>>")
    lists = [F.when(F.size(kind) > 0, steps()).otherwise(none) for kind, (_, steps) in
             zip(KINDS, [*parts, (None, broken)])]
    rows = found.select("*", breaks).select("doc_id", "mark", F.concat(*lists).alias("parts"))
    once = rows.groupBy("doc_id", "mark").agg(F.first("parts").alias("parts"), F.count(F.lit(1)).alias("copies")).select(
        "doc_id", "mark", "copies", F.explode_outer("parts").alias("part"))
    of_kind = W.partitionBy("doc_id", "mark", "part.kind").orderBy("part.n")
    end = F.sum(F.col("part.gap") + F.col("part.own")).over(of_kind).cast("int")
    return once.withColumn("end", end).select(
        "doc_id", "mark", "copies", F.when(F.col("part.counts"), F.col("part.kind")).alias("kind"),
        (F.col("end") - F.col("part.own")).alias("start"), "end")


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The interval join: which parts are reported, by the nearest parts of each class in the same scope."""
    doc = W.partitionBy("doc_id", "mark").orderBy("start", "kind")
    scoped = parts.withColumn("scope", F.count(F.when(F.col("kind") == BREAK, 1)).over(doc))
    scope = W.partitionBy("doc_id", "mark", "scope")
    before = scope.orderBy("start", "kind").rowsBetween(W.unboundedPreceding, -1)
    after = scope.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)

    def near(kinds: tuple[int, ...]) -> Column:
        left = F.max(F.when(F.col("kind").isin(*kinds), F.col("end"))).over(before)
        right = F.min(F.when(F.col("kind").isin(*kinds), F.col("start"))).over(after)
        return F.coalesce(F.col("start") - left <= reach, F.lit(False)) | F.coalesce(right - F.col("end") <= reach, F.lit(False))

    def inside(kinds: tuple[int, ...]) -> Column:
        left = F.max(F.when(F.col("kind").isin(*kinds), F.col("end"))).over(before)
        right = F.min(F.when(F.col("kind").isin(*kinds), F.col("start"))).over(after)
        return F.coalesce(left > F.col("start"), F.lit(False)) | F.coalesce(right < F.col("end"), F.lit(False))

    sights = scoped.select(
        "*", near(IDENTIFIERS).alias("identified"), near(SECRETS).alias("secret"), inside((0, 1, 2)).alias("known"),
        inside(ENDPOINTS).alias("address"))
    reported = (
        F.when(F.col("kind") < 3, True)
        .when(F.col("kind") == 3, ~F.col("known") & F.col("secret"))
        .when(F.col("kind") == 4, ~F.col("known") & ~F.col("address") & F.col("identified"))
        .when(F.col("kind") == 5, F.col("identified") & F.col("secret"))
        .otherwise(False))
    shown = F.when(reported, F.col("end"))
    upto = F.coalesce(F.max("shown").over(doc.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return sights.withColumn("shown", shown).withColumn("upto", upto)


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, mark, spans`` for every row of ``docs`` (``doc_id``, ``text``).

    ``mark`` is a hash of the text; ``spans`` an array of ``start, kind, end, upto`` by start and kind, where ``kind`` is a
    place in ``KINDS`` and ``upto`` the end of all earlier spans. Null text counts as empty; null ids are kept; rows that
    repeat come out as often. A document without a span has an empty array, an empty table gives an empty one. Parts that
    begin at one place are told apart by kind. Weak parts further apart than ``reach`` are not linked. All work on one
    document, however long, is linear in its length but for the sort of its parts.
    """
    texts = pick(docs, {"doc_id": "long", "text": "string"}).select("doc_id", text_of().alias("text"))
    parts = _linked(_located(texts.withColumn("mark", F.xxhash64("text"))), reach)
    span = F.when(F.col("shown").isNotNull(), F.struct("start", "kind", "end", "upto"))
    found = parts.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(span)).alias("spans"), F.max("copies").alias("copies"))
    lots = found.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {LOT}"))))
    rows = F.least(F.lit(LOT).cast("long"), F.col("copies") - F.col("lot") * LOT).cast("int")
    return lots.select("doc_id", "mark", "spans", F.explode(F.array_repeat(F.lit(0), rows))).drop("col")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, placeholder: str = PLACEHOLDER, reach: int = REACH) -> DataFrame:
    """The documents with every reported span replaced; ``n_chars``, if there, follows the new text. No row is dropped.

    A null text stays null; null ids, repeated rows, long texts and an empty table are as in :func:`scan`; of spans that
    overlap the whole stretch is replaced once. A text without a span, and columns of any name, stay as they are.
    """
    key = F.struct("doc_id", "mark").alias("key")  # nulls in it are alike
    whole = pick(docs, {"doc_id": "long", "text": "string"}, row=True).withColumn("mark", F.xxhash64(text_of())).select(key, "row")
    found = scan(docs, reach).where(F.size("spans") > 0).select(key, "spans").groupBy("key").agg(F.first("spans").alias("spans"))
    text, spans = F.coalesce(kept(docs.columns, "text").cast("string"), F.lit("")), F.col("spans")
    pieces = F.transform(spans, lambda s: F.when(s["start"] >= s["upto"], F.concat(
        F.substring(text, s["upto"] + 1, s["start"] - s["upto"]), F.lit(placeholder))).otherwise(""))
    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(text))
    clean = F.concat(F.array_join(pieces, ""), rest)
    made = whole.join(found, "key", "left").withColumn("clean", F.when(spans.isNotNull(), clean))
    changed = {"text": F.coalesce("clean", kept(docs.columns, "text").cast("string"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("clean").isNull(), kept(docs.columns, "n_chars")).otherwise(F.length("clean"))
    return unpack(made, docs.columns, changed)
