"""Quality rules: figures of each text, and lines that too many documents of a host share.

A line, lower-cased, digits as 0, blanks as one, is hashed. It is above the limit if at least ``SHARED`` documents of its
host hold it, and more than ``SHARE`` of the host's documents: the share keeps the rule alike at every size, the count keeps
it off small hosts. Such lines are removed, and a document is rejected if too little is left, copies included. The counts
are grouped sums that merge before the shuffle; a line that a third of all documents hold is one row per task there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import kept, pick, stored, text_of, unpack, words_of

SHARED, SHARE = 20, 0.01
#: Words, and share of its words, that a document keeps at least.
LEAST_WORDS, LEAST_SHARE = 10, 0.5
WINDOW = 5
#: Fixed values of the contract.
MOST_REPEATED = 20
SYMBOLS = "#*$%&|<>"


def repeat_words(words: Column, hashes: Column) -> Column:
    """Words in windows found twice or more: the repeated windows' places, each covering up to the next or its length.

    Windows are told apart by a 64-bit hash within one text. Only a text with a repeated hash is sorted.
    """
    n = F.size(hashes)
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    at = lambda array, i: F.get(array, i)["h"]
    # binding the sorted array as a lambda's variable keeps it from being sorted again for each element
    places = F.flatten(F.transform(F.array(by_hash), lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce(x["h"] == at(s, i - 1), F.lit(False)) | F.coalesce(x["h"] == at(s, i + 1), F.lit(False))),
        lambda x: x["i"]))))
    covered = F.flatten(F.transform(F.array(places), lambda p: F.transform(
        p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))))
    total = F.aggregate(covered, F.lit(0), lambda a, b: a + b)
    return F.when(F.size(F.array_distinct(hashes)) < n, total).otherwise(0)


def figures(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``text``, never null) and its figures: words, their code points, symbols, repeated lines and words."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    worded = docs.select(*docs.columns, words_of(text).alias("words"), lines.alias("rows"))
    hashes = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = worded.select(
        *docs.columns, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("rows") - F.size(F.array_distinct("rows"))).cast("long").alias("n_dup_lines"), hashes.alias("hashes"))
    return hashed.withColumn("n_repeat_words", repeat_words(F.col("hashes"), F.col("hashes")).cast("long")).drop("hashes")


def normal(text: Column) -> Column:
    """A text with its lines in normal form, but for blanks at their ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def _marked(docs: DataFrame, row: bool = False) -> DataFrame:
    frame = pick(docs, {"doc_id": "long", "source": "string", "text": "string"}, row)
    return frame.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), text_of().alias("text"), *["row"] * row).withColumn(
        "mark", F.xxhash64("text"))


def _shared(seen: DataFrame) -> DataFrame:
    """``at, n_removed, shared``: of each row that has lines above the limits, the words in these lines and their hashes."""
    lines = seen.select("at", "host", F.explode("lines").alias("x")).select("at", "host", "x.line", "x.words")
    own = seen.select("host", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    documents = seen.select("host", "doc_id").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    holders = own.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("holders"))
    above = stored(holders.where(F.col("holders") >= SHARED).join(documents, "host").where(
        F.col("holders") > SHARE * F.col("documents")).select("host", "line"), "shared-lines")
    return lines.join(above, ["host", "line"]).groupBy("at").agg(
        F.sum("words").alias("n_removed"), F.collect_set("line").alias("shared"))


def judge(docs: DataFrame) -> DataFrame:
    """Figures and verdict for every row of ``docs`` (``doc_id``, ``source``, ``text``), and the hashes of its shared lines.

    Null text counts as empty, and a document without words is rejected; a null source is the empty source; null ids are
    kept and count as one document; repeated rows come out as often and count once for the lines, and copies under other
    ids count each. An empty table gives an empty one; very long texts and lines are read whole. The text is read once; what
    follows works on figures and line hashes.
    """
    text = F.col("text")
    lines = F.filter(F.transform(F.split(normal(text), "\n"), lambda line: F.struct(
        line_hash(line).alias("line"), F.size(words_of(line)).alias("words"))), lambda x: x["words"] > 0)
    seen = stored(figures(_marked(docs).withColumn("lines", lines)).drop("text").withColumn("at", F.monotonically_increasing_id()), "figures")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed")
    return seen.drop("lines").join(_shared(seen), "at", "left").withColumn(
        "n_removed", F.coalesce("n_removed", F.lit(0).cast("long"))).withColumn("base_failed", base).select(
        "doc_id", "host", "mark", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~base & (left >= LEAST_WORDS) & (left >= LEAST_SHARE * F.col("n_words"))).alias("kept"), "n_removed", "shared")


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their shared lines, all columns kept; ``n_chars``, if there, follows the text.

    Rows with a null text have no words and go; null ids and sources, repeats, long texts and an empty table are as in
    :func:`judge`. Text of a document without a shared line stays as it is; columns of any name go along.
    """
    key = F.struct("doc_id", "host", "mark").alias("key")  # nulls in it are alike
    verdict = judge(docs).where("kept").select(key, "shared").groupBy("key").agg(F.first("shared").alias("shared"))
    passed = _marked(docs, row=True).select(key, "row").join(verdict, "key")
    text = F.coalesce(kept(docs.columns, "text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: ~F.array_contains("shared", line_hash(normal(line))))
    cleaned = passed.withColumn("clean", F.when(F.col("shared").isNotNull(), F.array_join(lines, "\n")))
    changed = {"text": F.coalesce("clean", text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("clean").isNull(), kept(docs.columns, "n_chars")).otherwise(F.length("clean"))
    return unpack(cleaned, docs.columns, changed)
