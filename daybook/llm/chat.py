"""Chat formatting: turns of a conversation as one training text, with the part that counts for the loss.

Turns are sorted as structs, adjacent turns of one role become one block, and all is concatenated by Spark expressions.
``<|start|>role<|says|>text<|next|>text<|end|>`` and a line feed make a block; ``<|next|>`` keeps the border between the
turns that were merged. A control string inside a text, ours or one of another well-known template, gets a backslash
behind its first character (one more than it had), so nothing in a text reads as control and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import pick

START, SAYS, NEXT, END = "<|start|>", "<|says|>", "<|next|>", "<|end|>\n"
LEARNED = "assistant"
#: What begins a control string: ``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, with any backslashes already there.
CONTROL = r"([<\[])(\\*+)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*+)(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments`` for each conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``segments`` are the pieces of ``formatted`` in order, each with whether it counts for the loss: the texts of the
    assistant do, all else does not. Null text or role counts as empty; turns with the same number go by role, then text;
    a null number comes first; rows with a null ``conv_id`` make one conversation. Repeated rows are turns of their own.
    A conversation becomes one row, so it has to fit into one; there is no further limit, however long its texts are, and all
    work is linear in it. An empty table gives an empty one, and columns of other names are not read.
    """
    rows = pick(turns, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sent = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    t = F.col("turns")
    first = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: F.when(i == 0, True).otherwise(
        F.get(t, i)["role"] != F.get(t, i - 1)["role"]))
    blocks = sent.select("conv_id", "turns", first.alias("first")).select("conv_id", F.transform("first", lambda i, n: F.struct(
        F.get(t, i)["role"].alias("role"),
        F.transform(F.slice(t, i + 1, F.coalesce(F.get("first", n + 1), F.size(t)) - i), lambda x: escape(x["text"])).alias("texts"),
    )).alias("blocks"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    off = F.lit(False)
    pieces = F.flatten(F.transform("blocks", lambda block: F.concat(
        F.array(segment(F.concat(F.lit(START), escape(block["role"]), F.lit(SAYS)), off)),
        F.flatten(F.transform(block["texts"], lambda text, n: F.concat(
            F.when(n > 0, F.array(segment(F.lit(NEXT), off))).otherwise(F.array().cast("array<struct<text:string,loss:boolean>>")),
            F.array(segment(text, block["role"] == LEARNED))))),
        F.array(segment(F.lit(END), off)))))
    return blocks.select("conv_id", pieces.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``role, text`` in order, the borders of merged turns restored."""
    blocks = F.filter(F.split(formatted, r"<\|start\|>"), lambda block: block != "")
    return F.flatten(F.transform(blocks, lambda block: F.transform(
        F.split(F.regexp_replace(F.element_at(F.split(block, r"<\|says\|>"), 2), r"<\|end\|>\n$", ""), r"<\|next\|>"),
        lambda text: F.struct(
            unescape(F.element_at(F.split(block, r"<\|says\|>"), 1)).alias("role"), unescape(text).alias("text")))))


def digests(chats: DataFrame) -> DataFrame:
    """What the contract asks for, read back from ``formatted`` and from the segments under the loss mask."""
    turns = chats.select("conv_id", "formatted", "segments", read_back(F.col("formatted")).alias("turns"))
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return turns.withColumn("learned", learned).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
