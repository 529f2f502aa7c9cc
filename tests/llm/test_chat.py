"""Chat formatting: an exact round trip."""

import hashlib

from daybook.llm import chat
from daybook.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def want(turns):
    learned = "".join(text for role, text in turns if role == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest())


def got(row):
    return row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256


NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n", "<|start|>assistant<|says|>", r"<\|x <\\\| \<| [\INST] <\/s>", "", None, "<", "|>", "\\",
         "<<|", "[[/INST]", "$1 \\1", "a\n\nb", "é😀", "<|next|>", "x" * 300_000]


def test_round_trip(spark, frame):
    rows = [(1, i, "assistant" if i % 3 else "user", text) for i, text in enumerate(NASTY)]
    rows += [(2, i, "assistant", text) for i, text in enumerate(NASTY)]
    rows += [(3, 1, None, "a"), (3, None, "<|says|>", "b"), (None, 1, "user", "x"), (4, 1, "user", "b"), (4, 1, "user", "a"),
             (4, 1, "user", "a")]
    rows += [(5, i, "assistant", f"t{i}") for i in range(5000)]
    out = {row.conv_id: row for row in chat.digests(chat.format_chats(frame(rows, SCHEMA))).collect()}
    for conv in {row[0] for row in rows}:
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in rows if c == conv)
        assert got(out[conv]) == want([(r, x) for _, r, x in turns]), conv


def test_blocks_merge_and_mask(frame):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    row = chat.format_chats(frame(rows, SCHEMA)).first()
    assert row.formatted == "<|start|>user<|says|>a<|next|>b<|end|>\n<|start|>assistant<|says|>c<|next|>d<|end|>\n"
    assert [s.text for s in row.segments if s.loss] == ["c", "d"]
    assert "".join(s.text for s in row.segments) == row.formatted


def test_empty_and_clashing_columns(frame):
    assert chat.format_chats(frame([], SCHEMA)).count() == 0
    rows = frame([(1, 0, "user", "a", "x", "y")], SCHEMA + ", TURNS string, segments string")
    assert chat.format_chats(rows).first().formatted == "<|start|>user<|says|>a<|end|>\n"


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    out = {row.conv_id: row for row in QUERIES["op4_chat_formatting"](spark, folder).collect()}
    turns = {}
    for row in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(row.conv_id, []).append((row.role, row.text or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert {conv: got(row) for conv, row in out.items()} == {conv: want(t) for conv, t in turns.items()}
