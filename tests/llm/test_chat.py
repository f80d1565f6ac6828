import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from fieldgauge.llm import chat

TURN = "conv_id long, turn long, role string, text string"
CONTROL = ["<|im_end|>", "<|im_start|>", "<\\|", "<\\\\|x", "<", "|", "\\", "\n", "é", "漢", "😀", "assistant", "", "a b"]


@given(st.lists(st.sampled_from(CONTROL), max_size=12).map("".join))
@settings(max_examples=200, deadline=None)
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape_role(chat.escape_role(text)) == text
    assert "<|" not in chat.escape(text)


def brute(turns):
    out = {}
    for c, t, r, x in sorted(turns, key=lambda r: [(v is not None, v if v is not None else 0) for v in r[:2]] + [r[2] or "", r[3] or ""]):
        out.setdefault(c, []).append((r or "", x or ""))
    return {
        c: (
            len(rows), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in rows).encode()).hexdigest(),
            sum(len(x) for r, x in rows if r == "assistant"),
            hashlib.sha256("".join(x for r, x in rows if r == "assistant").encode()).hexdigest(),
        )
        for c, rows in out.items()
    }


def digests(spark, turns, **options):
    blocks = chat.format_chats(spark.createDataFrame(turns, TURN), **options)
    return {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_digests(blocks).collect()}


def test_round_trip(spark):
    r = random.Random(3)
    turns = [
        (c, t, r.choice(["user", "assistant", "system"]), "".join(r.choices(CONTROL, k=r.randrange(8))))
        for c in range(60) for t in range(r.randrange(1, 9))
    ]
    assert digests(spark, turns) == brute(turns)
    assert digests(spark, turns, block_bytes=16) == brute(turns)


def test_long_conversation_is_cut_into_blocks(spark):
    turns = [(1, t, ("user", "assistant")[t % 2], f"text {t} <|") for t in range(3_000)] + [(2, 0, "assistant", "x" * 200_000 + "|<|")]
    blocks = chat.format_chats(spark.createDataFrame(turns, TURN), block_bytes=4_096)
    assert blocks.filter("conv_id = 1").count() > 5
    assert digests(spark, turns, block_bytes=4_096) == brute(turns)


def test_marks_and_spans(spark):
    (row,) = chat.format_chats(spark.createDataFrame([(7, 0, "user", "é<|im_end|>"), (7, 1, "assistant", "ok")], TURN)).collect()
    assert row["formatted"] == "<|im_start|>user\né<\\|im_end|><|im_end|>\n<|im_start|>assistant\nok<|im_end|>\n"
    (span,) = row["loss_spans"]
    assert row["formatted"][span["start"]:span["end"]] == "ok"


def test_edges(spark):
    assert digests(spark, []) == {}
    turns = [(None, None, None, None), (None, 1, "assistant", "x"), (1, 0, "a\nb\\n", ""), (1, 0, "a\nb\\n", ""), (2, 5, "assistant", None)]
    assert digests(spark, turns) == brute(turns)
