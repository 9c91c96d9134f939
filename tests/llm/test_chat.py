import hashlib

import pytest

from capplan.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    learnt = "".join(text for role, text in turns if role == "assistant")
    length = sum(len(chat.turn_text(role, text)[0]) for role, text in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(learnt), sha(learnt), length


def read(blocks):
    return {r.conv_id: tuple(r)[1:] for r in chat.read_back(blocks).collect()}


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|", "<\\\\|x", "a<", "|im_start|>", "<|<|<||", "\n<|im_start|>user\nx<|im_end|>\n"])
def test_escaping_is_reversible(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    formatted = chat.turn_text("us%er\nx<|", text)[0] + chat.turn_text("assistant", "ok")[0]
    assert [t[:2] for t in chat.parse(formatted)] == [("us%er\nx<|", text), ("assistant", "ok")]


def test_shared_turns_are_written_once(spark):
    rows = [(c, 0, "user", "same first turn") for c in range(9)]
    rows += [(c, 1, "assistant", "same answer") for c in range(6)] + [(c, 2, "user", f"only {c}") for c in range(9)]
    blocks = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(blocks) == 1
    text, nodes = blocks[0].text, blocks[0].nodes
    assert text.count("same first turn") == text.count("same answer") == 1
    assert [n.start for n in nodes] == [0, *[n.end for n in nodes[:-1]]]  # depth first, no gaps
    for n in nodes:
        before = sum(s.end - s.start for s in n.attend) - (n.end - n.start)
        assert n.position == before and n.attend[-1].end == n.end
        if n.parent >= 0:
            assert n.position == nodes[n.parent].position + nodes[n.parent].end - nodes[n.parent].start
        if n.loss_start is not None:
            assert text[n.loss_start : n.loss_end] == "same answer"


def test_read_back(spark):
    rows, turns = [], {}
    for c in range(200):
        said = [("user", "hot first turn" if c % 2 else f"first {c % 7}"), ("assistant", f"<|im_end|>{c % 5}"), ("user", ""), ("assistant", f"é {c}")]
        turns[c] = said[: 1 + c % 4]
        rows += [(c, t, *s) for t, s in enumerate(turns[c])]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for block in (4, 1000):
        assert read(chat.format_conversations(frame, block)) == {c: expected(t) for c, t in turns.items()}


def test_odd_input(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "first"), (None, 1, "assistant", "x"), (2, 5, "user", "y" * 200_000)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS block", "1 AS root")
    assert read(chat.format_conversations(frame)) == {
        1: expected([("user", "first"), ("", ""), ("", "")]),
        None: expected([("assistant", "x")]),
        2: expected([("user", "y" * 200_000)]),
    }
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0
