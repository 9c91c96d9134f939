"""Chat formatting over prefix trees: conversations that begin alike share what they have in common.

Every distinct beginning of a conversation (its first turns with their roles and texts) is a node of a tree.
Trees are written to blocks: each node's formatted turn once, depth first, with the position of its first
character counted from the root (shared turns have the position that they have in each conversation) and
the intervals of the block that its characters may attend to, its ancestors' and its own. A conversation
is its last node's intervals, one after the other.

Conversations with the same first turn go to one block; a first turn with very many conversations is dealt
over several, so that a block stays of bounded size, and is written once in each. Units are characters of
the formatted text. Texts cross the network compressed, those of one conversation together.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import cut, map_arrow, ship

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts are learnt.
LEARNT = "assistant"
#: Conversations of a block on average, and from which number on a first turn has blocks of its own.
BLOCK = 256

_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""Makes control strings in a text harmless: ``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|``, and so on."""
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends."""
    head = START + escape(role.replace("%", "%25").replace("\n", "%0A")) + "\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


_TURN = re.compile(re.escape(START) + "(.*)\n((?s:.*?))" + re.escape(END) + "\n")


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role and text of every turn of a formatted conversation, and where the text begins and ends."""
    at = 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        role = unescape(found[1]).replace("%0A", "\n").replace("%25", "%")
        yield role, unescape(found[2]), *found.span(2)
        at = found.end()


class Forest:
    """Prefix trees of some conversations."""

    def __init__(self):
        self.turns: list[tuple[str, str]] = []
        self.parents: list[int] = []
        self.children: list[dict[tuple[str, str], int]] = []
        self.roots: dict[tuple[str, str], int] = {}
        self.ends: list[tuple[int | None, int]] = []

    def add(self, conversation: int | None, turns: list[tuple[str, str]]) -> None:
        level, node = self.roots, -1
        for turn in turns:
            if turn not in level:
                level[turn] = len(self.turns)
                self.turns.append(turn)
                self.parents.append(node)
                self.children.append({})
            node = level[turn]
            level = self.children[node]
        self.ends.append((conversation, node))

    def written(self) -> dict:
        """The block: its text, its nodes depth first, and the last node of each conversation."""
        text, nodes, number = [], [], {}
        spans: list[list[tuple[int, int]]] = []
        at = 0
        stack = list(reversed(self.roots.values()))
        while stack:
            node = stack.pop()
            stack.extend(reversed(self.children[node].values()))
            role, words = self.turns[node]
            turn, begin, end = turn_text(role, words)
            parent = number.get(self.parents[node], -1)
            seen = spans[parent] if parent >= 0 else []
            position = nodes[parent]["position"] + nodes[parent]["end"] - nodes[parent]["start"] if parent >= 0 else 0
            if seen and seen[-1][1] == at:
                seen = [*seen[:-1], (seen[-1][0], at + len(turn))]
            else:
                seen = [*seen, (at, at + len(turn))]
            number[node] = len(nodes)
            learnt = role == LEARNT
            nodes.append(
                {
                    "start": at,
                    "end": at + len(turn),
                    "position": position,
                    "parent": parent,
                    "attend": [{"start": s, "end": e} for s, e in seen],
                    "loss_start": at + begin if learnt else None,
                    "loss_end": at + end if learnt else None,
                }
            )
            spans.append(seen)
            text.append(turn)
            at += len(turn)
        ends = [{"conv_id": c, "node": number[n]} for c, n in self.ends]
        return {"text": "".join(text), "nodes": nodes, "conversations": ends}


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_NODE = pa.struct(
    [
        *[(n, pa.int64()) for n in ("start", "end", "position", "parent")],
        ("attend", pa.list_(_SPAN)),
        *[(n, pa.int64()) for n in ("loss_start", "loss_end")],
    ]
)
_END = pa.struct([("conv_id", pa.int64()), ("node", pa.int64())])
_BLOCK = pa.schema(
    [("block", pa.int64()), ("text", pa.string()), ("nodes", pa.list_(_NODE)), ("conversations", pa.list_(_END))]
)
BLOCKS = (
    "block long, text string, nodes array<struct<start:long,end:long,position:long,parent:long,"
    "attend:array<struct<start:long,end:long>>,loss_start:long,loss_end:long>>, "
    "conversations array<struct<conv_id:long,node:long>>"
)


def _packer():
    """Turns of a batch that belong together, compressed as one."""
    squeeze = zstandard.ZstdCompressor(level=9).compress

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[int | None, list] = {}
        for conversation, *turn in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            found.setdefault(conversation, []).append(turn)
        packed = [squeeze(json.dumps(t, ensure_ascii=False).encode()) for t in found.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.int64()), pa.array(packed, pa.binary())], names=["conv_id", "turns"]
        )

    return step


def _write(rows: pa.Table) -> pa.Table:
    expand = zstandard.ZstdDecompressor().decompress
    found: dict[int | None, list] = {}
    for conversation, packed in zip(rows.column("conv_id").to_pylist(), rows.column("turns").to_pylist(), strict=True):
        found.setdefault(conversation, []).extend(json.loads(expand(packed)))
    forest = Forest()
    for conversation in sorted(found, key=lambda c: (c is None, c)):
        turns = sorted(found[conversation], key=lambda t: (t[0] is not None, t[0], t[1], t[2]))
        forest.add(conversation, [(role, text) for _, role, text in turns])
    block = forest.written()
    return pa.Table.from_pylist([{"block": rows.column("block")[0].as_py(), **block}], schema=_BLOCK)


def format_conversations(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per block: its text, the nodes of its trees depth first, and each conversation's last node.

    ``conversations`` needs ``conv_id, turn, role, text``; rows are turns in any order. NULL text or role counts
    as empty; rows of one conversation with equal ``turn`` come in order of role and text, repeated rows are
    turns of their own, NULL turns come first; rows without ``conv_id`` are one conversation. Texts may be of any
    length and hold the template's own marks. No rows give no blocks.
    """
    ship(conversations.sparkSession)
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    first = rows.groupBy("conv_id").agg(F.min(F.struct("turn", "role", F.xxhash64("text").alias("text"))).alias("first"))
    roots = cut(first.select("conv_id", F.xxhash64("first.role", "first.text").alias("root")))
    blocks = max(1, -(-roots.count() // block))
    counts = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    own = F.struct(F.lit(1).alias("own"), F.col("root").alias("root"), F.pmod(F.xxhash64("conv_id"), F.ceil(2 * F.col("n") / block)).alias("deal"))
    common = F.struct(F.lit(0).alias("own"), F.pmod("root", F.lit(blocks)).alias("root"), F.lit(0).cast("long").alias("deal"))
    dealt = roots.join(counts, "root").select(
        F.col("conv_id").alias("id"), F.xxhash64(F.when(F.col("n") > block, own).otherwise(common)).alias("block")
    )
    packed = map_arrow(rows, _packer, "conv_id long, turns binary")
    placed = packed.join(dealt, F.col("conv_id").eqNullSafe(F.col("id"))).select("block", "conv_id", "turns")
    return placed.groupBy("block").applyInArrow(_write, BLOCKS)


def conversation_text(block: dict, node: int) -> tuple[str, list[tuple[int, int]]]:
    """A conversation as formatted, from the intervals of its last node, and its loss mask."""
    text, spans, mask = [], [], []
    while node >= 0:
        spans.append(node)
        node = block["nodes"][node]["parent"]
    for number in reversed(spans):
        at = block["nodes"][number]
        if at["loss_start"] is not None:
            offset = at["position"] - at["start"]
            mask.append((at["loss_start"] + offset, at["loss_end"] + offset))
    for span in block["nodes"][spans[0]]["attend"]:
        text.append(block["text"][span["start"] : span["end"]])
    return "".join(text), mask


def _reader():
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in range(batch.num_rows):
            block = batch.slice(row, 1).to_pylist()[0]
            for end in block["conversations"]:
                formatted, mask = conversation_text(block, end["node"])
                turns, loss, n = hashlib.sha256(), hashlib.sha256(), 0
                for role, text, *_ in parse(formatted):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                learnt = [unescape(formatted[s:e]) for s, e in mask]
                for text in learnt:
                    loss.update(text.encode())
                out.append((end["conv_id"], n, turns.hexdigest(), sum(map(len, learnt)), loss.hexdigest(), len(formatted)))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return step


def read_back(blocks: DataFrame) -> DataFrame:
    """Per conversation, from its block alone: turns, a hash of them, and what is under the loss mask."""
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(blocks, _reader, kind)
