"""Benchmark decontamination with one Aho-Corasick automaton over the words of all test items.

Items and documents are normalised alike: A-Z lower-cased, words are maximal runs of letters, digits
and non-ASCII characters. Every window of ``window`` consecutive item words (an item with fewer words
is one window) is a pattern of the automaton, whose alphabet is the items' words; a document is turned
into word numbers and scanned once, leaving out stretches of words that occur in no item. Word numbers are mapped back to code point offsets of the original.

The automaton lives in every task, so its size is bounded: items are dealt into as many automata as
``max_chars`` of item text each require, and findings of several automata are merged per document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import OWN, map_arrow

#: Words of a text as it stands, for offsets; the byte table below is the same rule for UTF-8, lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

FOUND = f"{OWN}n_words long, {OWN}n_hit long, {OWN}items array<long>, {OWN}spans array<struct<start:long,end:long>>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Windows:
    """The automaton of some items."""

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        self.ids: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            if item is None:
                continue
            numbers = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            for i in range(max(1, len(numbers) - window + 1)) if numbers else ():
                found[tuple(numbers[i : i + window])].add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, owners in found.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(sorted(owners))))
        self.any = bool(found)
        if self.any:
            self.automaton.make_automaton()
            # a match lies within a run of words that occur in items, no shorter than the shortest pattern
            self.runs = re.compile(b"\x01{%d,}" % min(map(len, found)))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word ranges hit (merged, end exclusive), and the items they come from."""
        if not self.any:
            return [], set()
        ranges, items = [], set()
        for run in self.runs.finditer(bytes(map(self.ids.__contains__, words))):
            first = run.start() + 1
            for end, (size, owners) in self.automaton.iter(tuple(map(self.ids.get, words[run.start() : run.end()]))):
                ranges.append((first + end - size, first + end))
                items.update(owners)
        return merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(r) for r in out]


def original(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code point offsets in the original text of ranges of word numbers."""
    places = [m.span() for m in WORD.finditer(text)]
    return [{"start": places[s][0], "end": places[e - 1][1]} for s, e in ranges]


def scanner(items: list[tuple[int, str | None]], window: int):
    windows = Windows(items, window)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, hits, owners, spans = [], [], [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            ranges, found = windows.scan(words)
            counts.append(len(words))
            hits.append(sum(e - s for s, e in ranges))
            owners.append(sorted(found))
            spans.append(original(text, ranges) if ranges else [])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.array(counts, dtype=np.int64)),
                pa.array(np.array(hits, dtype=np.int64)),
                pa.array(owners, pa.list_(pa.int64())),
                pa.array(spans, kind),
            ],
            names=[*batch.schema.names, *[c.split()[0] for c in FOUND.split(", ")]],
        )

    return step


def find_benchmark_words(
    documents: DataFrame, benchmark: DataFrame, window: int = 13, max_chars: int = 32_000_000
) -> DataFrame:
    """All columns of ``documents`` and, per row, what of the benchmark occurs in its ``text``.

    Added: ``__llm_n_words``, ``__llm_n_hit`` (words inside an occurrence of a window), ``__llm_items`` (ids
    of the items with occurring windows, ascending) and ``__llm_spans`` (merged occurrences, code points of
    the original text). ``documents`` needs ``text`` (NULL or empty: no words, no hits; any length);
    repeated rows are each reported. ``benchmark`` needs ``item_id`` and ``text``; items without id or words
    are ignored, several rows of an id count as one item, an empty table hits nothing.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-int(chars) // max_chars))
    deal = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields], FOUND])
    out = None
    for part in range(parts):
        rows = [tuple(r) for r in items.where(deal == part).collect()]
        build = partial(scanner, rows, window)
        if out is None:
            out = map_arrow(documents, build, schema)
            continue
        # a further automaton scans the same rows; its findings are added to those so far
        old = out.withColumnsRenamed({c.split()[0]: c.split()[0] + "0" for c in FOUND.split(", ")})
        names = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in old.schema.fields], FOUND])
        out = _merge(map_arrow(old, build, names), documents.columns)
    return out


def _merge(both: DataFrame, columns: list[str]) -> DataFrame:
    """One set of findings from two; overlapping word ranges are told from the spans in the text."""
    spans = f"array_sort(concat({OWN}spans0, {OWN}spans))"
    joined = (
        f"aggregate({spans}, cast(array() as array<struct<start:bigint,end:bigint>>), (a, s) -> case "
        "when size(a) > 0 and s.start <= a[size(a) - 1].end then concat(slice(a, 1, size(a) - 1), "
        "array(struct(a[size(a) - 1].start as start, greatest(a[size(a) - 1].end, s.end) as end))) "
        "else concat(a, array(s)) end)"
    )
    inside = "regexp_count(substring(text, cast(s.start as int) + 1, cast(s.end - s.start as int)), '[^\\\\x00-\\\\x2F\\\\x3A-\\\\x40\\\\x5B-\\\\x60\\\\x7B-\\\\x7F]+')"
    return both.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col(f"{OWN}n_words"),
        F.expr(f"aggregate({joined}, 0L, (n, s) -> n + {inside})").alias(f"{OWN}n_hit"),
        F.array_sort(F.array_union(f"{OWN}items0", f"{OWN}items")).alias(f"{OWN}items"),
        F.expr(joined).alias(f"{OWN}spans"),
    )


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col(f"{OWN}n_hit") > 0) & (20 * F.col(f"{OWN}n_hit") >= F.col(f"{OWN}n_words"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """``documents`` without the contaminated ones, columns unchanged."""
    found = find_benchmark_words(documents, benchmark, window)
    return found.where(~contaminated()).select(*[F.col(f"`{c}`") for c in documents.columns])
