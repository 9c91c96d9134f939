"""Spelling variants: words that differ by one letter, found in a trie of letter counts.

A word's letters fall into groups; a word is arranged in the trie by its counts of group after group. One inserted,
deleted or replaced letter changes these counts by a surplus of one at most and a deficit of one at most, so a search goes
down from the root and spends a budget of one each; the words of the leaves that it reaches are verified. The search is
depth first over chunks of (word, node, budget), so its memory does not grow with the words.

The uppermost levels deal the words over tasks: counts of a few coarse groups make a cell. A word is kept in its own
cell and asked for in those that one surplus or deficit leads to, in one direction only, so each pair is found once.
As many coarse groups are used as it takes for cells of at most ``CELL`` words; if a cell is larger even then, its
words are dealt into parts and every asking word goes to each part.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import blocks, cut, map_arrow, ship
from capplan.llm.runs import Latin

#: Code points of a word at least, occurrences at least, and how many times rarer than its form.
MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10
#: One word of so many (by its hash) has a letter taken out.
ONE_OF = 31
#: Words of a cell, and states of a search that are worked on at a time.
CELL = 1 << 16
STATES = 1 << 16
#: Places of a trie's level in which children are looked up without a search.
CHILDREN = 1 << 20
#: Coarse groups at most, and groups of the trie within a cell.
COARSE = 6
FINE = 24

#: Letters by how common they are in European languages; groups take them in turn, so that all get common ones.
_COMMON = "eaitnrsoludcmpgbvhfqyxjkwz"


def _groups(n: int) -> np.ndarray:
    """The group of each code point up to 255: plain letters in turn, the others by their number."""
    out = np.arange(256) % n
    for k, letter in enumerate(_COMMON):
        out[ord(letter)] = k % n
    return out


_COARSE, _FINE = _groups(COARSE), _groups(FINE)


def crc_table() -> np.ndarray:
    """Steps of CRC-32 (reflected polynomial EDB88320) by byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = crc_table()


def _crc32(runs: Latin, picked: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes of each picked run."""
    size = (runs.ends - runs.starts)[picked]
    order = np.argsort(-size, kind="stable")
    state = np.full(len(picked), 0xFFFFFFFF, dtype=np.uint32)
    at, shorter = runs.starts[picked][order], -size[order]
    for k in range(int(size.max()) if len(size) else 0):
        live = int(np.searchsorted(shorter, -k, side="left"))
        part = state[:live]
        state[:live] = _CRC[(part ^ runs.bytes[at[:live] + k]) & 0xFF] ^ (part >> 8)
    out = np.empty(len(picked), dtype=np.uint32)
    out[order] = ~state
    return out


def _followed(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings one after the other, from those of each and the size of the second."""
    out = np.empty(len(first), dtype=np.uint32)
    order = np.argsort(-size, kind="stable")
    state, shorter = first[order], -size[order]
    for k in range(int(size.max()) if len(size) else 0):
        live = int(np.searchsorted(shorter, -k, side="left"))
        state[:live] = _CRC[state[:live] & 0xFF] ^ (state[:live] >> 8)
    out[order] = state
    return out ^ second


def _read(batches, min_length: int):
    """Words with their occurrences, block by block; of one word in ``ONE_OF`` a letter is left out."""
    import zlib

    for batch in batches:
        for block in blocks(batch, limit=8 << 20):
            runs = Latin(block.column("text"))
            first, number = runs.distinct()
            if not len(first):
                continue
            owner = runs.text(np.arange(len(number)))
            ids = block.column("doc_id").to_pylist()
            heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
            # one row for each word of a document
            both, count = np.unique(owner * len(first) + number, return_counts=True)
            doc, word = both // len(first), both % len(first)
            raw = np.array([runs.raw(k).decode() for k in first.tolist()], dtype=object)
            length = np.array([len(w) for w in raw], dtype=np.int64)
            size = (runs.ends - runs.starts)[first]
            # a hash depends on the document through its head only: heads are moved on once for each size of a word
            moved, at = np.unique(doc * (int(size.max()) + 1) + size[word], return_inverse=True)
            heads_at = _followed(heads[moved // (int(size.max()) + 1)], np.zeros(len(moved), np.uint32), moved % (int(size.max()) + 1))
            hashes = (heads_at[at] ^ _crc32(runs, first)[word]).astype(np.int64)
            cut_ = hashes % ONE_OF == 0
            plain = np.bincount(word[~cut_], weights=count[~cut_], minlength=len(first)).astype(np.int64)
            some = np.flatnonzero((plain > 0) & (length >= min_length))
            words, counts = raw[some].tolist(), plain[some].tolist()
            left = np.flatnonzero(cut_ & (length[word] > min_length))
            for w, p, c in zip(raw[word[left]].tolist(), (hashes[left] % length[word[left]]).tolist(), count[left].tolist(), strict=True):
                words.append(w[:p] + w[p + 1 :])
                counts.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])


def count_words(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: runs of letters (A-Z lower-cased, one in ``ONE_OF`` short of a letter) that are long and frequent enough."""
    ship(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(partial(_read, min_length=min_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Letters:
    """Words as bytes, one for each code point (all are below 256), one after the other."""

    def __init__(self, words: list[str]):
        self.data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def counts(self, groups: np.ndarray, n: int) -> np.ndarray:
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        return np.bincount(owner * n + groups[self.data], minlength=len(self.sizes) * n).reshape(-1, n)


class Trie:
    """Words arranged by their counts of one letter group after the other."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1]) if len(counts) else np.zeros(0, np.int64)
        ordered = counts[self.order]
        self.base = int(counts.max(initial=0)) + 2
        node = np.zeros(len(ordered), dtype=np.int64)
        self.edges: list[np.ndarray] = []
        self.children: list[np.ndarray | None] = []
        for level in range(counts.shape[1]):
            # children in order of (parent, count); a child's number is its place among them
            key = node * self.base + ordered[:, level]
            new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
            self.edges.append(key[new])
            room = (int(node[-1]) + 1) * self.base if len(node) else 0
            node = np.cumsum(new) - 1
            # a child by its parent and count, at once where there is room for all counts, else by a search
            child = np.full(room, -1, dtype=np.int32) if room <= CHILDREN else None
            if child is not None:
                child[key[new]] = np.arange(len(self.edges[-1]))
            self.children.append(child)
        self.leaf_starts = np.searchsorted(node, np.arange(int(node[-1]) + 2 if len(node) else 1))

    def search(self, counts: np.ndarray, states: int = STATES):
        """Chunks of (asking word, word of the trie) whose counts differ by one surplus and one deficit at most."""
        start = np.arange(len(counts))
        zero = np.zeros(len(counts), dtype=np.int64)
        stack = [(0, start[k : k + states], zero[k : k + states], zero[k : k + states]) for k in range(0, len(counts), states)]
        while stack:
            level, word, node, spent = stack.pop()
            if level == len(self.edges):
                leaves = np.diff(self.leaf_starts)[node]
                asking = np.repeat(word, leaves)
                inner = np.arange(leaves.sum()) - np.repeat(np.cumsum(leaves) - leaves, leaves)
                yield asking, self.order[np.repeat(self.leaf_starts[node], leaves) + inner]
                continue
            edges, child, want = self.edges[level], self.children[level], counts[word, level]
            words, nodes, spents = [], [], []
            # spent: 1 for the surplus, 2 for the deficit
            for change, cost in ((0, 0), (1, 1), (-1, 2)):
                may = np.flatnonzero((spent & cost) == 0) if cost else np.arange(len(word))
                count = want[may] + change
                may, count = may[(count >= 0) & (count < self.base)], count[(count >= 0) & (count < self.base)]
                key = node[may] * self.base + count
                if child is None:
                    at = np.searchsorted(edges, key)
                    hit = edges[np.minimum(at, len(edges) - 1)] == key
                else:
                    at = child[key]
                    hit = at >= 0
                words.append(word[may[hit]]), nodes.append(at[hit]), spents.append(spent[may[hit]] | cost)
            word, node, spent = (np.concatenate(c) for c in (words, nodes, spents))
            for k in range(0, len(word), states):
                stack.append((level + 1, word[k : k + states], node[k : k + states], spent[k : k + states]))


def one_apart(x: Letters, i: np.ndarray, y: Letters, j: np.ndarray) -> np.ndarray:
    """Whether word i of x and word j of y differ by exactly one inserted, deleted or replaced letter."""
    out = np.zeros(len(i), dtype=bool)
    a, b = x.sizes[i], y.sizes[j]
    some = np.flatnonzero(np.abs(a - b) <= 1)
    short = np.minimum(a, b)[some]
    # words of like sizes together, in chunks of bounded size
    for part in _chunks(some, short):
        width = int(np.minimum(a, b)[part].max(initial=0))
        span = np.arange(width)
        least = np.minimum(a, b)[part][:, None]
        inside = span < least

        def same(backwards: bool):
            p, q = x.starts[i[part]][:, None], y.starts[j[part]][:, None]
            if backwards:
                p, q = p + a[part][:, None] - 1 - span, q + b[part][:, None] - 1 - span
            else:
                p, q = p + span, q + span
            equal = inside & (x.data[np.where(inside, p, 0)] == y.data[np.where(inside, q, 0)])
            stop = np.concatenate([~equal, np.ones((len(part), 1), bool)], axis=1)
            return np.argmax(stop, axis=1)

        head, tail, n = same(False), same(True), np.maximum(a, b)[part]
        equal = (a[part] == b[part]) & (head == n)
        out[part] = ~equal & (head + tail >= n - 1)
    return out


def _chunks(some: np.ndarray, size: np.ndarray, limit: int = 1 << 21):
    order = np.argsort(size, kind="stable")
    total = np.cumsum(size[order] + 1) // limit
    for k in np.split(order, np.flatnonzero(np.diff(total)) + 1):
        # one chunk is padded to its longest word
        step = max(1, limit // int(size[k].max(initial=0) + 1)) if len(k) else 1
        for s in range(0, len(k), step):
            yield some[k[s : s + step]]


_CODE = np.int64(1) << (10 * np.arange(COARSE, dtype=np.int64))


def _cells(counts: np.ndarray, levels: int) -> np.ndarray:
    """A number for the coarse counts of the first levels (counts beyond 1023 wrap around, which only merges cells)."""
    return ((counts[:, :levels] & 1023) * _CODE[:levels]).sum(axis=1)


def _moves(levels: int) -> list[np.ndarray]:
    """The changes of counts by one surplus, or by one surplus and one deficit, in one of both directions."""
    one = np.eye(levels, dtype=np.int64)
    return [*one, *[one[i] - one[j] for i, j in combinations(range(levels), 2)]]


#: Words that live in a cell, the same words asking there, and words of other cells asking there.
HOME, OWN_CELL, VISITOR = 0, 1, 2
#: Words that ask at a time.
ASKING = 1 << 14

_ROWS = "cell long, kind int, word string, n long"


def _dealt(levels: int):
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column("word")
        counts = Letters(words.to_pylist()).counts(_COARSE, COARSE)
        own = _cells(counts, levels)
        all_ = np.arange(len(own))
        cells, kinds, index = [own, own], [np.full(len(own), HOME), np.full(len(own), OWN_CELL)], [all_, all_]
        for move in _moves(levels):
            there = counts[:, :levels] + move
            ok = np.flatnonzero((there >= 0).all(axis=1))
            cells.append(_cells(there[ok], levels)), kinds.append(np.full(len(ok), VISITOR)), index.append(ok)
        at = pa.array(np.concatenate(index))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(cells)), pa.array(np.concatenate(kinds).astype(np.int32)), words.take(at), batch.column("n").take(at)],
            names=["cell", "kind", "word", "n"],
        )

    return step


_PAIRS = "word string, near string, near_n long"


def _near(batches):
    """Pairs of near words, both ways; rows come by cell and part: words that live there, words of the cell, visitors."""
    key: tuple | None = None
    living: tuple[list[str], list[int]] = ([], [])
    asking: tuple[list[str], list[int]] = ([], [])
    trie: tuple[Trie, Letters] | None = None

    def pairs(kind: int):
        mine = Letters(asking[0])
        a, b = np.array(asking[0], dtype=object), np.array(living[0], dtype=object)
        n, m = np.array(asking[1], dtype=np.int64), np.array(living[1], dtype=np.int64)
        for i, j in trie[0].search(mine.counts(_FINE, FINE)):
            true = one_apart(mine, i, trie[1], j)
            if kind == OWN_CELL:  # such a pair is met from both sides
                true &= a[i] < b[j]
            i, j = i[true], j[true]
            if len(i):
                left, right = a[i].tolist(), b[j].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left + right, pa.string()), pa.array(right + left, pa.string()), pa.array(np.concatenate([m[j], n[i]]))],
                    names=[c.split()[0] for c in _PAIRS.split(", ")],
                )

    for batch in batches:
        for cell, part, kind, word, n in zip(*[batch.column(c).to_pylist() for c in ("cell", "part", "kind", "word", "n")], strict=True):
            if (cell, part, kind) != key:
                if asking[0]:
                    yield from pairs(key[2])
                    asking = ([], [])
                if key is None or (cell, part) != key[:2]:
                    living, trie = ([], []), None
                key = (cell, part, kind)
            if kind == HOME:
                living[0].append(word), living[1].append(n)
            elif living[0]:
                if trie is None:
                    letters = Letters(living[0])
                    trie = Trie(letters.counts(_FINE, FINE)), letters
                asking[0].append(word), asking[1].append(n)
                if len(asking[0]) == ASKING:
                    yield from pairs(kind)
                    asking = ([], [])
    if asking[0]:
        yield from pairs(key[2])


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """``word, near, near_n``: both directions of each pair of words (``word``, ``n``) that are one letter apart."""
    ship(words.sparkSession)
    counted = cut(
        map_arrow(words.select("word"), _coarse, ", ".join(f"c{k} long" for k in range(COARSE)))
        .groupBy(*[f"c{k}" for k in range(COARSE)])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    levels = COARSE
    for k in range(1, COARSE):
        most = counted.groupBy(*[f"c{i}" for i in range(k)]).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if (most or 0) <= cell:
            levels = k
            break
    number = sum((F.shiftleft(F.col(f"c{k}").bitwiseAND(F.lit(1023)), 10 * k) for k in range(levels)), F.lit(0).cast("long"))
    cells = counted.groupBy(number.alias("cell")).agg(F.ceil(F.sum("n") / cell).cast("int").alias("parts"))
    rows = map_arrow(words.select("word", "n"), partial(_dealt, levels), _ROWS).join(cells, "cell")
    parts = F.when(F.col("kind") == HOME, F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("parts") - 1)
    )
    dealt = rows.select("cell", F.explode(parts).alias("part"), "kind", "word", "n")
    ordered = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
    return ordered.mapInArrow(_near, _PAIRS)


def _coarse():
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = Letters(batch.column("word").to_pylist()).counts(_COARSE, COARSE)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in counts.T.copy()], names=[f"c{k}" for k in range(COARSE)])

    return step


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of rows ``word, form``: the last word that forms lead to.

    Each turn follows twice as many forms. A form is ``TIMES`` times as frequent as its word, so chains are short
    (19 words at 2^63 occurrences), and there are no circles.
    """
    found = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = found.join(further, "root", "left")
        if joined.where("next is not null").first() is None:
            return found
        found = cut(joined.select("word", F.coalesce("next", "root").alias("root")))


def group_variants(
    documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES, cell: int = CELL
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``documents`` (``doc_id``, ``text``).

    Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, of at least ``min_length`` code
    points and ``min_count`` occurrences over all rows. In a run whose CRC-32 of ``<doc_id>:<run>`` divides by ``ONE_OF``,
    the code point at that CRC modulo its length is left out first. ``n_near`` counts the words one inserted, deleted or
    replaced code point away; ``form`` is the most frequent of them (ties: the smallest) if it is at least ``times``
    times as frequent, else NULL; ``root`` is where forms lead to, the word itself without one.

    NULL text has no words; a NULL id counts as empty before the colon; repeated rows count each; words of any length are
    read whole. No rows give no rows; further columns are ignored.
    """
    words = cut(count_words(documents, min_length, min_count))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_words(words, cell).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    both = words.join(near, "word", "left")
    far = -F.col("best.less") >= times * F.col("n")
    judged = cut(
        both.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
