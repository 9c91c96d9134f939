"""Best-fit packing of tokenised documents into sequences of a fixed length by a grouping genetic algorithm.

``token_pieces`` turns documents into pieces of at most ``capacity`` tokens. ``pack`` deals the pieces at
random into shards of bounded size; the pieces of a shard are a bin-packing problem of their own. Several
islands work on each shard with populations of packings: crossover copies whole well-filled bins of one
packing into another, removes the bins that hold the same pieces again, and puts the displaced pieces back
by best fit, longest first. After each epoch an island sends its best packing to the next one of its shard.
Shards, islands and epochs are Spark groups; a task holds one shard, whatever the size of the input.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from collections import defaultdict
from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import OWN, blocks, cut, map_arrow, ship

CAPACITY = 2048
#: Pieces of one shard on average.
SHARD = 8192
#: Populations per shard, packings in each, exchanges of the best, and crossovers between two exchanges.
ISLANDS, POPULATION, EPOCHS, GENERATIONS = 2, 4, 2, 24
#: Runs of letters whose ids a task remembers, and as many words of another kind.
REMEMBERED = 500_000


#: Signs after a word that make one token run of their own (an apostrophe may join the word instead).
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"


class _Known(dict):
    """Ids of runs or words; one that is looked up for the first time is encoded."""

    def __init__(self, missing: Callable[[str], bytes]):
        self.missing = missing

    def __missing__(self, run: str) -> bytes:
        ids = self[run] = self.missing(run)
        return ids


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer file, each distinct word encoded once while remembered.

    A space after a character that isn't white space always begins a new token, whatever follows. A text
    can therefore be cut before such spaces and its parts encoded one by one; a part that ends in white
    space stays with the next. Most parts are letters and signs after them, which are one run each and go
    straight to the tokenizer's model; all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.bytes_of = [_packed([i]) for i in range(self.tokenizer.get_vocab_size())]
        # runs after a space and without one, and words of another kind
        self.spaced, self.bare, self.words = _Known(self._spaced), _Known(self._run), _Known(self._word)
        # the printable characters that stand for bytes in the vocabulary
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: 256 + hidden.index(b) if b in hidden else b for b in range(256)}
        self.space = chr(self.letters[32])
        self.newline = _packed([self.tokenizer.token_to_id(chr(self.letters[10]))])
        # a word's second run by the byte of its sign, none at 0
        self.signs = [self._run(chr(b)) if chr(b) in _SIGNS else b"" for b in range(128)]

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [_packed(e.ids) for e in found]

    def _run(self, run: str, space: str = "") -> bytes:
        """The ids of one run of letters or of signs, with a space before it or not."""
        shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.tokenize(space + shown)])

    def _spaced(self, run: str) -> bytes:
        return self._run(run, self.space)

    def _simple(self, word: str, runs: _Known) -> bytes | None:
        """The ids of letters and signs after them; None for anything else."""
        core = word.rstrip(_SIGNS)
        if not core.isalpha():
            return None
        return runs[core] + self.bare[word[len(core) :]] if len(core) < len(word) else runs[core]

    def _word(self, word: str) -> bytes:
        """The ids of any word that follows a space."""
        first, *lines = word.split("\n")
        found = [self._simple(first, self.spaced), *[self._simple(line, self.bare) for line in lines]]
        return self._encode([" " + word])[0] if None in found else self.newline.join(found)

    def _runs(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Ids of runs, and for each word that follows a space its two runs; the second of 0 is none.

        Letters of ASCII with at most one sign after them share their runs, other words are a run of their own.
        """
        core = pc.utf8_rtrim(words, _SIGNS)
        ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset + 1 : words.offset + len(words) + 1]
        sign = np.asarray(pc.binary_length(words)) - np.asarray(pc.binary_length(core))
        simple = np.asarray(pc.ascii_is_alpha(core)) & (sign <= 1)
        cores = core.filter(pa.array(simple)).dictionary_encode()
        odd = words.filter(pa.array(~simple))
        ids = [*self.signs, *map(self.spaced.__getitem__, _strings(cores.dictionary)), *map(self.words.__getitem__, _strings(odd))]
        first, second = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        first[simple] = len(self.signs) + cores.indices.to_numpy()
        first[~simple] = len(ids) - len(odd) + np.arange(len(odd))
        signed = np.flatnonzero(simple & (sign == 1))
        if len(signed):
            second[signed] = np.frombuffer(words.buffers()[2], np.uint8)[ends[signed] - 1]
        return ids, first, second

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if not texts:
            return []
        order, parts = _split(texts)
        bounds = parts.offsets.to_numpy()
        coded = parts.values.dictionary_encode()
        code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        head = np.zeros(len(code), dtype=bool)
        head[bounds[:-1]] = True
        heads = self._encode(parts.values.filter(pa.array(head)).to_pylist())
        # the first part of a text follows no space
        used, number = np.unique(code[~head], return_inverse=True)
        ids, first, second = self._runs(words.take(pa.array(used)))
        runs = np.zeros((len(code), 2), dtype=np.int64)
        runs[~head, 0], runs[~head, 1] = first[number], second[number]
        runs[head, 0] = len(ids) + np.arange(len(heads))
        ids += heads
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = length[runs].reshape(-1)
        ends = np.cumsum(n)
        start = (np.cumsum(length) - length)[runs].reshape(-1) - (ends - n)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")[np.repeat(start, n) + np.arange(ends[-1])]
        out, edges = [b""] * len(texts), [0, *ends[2 * bounds[1:].astype(np.int64) - 1].tolist()]
        for k, s, e in zip(order, edges[:-1], edges[1:], strict=True):
            out[k] = flat[s:e].tobytes()
        for known in (self.spaced, self.bare, self.words):
            if len(known) > REMEMBERED:
                known.clear()
        return out


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: The white space of ASCII and all other, as ``str.isspace`` has it, and where some of ASCII stands before a space.
_BLANK = "".join(c for c in map(chr, range(128)) if c.isspace())
_WIDE = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isspace())
_GAPS = [c + " " for c in _BLANK]


def _plain(text: str) -> bool:
    """Whether every space of the text stands between characters that aren't white space, and none at its ends."""
    if text[:1] in _BLANK or text[-1:] in _BLANK or any(gap in text for gap in _GAPS):
        return False
    return text.isascii() or not (text[-1] in _WIDE or any(c in text and c + " " in text for c in _WIDE))


def _parts(text: str) -> list[str]:
    """The text cut before single spaces, without those spaces."""
    parts = text.split(" ")
    if _plain(text):
        return parts
    out, held = [], None
    for part in parts:
        held = part if held is None else f"{held} {part}"
        if held and not held[-1].isspace():
            out.append(held)
            held = None
    if held is not None:  # white space at the end belongs to what stands before it
        out = [*out[:-1], f"{out[-1]} {held}"] if out else [held]
    return out


def _split(texts: list[str]) -> tuple[list[int], pa.ListArray]:
    """The parts of all texts, plain texts first, and the number of the text for each list of parts."""
    odd = [k for k, t in enumerate(texts) if not _plain(t)]
    rest = sorted({*range(len(texts))}.difference(odd))
    plain = pc.split_pattern(pa.array([texts[k] for k in rest], pa.large_string()), " ")
    return rest + odd, pa.concat_arrays([plain, pa.array([_parts(texts[k]) for k in odd], plain.type)])


_ENCODERS: dict[str, Encoder] = {}


def _piecer(path: str, capacity: int, ids: bool):
    encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, piece, start, length, crc, data = [], [], [], [], [], []
        row = 0
        for block in blocks(batch, limit=4 << 20):
            for encoded in encoder.texts([t or "" for t in block.column("text").to_pylist()]):
                encoded += b"\0\0\0\0"
                n = len(encoded) // 4
                end = n - (n - 1) // capacity * capacity
                begin = number = 0
                while begin < n:
                    part = encoded[4 * begin : 4 * end]
                    rows.append(row)
                    piece.append(number)
                    start.append(begin)
                    length.append(end - begin)
                    crc.append(zlib.crc32(part))
                    if ids:
                        data.append(part)
                    begin, end, number = end, end + capacity, number + 1
                row += 1
        columns = [
            batch.column("doc_id").take(pa.array(rows, pa.int64())),
            pa.array(piece, pa.int32()),
            *[pa.array(c, pa.int64()) for c in (start, length, crc)],
        ]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if ids:
            columns, names = [*columns, pa.array(data, pa.binary())], [*names, "ids"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return step


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` (little-endian 32-bit numbers).

    A document is its ids and a closing 0. Only documents of more than ``capacity`` tokens are cut, into
    pieces of ``capacity``; their first piece may be shorter. NULL and empty text are the closing 0 alone,
    repeated rows give repeated pieces, further columns are left out, no rows give no pieces.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, partial(_piecer, tokenizer, capacity, ids), schema)


class Packing:
    """A packing of items with given lengths: the bin of each item."""

    def __init__(self, lengths: np.ndarray, capacity: int, bins: np.ndarray | None = None):
        self.lengths, self.capacity = lengths, capacity
        self.bins = np.full(len(lengths), -1, dtype=np.int32) if bins is None else bins

    def loads(self) -> np.ndarray:
        return np.bincount(self.bins, weights=self.lengths).astype(np.int64)

    def score(self) -> tuple[int, float]:
        """Fewest bins first, then the fullest bins (mean of squared loads)."""
        loads = self.loads()
        return len(loads), -float(((loads / self.capacity) ** 2).mean()) if len(loads) else 0.0

    def fit(self, order: np.ndarray) -> Packing:
        """Puts items that have no bin into the open bin that they leave least room in, in the given order."""
        used = self.bins[self.bins >= 0]
        loads = np.bincount(used, weights=self.lengths[self.bins >= 0]).astype(np.int64) if len(used) else []
        by_room: dict[int, list[int]] = defaultdict(list)
        rooms = 0  # bit r is set if some bin has room r
        for number, load in enumerate(loads):
            if load < self.capacity:
                by_room[self.capacity - int(load)].append(number)
                rooms |= 1 << (self.capacity - int(load))
        next_bin, bins = len(loads), self.bins
        for item, size in zip(order.tolist(), self.lengths[order].tolist(), strict=True):
            fitting = rooms >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                number = by_room[room].pop()
                if not by_room[room]:
                    rooms ^= 1 << room
            else:
                room, number, next_bin = self.capacity, next_bin, next_bin + 1
            bins[item] = number
            if room > size:
                if not by_room[room - size]:
                    rooms |= 1 << (room - size)
                by_room[room - size].append(number)
        return self

    def crossed(self, other: Packing, random: np.random.Generator) -> Packing:
        """A child of this packing with some of the other's well-filled bins."""
        loads = other.loads()
        ranked = np.argsort(-loads + random.integers(0, max(2, self.capacity // 64), len(loads)))
        chosen = np.zeros(len(loads), dtype=bool)
        chosen[random.permutation(ranked[: max(1, len(loads) // 2)])[: max(1, len(loads) // 10)]] = True
        injected = chosen[other.bins]
        broken = np.zeros(int(self.bins.max()) + 1, dtype=bool)
        broken[self.bins[injected]] = True
        # the emptiest bins are opened too, so that their items can find better places
        own = self.loads()
        broken[np.argsort(own)[: max(1, len(own) // 50)]] = True
        displaced = broken[self.bins] & ~injected
        child = np.where(injected, other.bins + len(broken), self.bins)
        child[displaced] = -1
        placed = ~displaced
        child[placed] = np.unique(child[placed], return_inverse=True)[1]
        order = np.flatnonzero(displaced)
        return Packing(self.lengths, self.capacity, child.astype(np.int32)).fit(order)


def first_packings(lengths: np.ndarray, capacity: int, random: np.random.Generator, n: int) -> list[Packing]:
    """Best fit, longest first (items come in that order), and variants with lengths blurred for the order."""
    out = [Packing(lengths, capacity).fit(np.arange(len(lengths)))]
    while len(out) < n:
        blurred = lengths * (1 + 0.1 * len(out) * random.random(len(lengths)))
        out.append(Packing(lengths, capacity).fit(np.argsort(-blurred, kind="stable")))
    return out


def evolve(packings: list[Packing], random: np.random.Generator, generations: int) -> list[Packing]:
    """Steady state: each child takes the place of the worst packing if it is better."""
    for _ in range(generations):
        packings.sort(key=Packing.score)
        best = packings[0]
        if len(packings) < 2 or best.score()[0] * best.capacity - int(best.lengths.sum()) < best.capacity:
            break  # no packing can need fewer bins
        a, b = random.choice(len(packings), 2, replace=False)
        child = packings[a].crossed(packings[b], random)
        if child.score() < packings[-1].score():
            packings[-1] = child
    packings.sort(key=Packing.score)
    return packings


_STATE = f"{OWN}shard long, island int, lengths binary, bins binary"


def _ordered(items: pa.Table) -> pa.Table:
    """The items of a shard in an order that every island sees alike: longest first."""
    return items.sort_by([("length", "descending"), (f"{OWN}id", "ascending")])


def _settle(shard: int, capacity: int, islands: int, lengths: np.ndarray) -> pa.Table:
    rows = []
    for island in range(islands):
        random = np.random.default_rng([abs(shard), island])
        for packing in first_packings(lengths, capacity, random, POPULATION)[island and 1 :]:
            rows.append((shard, island, lengths.astype("<i4").tobytes(), packing.bins.astype("<i4").tobytes()))
    return _state(rows)


def _state(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _STATE.split(", ")]
    )


def _epoch(state: pa.Table, capacity: int, islands: int, epoch: int) -> pa.Table:
    """One island between two exchanges: it keeps its packings and sends the best to the next island."""
    shard, island = state.column(0)[0].as_py(), state.column(1)[0].as_py()
    lengths = np.frombuffer(state.column(2)[0].as_py(), dtype="<i4")
    packings = [Packing(lengths, capacity, np.frombuffer(b.as_py(), dtype="<i4").copy()) for b in state.column(3)]
    packings.sort(key=lambda p: (*p.score(), p.bins.tobytes()))
    random = np.random.default_rng([abs(shard), island, epoch])
    evolved = evolve(packings, random, GENERATIONS)
    raw = lengths.astype("<i4").tobytes()
    kept = [(shard, island, raw, p.bins.astype("<i4").tobytes()) for p in evolved[:POPULATION]]
    if islands > 1:
        kept.append((shard, (island + 1) % islands, raw, kept[0][3]))
    return _state(kept)


def _place(items: pa.Table, state: pa.Table, capacity: int) -> pa.Table:
    """The pieces of a shard with their places in its best packing."""
    items = _ordered(items)
    lengths = items.column("length").to_numpy().astype(np.int64)
    found = [Packing(lengths, capacity, np.frombuffer(b.as_py(), dtype="<i4")) for b in state.column("bins")]
    bins = min(found, key=lambda p: (*p.score(), p.bins.tobytes())).bins
    by_bin = np.lexsort((np.arange(len(bins)), bins))
    ends = np.cumsum(lengths[by_bin])
    first = np.concatenate([[True], np.diff(bins[by_bin]) > 0])
    before = (ends - lengths[by_bin])[first]
    offsets = np.empty(len(bins), dtype=np.int64)
    offsets[by_bin] = ends - lengths[by_bin] - before[np.cumsum(first) - 1]
    shard = items.column(f"{OWN}shard")[0].as_py()
    items = items.drop_columns([f"{OWN}shard", f"{OWN}id"])
    items = items.append_column("sequence_id", pa.array((shard << 32) + bins.astype(np.int64)))
    return items.append_column("offset", pa.array(offsets))


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, islands: int = ISLANDS) -> DataFrame:
    """All columns of ``pieces`` (``length`` from 1 to ``capacity``), ``sequence_id`` and ``offset``.

    The offsets of a sequence are gapless from 0 to at most ``capacity``. Repeated rows are packed each; no
    rows give an empty result; columns named ``sequence_id`` or ``offset`` are replaced. Packings follow from
    the pieces and their order alone, so a task that is run again gives the same.
    """
    spark = pieces.sparkSession
    ship(spark)
    pieces = cut(pieces.drop("sequence_id", "offset"))
    shards = max(1, -(-pieces.count() // shard))
    numbered = pieces.withColumn(f"{OWN}id", F.monotonically_increasing_id())
    dealt = numbered.withColumn(f"{OWN}shard", F.pmod(F.xxhash64(f"{OWN}id"), F.lit(shards)))

    def settle(items: pa.Table) -> pa.Table:
        lengths = _ordered(items).column("length").to_numpy().astype(np.int64)
        return _settle(items.column(f"{OWN}shard")[0].as_py(), capacity, islands, lengths)

    def epoch(number: int):
        return lambda state: _epoch(state, capacity, islands, number)

    state = dealt.select(f"{OWN}shard", f"{OWN}id", "length").groupBy(f"{OWN}shard").applyInArrow(settle, _STATE)
    for number in range(EPOCHS):
        state = state.groupBy(f"{OWN}shard", "island").applyInArrow(epoch(number), _STATE)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return (
        dealt.groupBy(f"{OWN}shard")
        .cogroup(state.groupBy(f"{OWN}shard"))
        .applyInArrow(lambda i, s: _place(i, s, capacity), f"{schema}, sequence_id long, offset long")
    )
