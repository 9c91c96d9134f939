"""Line deduplication as an exact set-similarity join of lines.

A line is the set of its words. Words are ordered from rare to frequent; two sets of Jaccard similarity of
at least the threshold have one of their rarest words in common, so each line is sent to as many of its
rarest words as that takes. There, lines are compared in document order under the length filter, the
positional filter (what can still be common after the shared word's places) and a bound from 128-bit
tallies of words; what passes is verified on whole sets. A line is removed if any earlier line is similar to it.

Each line is sent on with its earliest candidates only, so copies of a line by the thousand cost a row
each and not a pair each. A line whose candidates all fail, and which had more of them, is compared with more of
them in a second turn, and so on with ever more until none is left that could have missed one, so nothing is lost.
There, rows have parities of the set's words besides, at least one for each word and many more for each of a few,
which tell sets of any size apart.
"""

from __future__ import annotations

import uuid
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm import rarity
from capplan.llm.common import OWN, Words, blocks, cut, expanded, map_arrow, mix, released, scramble, shared_folder, ship, squeezed

#: Hundredths of similarity from which a line repeats an earlier one.
SHARE = 80
#: Earliest candidates of a line that one shared word sends on.
EARLIEST = 1
#: Candidates of a line at one shared word among which the earliest are taken; with so many it has more.
ENOUGH = 64
#: Later lines of one comparison.
HOT = 1 << 16
#: Candidates of a failing line at one shared word in the second turn, and how many times more in each later one.
KEPT, MORE = 8, 8
#: Parities of each word of a set in rows that are sent again, and words of a set up to which it has so many.
APART, FINE = 32, 64
#: Candidates that are held at a time while the first few of each line are taken.
HELD = 1 << 20
#: Column of further parities in rows that are sent again.
WIDE = "wide"

_LAST = (1 << 63) - 1


def _ordered(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The order by owner (ascending already), then value; a radix sort brings owners back together."""
    order = np.argsort(values)
    small = np.uint16 if not len(owner) or owner[-1] < 1 << 16 else np.int64
    return order[np.argsort(owner[order].astype(small), kind="stable")]


class Lines:
    """Distinct words (hashes, ascending) of every line of some texts."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, lines=True)
        self.data, self.offsets = words.data, words.offsets
        n = np.diff(words.bounds)
        owner = np.repeat(np.arange(len(n)), n)
        order = _ordered(words.hashes, owner)
        owner, tokens = owner[order], words.hashes[order]
        fresh = np.ones(len(owner), dtype=bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])
        self.owner, self.tokens = owner[fresh], tokens[fresh]
        self.starts = np.searchsorted(self.owner, np.arange(len(n) + 1))
        self.sizes = np.diff(self.starts)
        firsts = words.line_of
        self.text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        self.number = np.arange(len(n)) - firsts[:-1][self.text] if len(n) else np.zeros(0, np.int64)

    def keys(self) -> np.ndarray:
        """128 bits for each line's set."""
        out = np.empty(len(self.sizes), dtype=[("a", np.uint64), ("b", np.uint64)])
        for name, salt in (("a", 0x452821E638D01377), ("b", 0xBE5466CF34E90C6C)):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scramble(self.tokens + np.uint64(salt)))])
            out[name] = sums[self.starts[1:]] - sums[self.starts[:-1]]
        return out

    def tallies(self) -> np.ndarray:
        """How many words fall into each of 32 buckets, modulo 16, in two columns of 64 bits."""
        bucket = (self.tokens >> np.uint64(59)).astype(np.int64)
        counts = np.bincount(self.owner * 32 + bucket, minlength=len(self.sizes) * 32).reshape(-1, 2, 16) % 16
        return (counts.astype(np.uint64) << (4 * np.arange(16, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)

    def parities(self, some: np.ndarray, longs: int | None = None) -> pa.Array:
        """Whether an odd number of a set's words falls into each of its buckets, for some lines (ascending).

        The buckets are a power of two, 128 at least and no fewer than the set has words; sets of up to ``FINE``
        words have ``APART`` for each, where hardly two words fall together. Half as many come from the first
        half by exclusive or with the second, so sets with unlike numbers of buckets compare.
        """
        size = self.sizes[some]
        if longs is None:
            buckets = np.maximum(np.maximum(size, APART * np.minimum(size, FINE)), 1)
            longs = 1 << np.maximum(np.ceil(np.log2(buckets / 64)).astype(np.int64), 1)
        longs = np.broadcast_to(longs, len(some))
        offsets = np.concatenate([[0], np.cumsum(longs)])
        owner = np.repeat(np.arange(len(some)), size)
        at = np.repeat(self.starts[some] - np.cumsum(size) + size, size) + np.arange(len(owner))
        other = scramble(self.tokens[at] ^ np.uint64(0x13198A2E03707344))
        bucket = (other & (longs[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)
        flat = np.zeros(int(offsets[-1]), dtype=np.uint64)
        np.bitwise_xor.at(flat, offsets[owner] + (bucket >> 6), np.uint64(1) << (bucket & 63).astype(np.uint64))
        return pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(8 * offsets), pa.py_buffer(flat)])

    def wide(self) -> list[np.ndarray]:
        """128 parities of every set, as two columns."""
        raw = b"".join(self.parities(np.arange(len(self.sizes)), 2).to_pylist())
        return list(np.frombuffer(raw, np.uint64).reshape(-1, 2).T)


class Parities:
    """What ``Lines.parities`` gave for some rows."""

    def __init__(self, raw: np.ndarray):
        self.longs = np.array([len(r) >> 3 for r in raw], dtype=np.int64)
        self.starts = np.cumsum(self.longs) - self.longs
        self.flat = np.frombuffer(b"".join(raw), np.uint64)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _as(self, longs: int) -> tuple[np.ndarray, np.ndarray]:
        """The parities of all rows with that many longs or twice as many, brought to that many; and the place of each row."""
        if longs not in self.known:
            place, parts, at = np.full(len(self.longs), -1), [], 0
            for have in (longs, 2 * longs):
                rows = np.flatnonzero(self.longs == have)
                place[rows] = at + np.arange(len(rows))
                part = self.flat[self.starts[rows][:, None] + np.arange(have)]
                parts.append(part if have == longs else part[:, :longs] ^ part[:, longs:])
                at += len(rows)
            self.known[longs] = np.concatenate(parts), place
        return self.known[longs]

    def gap(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """By how many words the sets of rows x and y differ at least."""
        out = np.zeros(len(x), dtype=np.int64)
        low, high = np.minimum(self.longs[x], self.longs[y]), np.maximum(self.longs[x], self.longs[y])
        for longs in np.unique(low).tolist():
            # sizes within reach of each other have at most twice as many buckets; of others nothing is said
            some = np.flatnonzero((low == longs) & (high <= 2 * longs))
            bits, place = self._as(longs)
            out[some] = np.bitwise_count(bits[place[x[some]]] ^ bits[place[y[some]]]).sum(axis=1, dtype=np.int64)
        return out


def tally_gap(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """By how many words sets with these tallies differ at least."""
    # sixteen counts at a time: differences modulo 16, then the shorter way round, then their sum
    top, pairs = np.uint64(0x8888888888888888), np.uint64(0x0F0F0F0F0F0F0F0F)
    gap = ((x | top) - (y & ~top)) ^ ((x ^ ~y) & top)
    back = (gap & top) >> np.uint64(3)
    gap = (gap ^ (back * np.uint64(15))) + back
    gap = (gap & pairs) + ((gap >> np.uint64(4)) & pairs)
    return ((gap * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


_SURVEY = f"id long, version long, n_lines int, {rarity.COUNTS}"


def _survey(batches):
    """Per document its number of lines with a word; at the end of the task, the counts of its words."""
    counter = rarity.Counter()
    names = [c.split()[0] for c in _SURVEY.split(", ")]
    for batch in batches:
        for block in blocks(batch):
            # words are counted as often as they occur: any order that all tasks share will do
            words = Words(block.column("text"), lines=True)
            counter.add(words.hashes)
            full = np.concatenate([[0], np.cumsum(np.diff(words.bounds) > 0)])
            n = np.diff(full[words.line_of]).astype(np.int32)
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("version"), pa.array(n), *none], names=names
            )
    numbers, raw = zip(*counter.rows(), strict=True)
    none = [pa.nulls(len(raw), k) for k in (pa.int64(), pa.int64(), pa.int32())]
    yield pa.RecordBatch.from_arrays([*none, pa.array(numbers, pa.int32()), pa.array(raw, pa.binary())], names=names)


#: word: rank of a shared word; size and place: of the line's set, of the word in it; tally and version: both
#: tallies of the set. Other rows have the version of the line's document there. Size 0: a line that
#: repeats an earlier one of its batch, which stands in ``tally`` (document) and ``place`` (line). Size -2: a
#: line by the 128-bit key of its set, in ``word`` and ``tally``.
_ROWS = "word long, id long, line int, size int, place int, tally long, version long"
_AGAIN = f"{_ROWS}, {WIDE} binary"


def banded(words: np.ndarray, sizes: np.ndarray, step: int = 0) -> np.ndarray:
    """Words with the band of five per cent in which a size lies, or with one that many steps on."""
    band = np.floor(np.log(np.maximum(sizes, 1)) / np.log(1.05)).astype(np.int64)
    return mix(words, (band + step).view(np.uint64))


def reached(batches, share: int):
    """Words (``word``, ``size``) with every band in which a set similar to one of that size can lie."""
    reach = int(np.log(100 / share) / np.log(1.05)) + 1
    for batch in batches:
        words, sizes = batch.column("word").to_numpy().view(np.uint64), batch.column("size").to_numpy()
        for step in range(-reach, reach + 1):
            yield pa.RecordBatch.from_arrays([pa.array(banded(words, sizes, step).view(np.int64))], names=["word"])


class Marks:
    """A Bloom filter of words in a fixed number of bits, whatever the number of words: none of them is ever missed."""

    BITS, SLICES = 25, 16

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(1 << (self.BITS - 3), np.uint8) if bits is None else bits

    def __reduce__(self):
        """Travels to tasks compressed: with few words in it, it takes a few KB there and not 4 MB a stage."""
        return _unpacked, (zlib.compress(self.bits.tobytes(), 1),)

    def _places(self, words: np.ndarray):
        for salt in (0xA4093822299F31D0, 0x082EFA98EC4E6C89):
            yield (scramble(words ^ np.uint64(salt)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def add(self, words: np.ndarray) -> None:
        for place in self._places(words):
            np.bitwise_or.at(self.bits, place >> 3, (1 << (place & 7)).astype(np.uint8))

    def has(self, words: np.ndarray) -> np.ndarray:
        out = np.ones(len(words), dtype=bool)
        for place in self._places(words):
            out &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return out

    @classmethod
    def of(cls, words: DataFrame, rows=iter) -> Marks:
        """The filter of a column ``word`` of what ``rows`` makes of the batches: tasks mark their own words, executors bring slices together."""
        names, size = ["slice", "bits"], 1 << (cls.BITS - 3)

        def task(batches):
            own = cls()
            for batch in rows(batches):
                own.add(batch.column("word").to_numpy().view(np.uint64))
            for number, part in enumerate(np.split(own.bits, cls.SLICES)):
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], names=names)

        def joined(rows: pa.Table) -> pa.Table:
            whole = np.zeros(size // cls.SLICES, np.uint8)
            for raw in rows.column("bits"):
                whole |= np.frombuffer(zlib.decompress(raw.as_py()), np.uint8)
            return pa.table({"slice": rows.column("slice").slice(0, 1), "bits": pa.array([zlib.compress(whole.tobytes(), 1)])})

        marked = words.mapInArrow(released(task), "slice int, bits binary").groupBy("slice").applyInArrow(joined, "slice int, bits binary")
        out = np.zeros((cls.SLICES, size // cls.SLICES), np.uint8)
        for number, raw in marked.collect():
            out[number] = np.frombuffer(zlib.decompress(raw), np.uint8)
        return cls(out.reshape(-1))


def _unpacked(raw: bytes) -> Marks:
    return Marks(np.frombuffer(zlib.decompress(raw), np.uint8))


def _rows(share: int, steps: np.ndarray, marks: Marks | None = None):
    """Rows of shared words; with ``marks`` only those of marked words, wider and without certain repeats."""

    def step(batch: pa.RecordBatch):
        for block in blocks(batch):
            out = []
            lines = Lines(block.column("text"))
            ids, versions = block.column("id").to_numpy(), block.column("version").to_numpy()
            full = np.flatnonzero(lines.sizes > 0)
            doc = ids[lines.text]
            # the earliest line of each set goes on; others repeat it
            order = full[np.lexsort((lines.number[full], doc[full]))]
            keys = lines.keys()
            _, first, group = np.unique(keys[order], return_index=True, return_inverse=True)
            earliest = order[first][group]
            again = (doc[earliest] != doc[order]) | (lines.number[earliest] != lines.number[order])
            repeat, of = order[again], earliest[again]
            if marks is None:
                out.append(
                    (
                        scramble(keys["a"][repeat]).view(np.int64),
                        doc[repeat],
                        lines.number[repeat].astype(np.int32),
                        np.zeros(len(repeat), np.int32),
                        lines.number[of].astype(np.int32),
                        doc[of],
                        versions[lines.text[repeat]],
                    )
                )
            new = np.zeros(len(lines.sizes), dtype=bool)
            new[order[first]] = True
            if marks is None:
                sole = order[first]
                out.append(
                    (
                        keys["a"][sole].view(np.int64),
                        doc[sole],
                        lines.number[sole].astype(np.int32),
                        np.full(len(sole), BY_KEY, np.int32),
                        np.zeros(len(sole), np.int32),
                        keys["b"][sole].view(np.int64),
                        versions[lines.text[sole]],
                    )
                )
            rank = rarity.ranked(lines.tokens, steps)
            by_rank = _ordered(rank, lines.owner)
            place = np.arange(len(rank)) - lines.starts[:-1][lines.owner]
            size = lines.sizes
            length = size - (share * size + 99) // 100 + 1
            kept = (place < length[lines.owner]) & new[lines.owner]
            if marks is not None:
                kept[kept] = marks.has(banded(rank[by_rank][kept], size[lines.owner[kept]]))
            owner = lines.owner[kept]
            tallies = lines.tallies().view(np.int64)
            some, row = np.unique(owner, return_inverse=True)
            out.append(
                (
                    rank[by_rank][kept].view(np.int64),
                    doc[owner],
                    lines.number[owner].astype(np.int32),
                    size[owner].astype(np.int32),
                    place[kept].astype(np.int32),
                    tallies[owner, 0],
                    tallies[owner, 1],
                )
            )
            columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
            if marks is not None:
                columns.append(lines.parities(some).take(pa.array(row)).cast(pa.binary()))
            del lines, out
            names = [c.split()[0] for c in (_ROWS if marks is None else _AGAIN).split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return step


#: A later line and an earlier one that may be similar; version is set where that is certain already.
_PAIRS = "id long, line int, of_id long, of_line int, version long, more boolean, word long, size int"


class _Group:
    """Rows of whole shared words, by word and then by size."""

    def __init__(self, rows: dict[str, np.ndarray], share: int, keep: int):
        self.rows, self.share, self.keep = rows, share, keep
        self.enough = max(ENOUGH, 4 * keep)
        self.wanted = rows.get("wanted")
        self.wide = Parities(rows[WIDE]) if WIDE in rows else None

    def passes(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of rows x and y of one word, close in size, that the positional and tally filters let through."""
        size, place, tally, second = (self.rows[n] for n in ("size", "place", "tally", "version"))
        a, b, i, j = size[x], size[y], place[x], place[y]
        room = np.minimum(i, j) + np.minimum(a - i, b - j)
        ok = (100 + self.share) * room >= self.share * (a + b)
        x, y, both = x[ok], y[ok], (a + b)[ok]
        gap = tally_gap(tally[x], tally[y])
        ok = (100 + self.share) * (both - gap) >= 2 * self.share * both
        x, y, both, gap = x[ok], y[ok], both[ok], gap[ok]
        ok = (100 + self.share) * (both - gap - tally_gap(second[x], second[y])) >= 2 * self.share * both
        x, y, both = x[ok], y[ok], both[ok]
        if self.wide is not None:
            ok = (100 + self.share) * (both - self.wide.gap(x, y)) >= 2 * self.share * both
            x, y = x[ok], y[ok]
        return x, y

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Earlier row, later row, and whether the later one has more candidates than are given.

        Rows of one word come by size. Row by row is compared at growing distances, within the reach of its size,
        and only for rows that still look for earlier lines, so lines of one template by the hundred thousand
        cost as many steps and not their square.
        """
        word, size = self.rows["word"], self.rows["size"].astype(np.int64)
        n = len(word)
        i, line = self.rows["id"], self.rows["line"]
        group = np.cumsum(np.concatenate([[False], word[1:] != word[:-1]])[:n]) if n else np.zeros(0, np.int64)
        base = int(size.max(initial=0)) + 2
        key = group * base + size
        low = np.searchsorted(key, group * base + (self.share * size + 99) // 100)
        high = np.searchsorted(key, group * base + np.minimum(100 * size // self.share, base - 1), side="right")
        # rows by document and line; rows of one line have one turn
        order = np.lexsort((line, i))
        new = np.ones(n, dtype=bool)
        new[1:] = (i[order][1:] != i[order][:-1]) | (line[order][1:] != line[order][:-1])
        turn = np.empty(n, dtype=np.int64)
        turn[order] = np.cumsum(new) - 1
        row_of = order[new]
        live = np.arange(n) if self.wanted is None else np.flatnonzero(self.wanted)
        step = max(1, HELD // (self.enough if self.keep > 1 else 1))
        out = [self._earliest(live[k : k + step], low, high, turn) for k in range(0, len(live), step)]
        if not out:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, bool)
        first, y, more = (np.concatenate(c) for c in zip(*out, strict=True))
        return row_of[first], y, more

    def _earliest(self, asking: np.ndarray, low: np.ndarray, high: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The turns of the first ``keep`` candidates of some rows, these rows, and whether they have more candidates."""
        found, have, live = [], np.zeros(len(turn), dtype=np.int64), asking
        best = np.full(len(turn), len(turn))
        for lag in range(1, len(turn)):
            live = live[(live - lag >= low[live]) | (live + lag < high[live])]
            live = live[have[live] < self.enough]
            if not len(live):
                break
            left, right = live[live - lag >= low[live]], live[live + lag < high[live]]
            x, y = np.concatenate([left - lag, right + lag]), np.concatenate([left, right])
            earlier = turn[x] < turn[y]
            x, y = self.passes(x[earlier], y[earlier])
            if not len(x):
                continue
            np.add.at(have, y, 1)
            if self.keep > 1:
                found.append((turn[x], y))
            else:  # nothing is held but the earliest
                np.minimum.at(best, y, turn[x])
        if self.keep == 1:
            y = asking[have[asking] > 0]
            return best[y], y, have[y] > 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        x, y = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((x, y))
        x, y = x[order], y[order]
        new = np.flatnonzero(np.concatenate([[True], y[1:] != y[:-1]]))
        count = np.diff(np.append(new, len(y)))
        first = np.arange(len(y)) - np.repeat(new, count) < self.keep
        return x[first], y[first], np.repeat(count > self.keep, count)[first]


#: Size of a row that says for which line a word's candidates are wanted, and of one that stands for a whole set.
WANTED, BY_KEY = -1, -2


def _copies(rows: dict[str, np.ndarray]) -> pa.RecordBatch | None:
    """Lines with the set of an earlier one, from rows that stand for whole sets."""
    order = np.lexsort((rows["line"], rows["id"], rows["tally"], rows["word"]))
    rows = {k: v[order] for k, v in rows.items()}
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rows["word"][1:] != rows["word"][:-1]) | (rows["tally"][1:] != rows["tally"][:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    again = np.flatnonzero((rows["id"] != rows["id"][lead]) | (rows["line"] != rows["line"][lead]))
    if not len(again):
        return None
    of = lead[again]
    return _pair_batch(rows["id"][again], rows["line"][again], rows["id"][of], rows["line"][of], rows["version"][again])


def _wanted(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The rows of words for which some line is wanted, with ``wanted`` for these lines.

    Lines are compared by a hash; a line that is taken for wanted by chance only gets more candidates verified.
    """
    def keys(at: np.ndarray) -> np.ndarray:
        parts = [rows[n][at].astype(np.int64).view(np.uint64) for n in ("word", "id", "line")]
        return mix(mix(parts[0], parts[1]), parts[2])

    mark = rows["size"] == WANTED
    near = np.flatnonzero(~mark & np.isin(rows["word"], rows["word"][mark]))
    out = {k: v[near] for k, v in rows.items()}
    out["wanted"] = np.isin(keys(near), keys(np.flatnonzero(mark)))
    return out


def _pairs(batches, share: int, keep: int):
    """Candidates from rows that come sorted by word and size; a word may span batches.

    Where rows are wider, candidates of the lines that rows of size ``WANTED`` name. A line gets ``keep`` candidates
    at a word, and ``more`` is set if it has others there.
    """
    names = []
    held: list[dict[str, np.ndarray]] = []

    def done(rows: dict[str, np.ndarray]):
        rows = _wanted(rows) if WIDE in rows else rows
        whole = rows["size"] == BY_KEY
        if whole.any():
            copies = _copies({k: v[whole] for k, v in rows.items()})
            if copies is not None:
                yield copies
            rows = {k: v[~whole] for k, v in rows.items()}
        sure = rows["size"] == 0
        if sure.any():
            yield _pair_batch(
                rows["id"][sure], rows["line"][sure], rows["tally"][sure], rows["place"][sure], rows["version"][sure]
            )
        rest = {k: v[~sure] for k, v in rows.items()}
        rest |= {n: rest[n].view(np.uint64) for n in ("tally", "version")}
        x, y, more = _Group(rest, share, keep).pairs()
        if len(x):
            yield _pair_batch(rest["id"][y], rest["line"][y], rest["id"][x], rest["line"][x], None, more, rest["word"][y], rest["size"][y])

    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        word = rows["word"]
        if held and held[0]["word"][0] == word[-1]:
            held.append(rows)
            continue
        end = int(np.searchsorted(word, word[-1], side="left"))
        held.append({k: v[:end] for k, v in rows.items()})
        yield from done({k: np.concatenate([h[k] for h in held]) for k in names})
        held = [{k: v[end:] for k, v in rows.items()}]
    if held:
        yield from done({k: np.concatenate([h[k] for h in held]) for k in names})


def _pair_batch(i, line, of_id, of_line, version, more=None, word=None, size=None) -> pa.RecordBatch:
    n = len(i)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(i),
            pa.array(line),
            pa.array(of_id),
            pa.array(of_line),
            pa.nulls(n, pa.int64()) if version is None else pa.array(version),
            pa.array(np.zeros(n, bool) if more is None else more),
            pa.nulls(n, pa.int64()) if word is None else pa.array(word),
            pa.nulls(n, pa.int32()) if size is None else pa.array(size),
        ],
        names=[c.split()[0] for c in _PAIRS.split(", ")],
    )


_SETS = "g_id long, g_line int, deal long, late boolean, id long, line int, version long, words binary"


def _asked():
    """The lines asked for, one for each comparison that a line takes part in (a text is shorter than its words' hashes)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for block in expanded(batch):
            lines = Lines(block.column("text"))
            asked = block.column("asked")
            owner = np.repeat(np.arange(block.num_rows), np.diff(np.asarray(asked.offsets)))
            fields = asked.flatten()
            numbers = fields.field("line").to_numpy()
            first = np.searchsorted(lines.text, np.arange(block.num_rows + 1))
            there = np.flatnonzero(numbers < np.diff(first)[owner])
            owner, numbers = owner[there], numbers[there]
            at = first[owner] + numbers
            edges = zip(lines.offsets[at].tolist(), lines.offsets[at + 1].tolist(), strict=True)
            raw = [lines.data[s:e].tobytes().removesuffix(b"\n") for s, e in edges]
            picked = {n: fields.field(n).take(pa.array(there)) for n in ("g_id", "g_line", "deal", "late")}
            own = {n: block.column(n).take(pa.array(owner)) for n in ("id", "version")}
            columns = {**picked, **own, "line": pa.array(numbers), "words": pa.array(raw, pa.binary())}
            names = [c.split()[0] for c in _SETS.split(", ")]
            out.append(pa.RecordBatch.from_arrays([columns[n] for n in names], names=names))
        return pa.concat_batches(out)

    return step


def _alike(batches, share: int):
    """Later lines that are similar to the earlier one of their comparison, which comes before them."""
    key, early = None, []
    for batch in (block for b in batches if b.num_rows for block in blocks(b, "words")):
        found = []
        lines = Lines(batch.column("words").cast(pa.large_string()))
        columns = [batch.column(n).to_pylist() for n in ("g_id", "g_line", "deal", "late", "id", "line", "version")]
        for k, (g_id, g_line, deal, late, i, line, version) in enumerate(zip(*columns, strict=True)):
            if key != (g_id, g_line, deal):
                key, early = (g_id, g_line, deal), []
            own = lines.tokens[lines.starts[k] : lines.starts[k + 1]]
            if not late:
                early.append(own)
                continue
            for other in early:
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= share * (len(own) + len(other) - both):
                    found.append((i, line, version, g_id, g_line))
                    break
        if found:
            columns = zip(zip(*found, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=["id", "line", "version", "of_id", "of_line"])


def _texts(documents: DataFrame) -> DataFrame:
    """``id`` (NULL last of all), ``version`` (tells rows of one id apart) and ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("version"), text.alias("text")
    )


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("word").sortWithinPartitions("word", "size", "id", "line")


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """Computes rows once into the shared folder; small files are read together, so few rows make few tasks."""
    folder = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4()}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _verified(texts: DataFrame, pairs: DataFrame, share: int) -> DataFrame:
    """The pairs whose sets are similar enough, with the version of the later line's document.

    Every line's set goes to the comparisons that it takes part in: the earlier line first, then all later
    ones; an earlier line with very many later ones has several comparisons. Texts without such a line stay.
    """
    marks = Marks.of(pairs.select(F.explode(F.array("id", "of_id")).alias("word")))

    def named(batch: pa.RecordBatch) -> np.ndarray:
        return marks.has(batch.column("id").to_numpy().view(np.uint64))

    per = pairs.groupBy("of_id", "of_line").agg(F.ceil(F.count(F.lit(1)) / HOT).alias("deals"))
    dealt = pairs.join(per, ["of_id", "of_line"]).withColumn("deal", F.pmod(F.xxhash64("id", "line"), F.col("deals")))
    group = [F.col("of_id").alias("g_id"), F.col("of_line").alias("g_line")]
    late = dealt.select("id", F.struct("line", *group, "deal", F.lit(True).alias("late")).alias("one"))
    early = per.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1))).select(
        F.col("of_id").alias("id"),
        F.struct(F.col("of_line").alias("line"), *group, "deal", F.lit(False).alias("late")).alias("one"),
    )
    asked = late.union(early).groupBy(F.col("id").alias("a_id")).agg(F.collect_set("one").alias("asked"))
    whole = squeezed(texts, "id", "version", some=named).join(asked, F.col("id") == F.col("a_id"))
    sets = map_arrow(whole.select("id", "version", "text", "asked"), _asked, _SETS)
    ordered = sets.repartition("g_id", "g_line", "deal").sortWithinPartitions("g_id", "g_line", "deal", "late")
    return ordered.mapInArrow(released(partial(_alike, share=share)), "id long, line int, version long, of_id long, of_line int")


def repeated_lines(documents: DataFrame, share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """Lines to remove, and all documents with their number of lines.

    The first table has ``id, line, version, of_id, of_line``: a line (from 0) of a document and the earliest
    line found that it repeats. The second has ``id, version, n_lines`` (lines with a word). A document without
    id comes last and has the largest long as ``id``; ``version`` is a hash of the text.
    """
    spark = documents.sparkSession
    ship(spark)
    texts = _texts(documents)
    survey = cut(texts.mapInArrow(released(_survey), _SURVEY))
    steps = rarity.levels(rarity.summed(survey.where("slice is not null").select("slice", "counts")))
    light = survey.where("slice is null").select("id", "version", "n_lines")
    rows = map_arrow(texts, partial(_rows, share, steps), _ROWS)
    pairs = _stored(_sorted(rows).mapInArrow(released(partial(_pairs, share=share, keep=EARLIEST)), _PAIRS), "pairs")
    sure = pairs.where("version is not null").select("id", "line", "version", "of_id", "of_line")
    # lines with the very set of an earlier one need no comparison
    known = sure.select("id", "line").distinct()
    open_ = pairs.where("version is null").select("id", "line", "of_id", "of_line").distinct().join(known, ["id", "line"], "left_anti")
    found = sure.union(_stored(_verified(texts, _stored(open_, "open"), share), "found"))
    keep, sent = KEPT, None
    while True:
        # lines whose candidates all failed, but which had more
        failed = pairs.where("more").join(found.select("id", "line"), ["id", "line"], "left_anti")
        failed = _stored(failed.select("id", "line", "word", "size").distinct(), "lines")
        if failed.first() is None:
            break
        # only rows of their words and sizes are sent again, told apart before anything is sent; at its other
        # words such a line has been compared with all that it has there
        if sent is None:
            words = Marks.of(failed.select("word", "size").distinct(), partial(reached, share=share))
            sent = _stored(map_arrow(texts, partial(_rows, share, steps, words), _AGAIN), "rows")
        # lines that fail once more have done so at the same words: the texts are read no further time
        again = sent.join(failed.select("word").distinct(), "word", "left_semi")
        none = F.lit(0)
        rest = [none.cast("long").alias(name) for name in ("tally", "version")] + [F.lit(b"").alias(WIDE)]
        asked = failed.select("word", "id", "line", F.lit(WANTED).alias("size"), none.alias("place"), *rest)
        pairs = _stored(_sorted(again.unionByName(asked)).mapInArrow(released(partial(_pairs, share=share, keep=keep)), _PAIRS), "pairs")
        near = _verified(texts, pairs.select("id", "line", "of_id", "of_line"), share)
        found = found.union(_stored(near, "found"))
        keep *= MORE
    early = F.min(F.struct("of_id", "of_line"))
    removed = found.groupBy("id", "line", "version").agg(early.alias("of"))
    return removed.select("id", "line", "version", F.col("of.of_id").alias("of_id"), F.col("of.of_line").alias("of_line")), light


def report(documents: DataFrame, share: int = SHARE) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed, repeats``, one row per row of ``documents`` (``doc_id``, ``text``).

    ``removed`` has the removed lines (numbers from 0, ascending), ``repeats`` the ids of the documents whose
    lines they repeat (ascending, each once). Lines are split at newlines; a line without a word never counts
    and never goes. Order is by ``doc_id``, then line; NULL ids come last, NULL text has no lines, repeated rows
    get equal results and do not remove each other's lines, no rows give an empty result.
    """
    removed, light = repeated_lines(documents, share)
    gone = removed.groupBy("id", "version").agg(
        F.array_sort(F.collect_set("line")).alias("removed"),
        F.array_sort(F.array_distinct(F.collect_list("of_id"))).alias("repeats"),
    )
    both = light.join(gone, ["id", "version"], "left")
    none = F.array().cast("array<long>")
    repeats = F.transform(F.coalesce("repeats", none), lambda i: F.when(i != _LAST, i))
    return both.select(
        F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        repeats.alias("repeats"),
    )


def drop_repeated_lines(documents: DataFrame, share: int = SHARE) -> DataFrame:
    """``documents`` without the lines that repeat an earlier one; columns unchanged, ``n_chars`` brought up to date.

    A document that had lines and has none left goes.
    """
    columns = documents.columns
    removed, _ = repeated_lines(documents, share)
    gone = removed.groupBy(F.col("id").alias(f"{OWN}id"), F.col("version").alias(f"{OWN}version")).agg(
        F.collect_set("line").alias(f"{OWN}gone")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = documents.join(
        gone,
        (F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)) == F.col(f"{OWN}id"))
        & (F.xxhash64(text) == F.col(f"{OWN}version")),
        "left",
    )
    left = F.array_join(
        F.filter(F.split(F.col("text"), "\n"), lambda line, i: ~F.array_contains(F.col(f"{OWN}gone"), i)), "\n"
    )
    fresh = F.when(F.col(f"{OWN}gone").isNull(), F.col("text")).otherwise(left)
    out = both.withColumn(f"{OWN}text", fresh).where(
        F.col(f"{OWN}gone").isNull() | F.col(f"{OWN}text").rlike("[^ \\t\\n\\x0B\\f\\r]")
    )
    new = {"text": F.col(f"{OWN}text"), "n_chars": F.length(f"{OWN}text").cast("long")}
    changed = {c: F.when(F.col(f"{OWN}gone").isNull(), F.col(f"`{c}`")).otherwise(v) for c, v in new.items()}
    return out.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in columns])
