"""Removal of byte strings that occur earlier: a suffix sort with comparisons by prefix hashes.

Of all starts of strings of ``length`` bytes, those that may be repeated are found first. Every such string
has an anchor, the piece of it (two fifths long) whose hash is smallest, the leftmost of equals; so equal
strings have equal anchors at equal places. An anchor owns a run of neighbouring strings. Anchors are brought
together by hash. Where the bytes of all owned strings are equal too (a second hash over them), all
but the earliest are repeats; within a block of texts that is decided before anything is sent. An anchor that
stands alone is done. Only where one anchor has several surroundings, their bytes are fetched and the suffixes
that begin at its owned strings are sorted, those at one distance from the anchor together.

The sort is a mergesort whose comparisons find the common extension of two suffixes by binary search over
polynomial prefix hashes, so in a logarithmic number of steps. Neighbours that agree for ``length`` bytes are
equal strings; their bytes are compared, and a class with a collision is sorted by its bytes. The sort
is stable over (document, place), so the first of equal strings is the earliest.

An anchor with more surroundings than ``HOT`` (the border of a passage that very many documents hold) is not
sorted in one task: each of its strings goes on as a row of its own, equal ones of a block once, and Spark's sort
brings equal ones together, to be compared neighbour by neighbour.

Surroundings are called equal by two 64-bit hashes together (of the anchor and of the owned bytes).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import _bytes, blocks, cut, expanded, map_arrow, mix, scramble, ship, squeezed

#: Bytes of a string that counts as a repeat.
LENGTH = 100
#: Surroundings of one anchor that are sorted in one task; beyond, strings are dealt one by one.
HOT = 1 << 14
#: Bytes in which a task works at a time, and suffixes that are sorted at a time.
CHUNK = 1 << 20
SUFFIXES = 1 << 19

_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 1 << 64)
_LAST = (1 << 63) - 1
_NONE = np.uint64((1 << 64) - 1)


class Hashes:
    """Polynomial hashes (modulo 2^64, over scrambled bytes) of any part of ``data``."""

    def __init__(self, data: np.ndarray, salt: int = 1):
        n = len(data)
        ups, self.downs = np.full(n + 1, _STEP, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        ups[0] = self.downs[0] = 1
        np.multiply.accumulate(ups, out=ups)
        np.multiply.accumulate(self.downs, out=self.downs)
        table = scramble(np.arange(256, dtype=np.uint64) + np.uint64(salt << 8))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * ups[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.downs[starts]


def piece(length: int) -> int:
    """Bytes of an anchor."""
    return max(1, 2 * length // 5)


#: place: start of the anchor, bytes before it and number of owned strings, in 12 bits
def _place(at: np.ndarray, left: np.ndarray, owned: np.ndarray, bits: int) -> np.ndarray:
    return (at << (2 * bits)) | (left << bits) | owned


def _unplaced(place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mask = (1 << bits) - 1
    return place >> (2 * bits), (place >> bits) & mask, place & mask


def _bits(length: int) -> int:
    return (length - piece(length) + 1).bit_length()


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring keys."""
    out, have = keys, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, edges: np.ndarray, length: int):
    """Chunks of (document, start of the anchor in it, bytes before, owned strings, hash, hash of the owned bytes).

    ``edges`` has the start of each document in ``data``, and its end. A run of owned strings that a chunk's
    border cuts gives two rows with separate strings.
    """
    size, reach = piece(length), length - piece(length) + 1
    for first in range(0, max(len(data) - length + 1, 0), CHUNK):
        stop = min(first + CHUNK, len(data) - length + 1)  # strings that begin here
        low, high = first, stop + length - 1
        part = Hashes(data[low:high])
        n = high - low
        starts = np.arange(n - size + 1)
        grams = scramble(part.of(starts, starts + size))
        # the leftmost of the least: 40 bits of the hash, then the place
        keys = (grams >> np.uint64(24) << np.uint64(24)) | starts.astype(np.uint64)
        least = _least(keys, reach)[: stop - first]
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        begin = np.arange(stop - first)
        doc = np.searchsorted(edges, begin + low, side="right") - 1
        whole = begin + low + length <= edges[doc + 1]
        begin, at, doc = begin[whole], at[whole], doc[whole]
        if not len(begin):
            continue
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
        owned = np.diff(np.append(new, len(begin)))
        begin, at, doc = begin[new], at[new], doc[new]
        inside = scramble(part.of(begin, begin + owned - 1 + length))
        left = at - begin
        shape = (left * reach + owned).astype(np.uint64)
        yield doc, at + low - edges[doc], left, owned, grams[at], mix(inside, shape)


_ROWS = "hash long, around long, id long, version long, place long"
#: Spans to remove, and (with a hash) places whose bytes are asked for.
_FOUND = "id long, version long, start long, stop long, hash long, place long"


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=[c.split()[0] for c in schema.split(", ")])


def _spans(ids, versions, start, stop) -> pa.RecordBatch:
    none = pa.nulls(len(ids), pa.int64())
    return _batch(_FOUND, [ids, versions, start, stop, none, none])


def _anchored(batches, length: int):
    """Rows of anchors; of equal surroundings in one block all but the earliest become spans at once."""
    bits = _bits(length)
    for batch in batches:
        for block in blocks(batch):
            data, edges = _bytes(block.column("text"))
            ids, versions = block.column("id").to_numpy(), block.column("version").to_numpy()
            for doc, at, left, owned, grams, around in anchors(data, edges, length):
                place = _place(at, left, owned, bits)
                i, v = ids[doc], versions[doc]
                order = np.lexsort((place, v, i, around, grams))
                i, v, place, grams, around, at, left, owned = (a[order] for a in (i, v, place, grams, around, at, left, owned))
                same = np.concatenate([[False], (grams[1:] == grams[:-1]) & (around[1:] == around[:-1])])
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
                again = same & ((i != i[lead]) | (v != v[lead]) | (place != place[lead]))
                keep = ~same
                none = pa.nulls(int(keep.sum()), pa.int64())
                yield _batch(
                    _ROWS + ", start long, stop long",
                    [grams[keep].view(np.int64), around[keep].view(np.int64), i[keep], v[keep], place[keep], none, none],
                )
                if again.any():
                    none = pa.nulls(int(again.sum()), pa.int64())
                    start = (at - left)[again]
                    yield _batch(
                        _ROWS + ", start long, stop long",
                        [none, none, i[again], v[again], none, start, start + owned[again] - 1 + length],
                    )


def _collapsed(batches, length: int):
    """From anchors by hash, surroundings and document order: spans of repeats, places to be sorted.

    Holds two rows between batches: the first one of the hash, while it is the only surroundings of it, and the
    first one of the surroundings.
    """
    bits = _bits(length)
    names = ("hash", "around", "id", "version", "place")
    lead: dict | None = None  # first row of the surroundings that were read last
    alone = False  # whether these are the only ones of their hash so far
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = {k: batch.column(k).to_numpy() for k in names}
        if lead is not None:
            rows = {k: np.concatenate([lead[k], rows[k]]) for k in names}
        n = len(rows["hash"])
        new_hash = np.concatenate([[True], rows["hash"][1:] != rows["hash"][:-1]])
        new = new_hash | np.concatenate([[True], rows["around"][1:] != rows["around"][:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        place = rows["place"]
        repeat = ~new & ((rows["id"] != rows["id"][first]) | (rows["version"] != rows["version"][first]) | (place != place[first]))
        at, left, owned = _unplaced(place[repeat], bits)
        if repeat.any():
            start = at - left
            yield _spans(rows["id"][repeat], rows["version"][repeat], start, start + owned - 1 + length)
        # surroundings that are not the only ones of their hash
        heads = np.flatnonzero(new)
        opens = ~new_hash[heads]
        ask = opens.copy()
        followed = np.append(opens[1:], False)
        ask |= followed
        if lead is not None:
            if not alone:  # asked for already
                ask[0] = False
        asked = heads[ask]
        if len(asked):
            none = pa.nulls(len(asked), pa.int64())
            yield _batch(_FOUND, [rows["id"][asked], rows["version"][asked], none, none, rows["hash"][asked], place[asked]])
        last = heads[-1]
        was_alone = bool(new_hash[last])
        if len(heads) == 1 and lead is not None:
            was_alone = alone
        alone = was_alone
        lead = {k: rows[k][last : last + 1] for k in names}


_PIECES = "hash long, id long, version long, place long, bytes binary"


def _fetched(length: int):
    """The bytes of all owned strings of each place asked for; of a hot anchor, each string for itself."""
    bits = _bits(length)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for block in expanded(batch):
            data, edges = _bytes(block.column("text"))
            asked = block.column("asked")
            counts = np.diff(np.asarray(asked.offsets))
            owner = np.repeat(np.arange(block.num_rows), counts)
            fields = asked.flatten()
            hashes, place, hot = (fields.field(n).to_numpy(zero_copy_only=False) for n in ("hash", "place", "hot"))
            at, left, owned = _unplaced(place, bits)
            start = at - left
            ids, versions = block.column("id").to_numpy()[owner], block.column("version").to_numpy()[owner]
            base = edges[:-1][owner] + start
            cold = np.flatnonzero(~hot)
            raw = [data[b : b + k - 1 + length].tobytes() for b, k in zip(base[cold].tolist(), owned[cold].tolist(), strict=True)]
            out.append(_batch(_PIECES, [hashes[cold], ids[cold], versions[cold], place[cold], pa.array(raw, pa.binary())]))
            warm = np.flatnonzero(hot)
            if len(warm):
                # place is NULL-like (-1 - start): the string stands for itself
                seen, rows = {}, []
                for k in warm.tolist():
                    for j in range(int(owned[k])):
                        string = data[base[k] + j : base[k] + j + length].tobytes()
                        rows.append((int(hashes[k]), int(ids[k]), int(versions[k]), -1 - int(start[k] + j), string))
                rows.sort(key=lambda r: (r[1], r[2], -r[3]))
                kept = []
                for r in rows:
                    # equal strings of one block: the earliest goes on whole, others without bytes as certain repeats
                    lead = seen.setdefault((r[0], r[4]), r[1:4])
                    if lead != r[1:4] or not kept or kept[-1][1:4] != lead:
                        kept.append((*r[:4], r[4] if lead == r[1:4] else None))
                out.append(_batch(_PIECES, [pa.array(c, t) for c, t in zip(zip(*kept, strict=True), (pa.int64(),) * 4 + (pa.binary(),), strict=True)]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if sum(b.num_rows for b in out) else None

    return step


class _Sorter:
    """Sorts suffixes of ``data`` by their first ``length`` bytes within classes, stable."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.hashes = data, length, Hashes(data, salt=3)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at x and y have in common at their start, ``length`` at most."""
        out = np.full(len(x), self.length, np.int64)
        open_ = np.flatnonzero(self.hashes.of(x, x + self.length) != self.hashes.of(y, y + self.length))
        x, y = x[open_], y[open_]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length, np.int64)
        while True:  # the answer is in [low, high)
            going = high - low > 1
            if not going.any():
                break
            half = (low + high) >> 1
            equal = self.hashes.of(x, x + half) == self.hashes.of(y, y + half)
            low, high = np.where(going & equal, half, low), np.where(going & ~equal, half, high)
        out[open_] = low
        return out

    def before(self, x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether the suffix at x comes before that at y; ``ties`` says so for equal ones."""
        same = self.common(x, y)
        stop = same == self.length
        at = np.minimum(same, self.length - 1)
        return np.where(stop, ties, self.data[x + at] < self.data[y + at])

    def sorted(self, suffixes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The suffixes, given class by class (``starts``, ``sizes``), sorted within each class by merging runs."""
        out, width = suffixes.copy(), 1
        index = np.arange(len(out))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        local, size = index - starts[owner], sizes[owner]
        while (live := np.flatnonzero(size > width)).size:
            at, total, first = local[live], size[live], starts[owner[live]]
            run = at // width
            right = run % 2 == 1
            other = np.where(right, run - 1, run + 1) * width
            other_size = np.clip(total - other, 0, width)
            # rank in the other run, by binary search
            low, high = np.zeros(len(live), np.int64), other_size.copy()
            own = out[live]
            while (open_ := np.flatnonzero(low < high)).size:
                half = (low[open_] + high[open_]) >> 1
                there = out[first[open_] + other[open_] + half]
                # elements of a left run come before equal ones of a right run
                less = self.before(there, own[open_], right[open_])
                low[open_] = np.where(less, half + 1, low[open_])
                high[open_] = np.where(less, high[open_], half)
            pair = np.where(right, other, run * width)
            merged = out.copy()
            merged[first + pair + (at - run * width) + low] = own
            out, width = merged, width * 2
        return out

    def equal_before(self, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For sorted suffixes, whether the one before has the same ``length`` bytes: hashes, then bytes.

        A class in which equal hashes hide different bytes is sorted again by its bytes, in place.
        """
        same = np.zeros(len(order), dtype=bool)
        if len(order) < 2:
            return same
        inner = np.ones(len(order), dtype=bool)
        inner[starts[sizes > 0]] = False
        k = np.flatnonzero(inner)
        k = k[self.common(order[k - 1], order[k]) == self.length]
        step = max(1, (4 << 20) // self.length)
        span, wrong = np.arange(self.length), []
        for part in (k[i : i + step] for i in range(0, len(k), step)):
            true = (self.data[order[part - 1][:, None] + span] == self.data[order[part][:, None] + span]).all(axis=1)
            same[part] = true
            wrong.extend(part[~true].tolist())
        for number in {int(np.searchsorted(starts, w, side="right")) - 1 for w in wrong}:
            s, e = starts[number], starts[number] + sizes[number]
            raw = {int(p): self.data[p : p + self.length].tobytes() for p in order[s:e]}
            again = sorted(raw, key=lambda p: (raw[p], p))
            order[s:e] = again
            same[s:e] = [False, *(raw[a] == raw[b] for a, b in zip(again[:-1], again[1:], strict=True))]
        return same


def _repeats(group: np.ndarray, place: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which strings of some surroundings, given in document order, occur earlier: (row, start, end) of spans.

    ``group`` numbers the anchors; rows of one anchor stand together.
    """
    bits = _bits(length)
    at, left, owned = _unplaced(place, bits)
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1].astype(np.int64)
    row = np.repeat(np.arange(len(place)), owned)
    j = np.arange(len(row)) - np.repeat(np.cumsum(owned) - owned, owned)
    suffix = begins[row] + j
    # a class: strings at one distance before one anchor; within it, document order
    distance = left[row] - j
    order = np.lexsort((row, distance, group[row]))
    kind = group[row][order] * (length + 1) + distance[order]
    new = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    sizes = np.diff(np.append(new, len(order)))
    several = np.repeat(sizes > 1, sizes)
    order, sizes = order[several], sizes[sizes > 1]
    starts = np.cumsum(sizes) - sizes
    sorter = _Sorter(data, length)
    ranked = sorter.sorted(suffix[order], starts, sizes)
    same = sorter.equal_before(ranked, starts, sizes)
    found = np.sort(ranked[same])
    if not len(found):
        none = np.zeros(0, np.int64)
        return none, none, none
    rows = np.searchsorted(begins, found, side="right") - 1
    start = (at - left)[rows] + (found - begins[rows])
    first = np.flatnonzero(np.concatenate([[True], (np.diff(found) != 1) | (np.diff(rows) != 0)]))
    last = np.append(first[1:], len(found)) - 1
    return rows[first], start[first], start[last] + length


def _sorted_out(batches, length: int):
    """Spans from the surroundings of whole anchors, which come together and in document order."""
    names = ("hash", "id", "version", "place")
    held: list[tuple[dict, list[bytes]]] = []

    def done(rows: dict, texts: list[bytes]):
        # a repeated row of the input asks for the same place again
        again = np.ones(len(texts), dtype=bool)
        again[:1] = False
        for k in names:
            again[1:] &= rows[k][1:] == rows[k][:-1]
        if again.any():
            rows, texts = {k: v[~again] for k, v in rows.items()}, [texts[n] for n in np.flatnonzero(~again).tolist()]
        _, _, owned = _unplaced(rows["place"], _bits(length))
        hashes = rows["hash"]
        group = np.cumsum(np.concatenate([[False], hashes[1:] != hashes[:-1]]))
        # whole anchors, as many as make up about SUFFIXES suffixes
        part = np.cumsum(owned) // SUFFIXES
        first_of = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        edges = [0, *[int(f) for f in first_of[1:][part[first_of[1:]] != part[first_of[:-1]]]], len(hashes)]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            which, start, stop = _repeats(group[s:e] - group[s], rows["place"][s:e], texts[s:e], length)
            if len(which):
                yield _spans(rows["id"][s:e][which], rows["version"][s:e][which], start, stop)

    def whole():
        return {k: np.concatenate([h[0][k] for h in held]) for k in names}, [t for h in held for t in h[1]]

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {k: batch.column(k).to_numpy() for k in names}
        texts = batch.column("bytes").to_pylist()
        hashes = rows["hash"]
        end = int(np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))[-1])
        if held and held[0][0]["hash"][0] == hashes[-1]:
            held.append((rows, texts))
            continue
        held.append(({k: v[:end] for k, v in rows.items()}, texts[:end]))
        yield from done(*whole())
        held = [({k: v[end:] for k, v in rows.items()}, texts[end:])]
    if held:
        yield from done(*whole())


def _neighbours(batches, length: int):
    """Spans of strings that follow an equal one, from strings sorted by their bytes and document order."""
    before, row = (None, None), None
    for batch in batches:
        ids, versions, starts = [], [], []
        for key, i, v, place, raw in zip(*[batch.column(c).to_pylist() for c in ("hash", "id", "version", "place", "bytes")], strict=True):
            if (key, raw) == before and (i, v, place) != row:
                ids.append(i), versions.append(v), starts.append(-1 - place)
            before, row = (key, raw), (i, v, place)
        if ids:
            start = np.array(starts, np.int64)
            yield _spans(np.array(ids, np.int64), np.array(versions, np.int64), start, start + length)


def _texts(documents: DataFrame) -> DataFrame:
    """``id`` (NULL last of all), ``version`` and ``text``; the version is 0 unless some id has two rows."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    twice = documents.groupBy(number.alias("id")).count().where("count > 1").limit(1).count()
    return documents.select(number.alias("id"), (F.xxhash64(text) if twice else F.lit(0).cast("long")).alias("version"), text.alias("text"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``id, version, start, stop`` of byte spans to remove, from rows ``id, version, text``; spans may overlap.

    Together they cover the bytes of every string of ``length`` bytes that also begins earlier, by (id,
    version, start).
    """
    spark = texts.sparkSession
    ship(spark)
    made = texts.mapInArrow(partial(_anchored, length=length), _ROWS + ", start long, stop long")
    # spans without a hash go anywhere
    key = F.coalesce("hash", F.xxhash64("id", "start"))
    ordered = made.repartition(key).sortWithinPartitions("hash", "around", "id", "version", "place")
    # spans found inside a block need no other row; NULL hashes come first and pass by
    found = cut(ordered.mapInArrow(partial(_passed, length=length), _FOUND))
    spans = found.where("hash is null").select("id", "version", "start", "stop")
    asked = found.where("hash is not null").select("hash", "id", "version", "place")
    crowds = asked.groupBy("hash").count().where(F.col("count") > hot).select("hash", F.lit(True).alias("hot"))
    marked = asked.join(crowds, "hash", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    lists = marked.groupBy(F.col("id").alias("a_id"), F.col("version").alias("a_version")).agg(
        F.collect_list(F.struct("hash", "place", "hot")).alias("asked")
    )
    whole = squeezed(texts.where(F.octet_length("text") >= length), "id", "version").join(
        lists, (F.col("id") == F.col("a_id")) & (F.col("version") == F.col("a_version"))
    )
    pieces = cut(map_arrow(whole.select("id", "version", "text", "asked"), partial(_fetched, length), _PIECES))
    cold = pieces.where("place >= 0").repartition("hash").sortWithinPartitions("hash", "id", "version", "place")
    spans = spans.union(cold.mapInArrow(partial(_sorted_out, length=length), _FOUND).select("id", "version", "start", "stop"))
    strings = pieces.where("place < 0")
    start = (-1 - F.col("place")).alias("start")
    sure = strings.where("bytes is null").select("id", "version", start, (start + length).alias("stop"))
    warm = strings.where("bytes is not null").repartition("hash", "bytes")
    warm = warm.sortWithinPartitions("hash", "bytes", "id", "version", F.desc("place"))
    near = warm.mapInArrow(partial(_neighbours, length=length), _FOUND).select("id", "version", "start", "stop")
    return spans.union(sure).union(near)


def _passed(batches, length: int):
    """Spans found inside a block as they are, then what ``_collapsed`` makes of the anchors."""

    def anchors_only():
        for batch in batches:
            sure = batch.filter(batch.column("hash").is_null())
            if sure.num_rows:
                none = pa.nulls(sure.num_rows, pa.int64())
                waiting.append(_batch(_FOUND, [*[sure.column(c) for c in ("id", "version", "start", "stop")], none, none]))
            yield batch.filter(batch.column("hash").is_valid())

    waiting: list[pa.RecordBatch] = []
    for out in _collapsed(anchors_only(), length):
        yield from waiting
        waiting.clear()
        yield out
    yield from waiting


def _kept(batches):
    """What is left of each text, and its removed spans, joined where they touch."""
    for batch in batches:
        for block in expanded(batch):
            texts, kept, spans = block.column("text").to_pylist(), [], []
            for text, found in zip(texts, block.column("found").to_pylist(), strict=True):
                raw = text.encode()
                runs: list[dict] = []
                for one in sorted(found or [], key=lambda f: f["start"]):
                    if runs and one["start"] <= runs[-1]["stop"]:
                        runs[-1]["stop"] = max(runs[-1]["stop"], one["stop"])
                    else:
                        runs.append(dict(one))
                edges = [0, *[e for r in runs for e in (r["start"], r["stop"])], len(raw)]
                kept.append(b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
                spans.append(runs)
            at = block.schema.get_field_index("found")
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("version"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(spans, block.schema.field(at).type)],
                names=["id", "version", "n_bytes", "kept", "spans"],
            )


def remove_repeats(documents: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` for each row of ``documents`` (``doc_id``, ``text``).

    ``kept`` has the bytes (UTF-8) outside every string of ``length`` bytes that also begins earlier, in a
    document of a smaller id or in the same one; ``spans`` the removed runs (``start``, ``stop`` in bytes). Strings never
    cross documents and are judged on the input. NULL text is empty; a text below ``length`` bytes keeps all; very long texts
    are worked on in chunks. A NULL id comes last of all. Rows of one id with different texts are ordered by a
    hash of the text; rows with equal id and text count as one and get equal results. No rows give no rows;
    further columns are ignored.
    """
    texts = _texts(documents)
    spans = repeated_spans(texts, length, hot)
    lists = spans.groupBy(F.col("id").alias("s_id"), F.col("version").alias("s_version")).agg(
        F.collect_list(F.struct("start", "stop")).alias("found")
    )
    both = squeezed(texts, "id", "version").join(lists, (F.col("id") == F.col("s_id")) & (F.col("version") == F.col("s_version")), "left")
    out = both.select("id", "version", "text", "found").mapInArrow(
        _kept, "id long, version long, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>"
    )
    return out.select(F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"), "n_bytes", "kept", "spans")


def digest(found: DataFrame) -> DataFrame:
    """The result as counts and a digest of what is kept."""
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
