"""How the sources of a language diverge in their words: exact counts through minimal perfect hashes.

First pass: in how many documents of a language each term occurs; terms in enough documents are kept. The
kept terms of a language are dealt into shards of a few thousand, and each shard gets a minimal
perfect hash (buckets of keys, each with a seed that sends its keys to free slots) with its keys stored in slot
order. Second pass: the shards are broadcast, as many at a time as ``BROADCAST`` bytes allow; each term of a document
is looked up and checked against the stored key, and counted in its group's dense slots. What travels then are slots
and counts, without terms.

Keys whose 64-bit hash another key of the shard has are kept aside and found by their bytes, so counts are exact.
With more shards than one broadcast may hold there are several second passes over the documents.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from capplan.llm.common import blocks, cut, scramble, ship
from capplan.llm.runs import Terms

#: Documents of a language that a kept term occurs in, at least.
MIN_DOCS = 3
#: Terms of a shard, about.
SHARD = 4096
#: Bytes of keys and seeds that are broadcast at a time.
BROADCAST = 48 << 20
#: Bytes of counts that a task holds before it hands them on.
HELD = 48 << 20
#: Groups of one block; pairs of groups are made block against block.
GROUPS = 256
#: Ranks of terms that are reported.
TOP = 200
#: Parts in which probabilities are counted.
UNIT = 1_000_000_000

_SHARD_SALT, _BUCKET_SALT, _SEED = (np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0x9E3779B97F4A7C15))
_BUCKET = 4


def _bucket(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (scramble(hashes ^ _BUCKET_SALT) % n.astype(np.uint64)).astype(np.int64)


def _slot(hashes: np.ndarray, seeds: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (scramble(hashes + seeds.astype(np.uint64) * _SEED) % n.astype(np.uint64)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds by bucket, and the slot of each of the (different) hashes: a permutation of 0 to n - 1.

    A seed s from 0 on sends the keys of its bucket to ``_slot(hash, s)``; -1 - x sends its only key to slot x.
    """
    n = len(hashes)
    buckets = max(1, -(-n // _BUCKET))
    size = np.array([buckets])
    bucket = _bucket(hashes, size)
    members: list[list[int]] = [[] for _ in range(buckets)]
    for k, b in enumerate(bucket.tolist()):
        members[b].append(k)
    seeds, slots, free = np.zeros(buckets, np.int32), np.zeros(n, np.int64), np.ones(n, dtype=bool)
    room = np.array([n])
    order = sorted(range(buckets), key=lambda b: -len(members[b]))
    for b in order:
        keys = members[b]
        if len(keys) < 2:
            break
        own, first = hashes[keys], 0
        while True:
            tries = np.arange(first, first + 64)
            at = _slot(own[None, :], tries[:, None], room)
            sorted_ = np.sort(at, axis=1)
            fit = free[at].all(axis=1) & (sorted_[:, 1:] != sorted_[:, :-1]).all(axis=1)
            if fit.any():
                k = int(np.argmax(fit))
                seeds[b], slots[keys] = first + k, at[k]
                free[at[k]] = False
                break
            first += 64
    left = iter(np.flatnonzero(free).tolist())
    for b in order:
        if len(members[b]) == 1:
            slots[members[b][0]] = x = next(left)
            seeds[b] = -1 - x
    return seeds, slots


_SHARDS = "lang string, shard int, n int, seeds binary, sizes binary, keys binary, aside int"


def _shard(rows: pa.Table) -> pa.Table:
    """One shard's seeds, and its keys in slot order; ``aside`` keys at the end share a hash with another."""
    terms = sorted(t.encode() for t in rows.column("term").to_pylist())
    hashes = Terms(pa.array([t.decode() for t in terms])).hashes
    _, first = np.unique(hashes, return_index=True)
    aside = sorted(set(range(len(terms))) - set(first.tolist()))
    seeds, slots = perfect_hash(hashes[first])
    keys = [b""] * len(first)
    for k, s in zip(first.tolist(), slots.tolist(), strict=True):
        keys[s] = terms[k]
    keys += [terms[k] for k in aside]
    sizes = np.array([len(k) for k in keys], dtype=np.int32)
    row = (rows.column("lang")[0].as_py(), rows.column("shard")[0].as_py(), len(keys), seeds.tobytes(), sizes.tobytes(), b"".join(keys), len(aside))
    names = [c.split()[0] for c in _SHARDS.split(", ")]
    return pa.Table.from_pylist([dict(zip(names, row, strict=True))], schema=_arrow(_SHARDS))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


class Lookup:
    """Slots of terms in some shards: shard after shard, numbered through."""

    def __init__(self, rows: list, shards: dict[str, int]):
        self.of = {(r["lang"], r["shard"]): k for k, r in enumerate(rows)}
        self.names, self.shards = list(self.of), shards
        self.n = np.array([r["n"] for r in rows], dtype=np.int64)
        self.hashed = self.n - np.array([r["aside"] for r in rows], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        seeds = [np.frombuffer(r["seeds"], np.int32) for r in rows]
        self.buckets = np.array([len(s) for s in seeds], dtype=np.int64)
        self.first_bucket = np.concatenate([[0], np.cumsum(self.buckets)])
        self.seeds = np.concatenate([*seeds, np.zeros(0, np.int32)])
        sizes = np.concatenate([*[np.frombuffer(r["sizes"], np.int32) for r in rows], np.zeros(0, np.int32)])
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.starts = self.ends - sizes
        self.keys = np.frombuffer(b"".join(r["keys"] for r in rows), np.uint8)
        self.aside = {
            (r["lang"], self.key(s)): s for k, r in enumerate(rows) for s in range(self.first[k] + self.hashed[k], self.first[k + 1])
        }

    def key(self, slot: int) -> bytes:
        return self.keys[self.starts[slot] : self.ends[slot]].tobytes()

    def find(self, lang: str, terms: Terms, picked: np.ndarray) -> np.ndarray:
        """The slot of each picked term, -1 where it isn't a key of these shards."""
        out = np.full(len(picked), -1, dtype=np.int64)
        if lang not in self.shards or not len(picked):
            return out
        hashes = terms.hashes[picked]
        numbers = np.array([self.of.get((lang, s), -1) for s in range(self.shards[lang])])
        shard = numbers[shard_of(hashes, self.shards[lang])]
        there = np.flatnonzero((shard >= 0) & (self.hashed[shard] > 0))
        shard, hashes = shard[there], hashes[there]
        seed = self.seeds[self.first_bucket[shard] + _bucket(hashes, self.buckets[shard])].astype(np.int64)
        slot = np.where(seed < 0, -1 - seed, _slot(hashes, np.maximum(seed, 0), self.hashed[shard])) + self.first[shard]
        # the stored key decides
        k = picked[there]
        size = terms.ends[k] - terms.starts[k]
        true = size == self.ends[slot] - self.starts[slot]
        some = np.flatnonzero(true)
        n = size[some]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        unlike = terms.bytes[np.repeat(terms.starts[k[some]], n) + inner] != self.keys[np.repeat(self.starts[slot[some]], n) + inner]
        true[some[np.unique(np.repeat(np.arange(len(some)), n)[unlike])]] = False
        out[there[true]] = slot[true]
        if self.aside:
            for p in there[~true].tolist():
                out[p] = self.aside.get((lang, terms.raw(picked[p])), -1)
        return out


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (scramble(hashes ^ _SHARD_SALT) % np.uint64(shards)).astype(np.int64)


def _in_documents(batches):
    """Terms with the number of documents that hold them, by language, block by block."""
    for batch in batches:
        for block in blocks(batch, limit=8 << 20):
            terms = Terms(block.column("text"))
            first, number = terms.distinct()
            if not len(first):
                continue
            codes = block.column("lang").dictionary_encode()
            held = np.unique(terms.owners() * len(first) + number)
            lang = codes.indices.to_numpy().astype(np.int64)[held // len(first)]
            pairs, counts = np.unique(lang * len(first) + held % len(first), return_counts=True)
            raw = terms.pick(first).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [codes.dictionary.take(pa.array(pairs // len(first))), raw.take(pa.array(pairs % len(first))),
                 pa.array(terms.hashes[first[pairs % len(first)]].view(np.int64)), pa.array(counts)],
                names=["lang", "term", "hash", "n"],
            )


_COUNTS = "lang string, source string, shard int, total long, slots binary, counts binary"


def _counted(batches, lookup):
    """Counts of terms by group and shard, from dense slots that are handed on when they get many."""
    found: Lookup = lookup.value
    dense: dict[tuple[str, str], np.ndarray] = {}
    edges: dict[str, tuple[int, int]] = {}
    for k, (lang, _) in enumerate(found.names):
        low, high = edges.get(lang, (found.first[k], 0))
        edges[lang] = (min(low, int(found.first[k])), max(high, int(found.first[k + 1])))

    def handed():
        rows = []
        for (lang, source), counts in dense.items():
            low = edges[lang][0]
            some = np.flatnonzero(counts)
            shard = np.searchsorted(found.first, some + low, side="right") - 1
            for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(shard)) + 1):
                if len(part):
                    k = int(shard[part[0]])
                    own = counts[some[part]]
                    rows.append((lang, source, found.names[k][1], int(own.sum()), _packed(some[part] + low - found.first[k]), _packed(own)))
        dense.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _arrow(_COUNTS), strict=True)], schema=_arrow(_COUNTS))

    for batch in batches:
        for block in blocks(batch, limit=8 << 20):
            terms = Terms(block.column("text"))
            first, number = terms.distinct()
            owner = terms.owners()
            groups: dict[tuple[str, str], int] = {}
            of = np.array([groups.setdefault(g, len(groups)) for g in zip(block.column("lang").to_pylist(), block.column("source").to_pylist(), strict=True)])
            slots = {lang: found.find(lang, terms, first) for lang in sorted({lang for lang, _ in groups}) if lang in edges}
            group = of[owner] if len(owner) else np.zeros(0, np.int64)
            order = np.argsort(group, kind="stable")
            bounds = np.searchsorted(group[order], np.arange(len(groups) + 1))
            for (lang, source), g in groups.items():
                if lang not in edges:
                    continue
                at = slots[lang][number[order[bounds[g] : bounds[g + 1]]]]
                at = at[at >= 0]
                if not len(at):
                    continue
                low, high = edges[lang]
                if (lang, source) not in dense:
                    if sum(d.nbytes for d in dense.values()) + 4 * (high - low) > HELD:
                        yield from handed()
                    dense[lang, source] = np.zeros(high - low, dtype=np.int32)
                dense[lang, source] += np.bincount(at - low, minlength=high - low).astype(np.int32)
        if dense and max(int(d.max()) for d in dense.values()) > 1 << 30:
            yield from handed()
    yield from handed()


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes each as the largest needs; the first byte says how many."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _summed(batches, keys: tuple[str, ...]):
    """Rows of one key, which come together, added up; ``source`` is NULL where it is no key."""
    state: dict = {"key": None, "counts": np.zeros(0, np.int64)}

    def done():
        counts = state["counts"]
        some = np.flatnonzero(counts)
        key = dict(zip(keys, state["key"], strict=True))
        row = (key["lang"], key.get("source"), key["shard"], int(counts.sum()), _packed(some), _packed(counts[some]))
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _arrow(_COUNTS), strict=True)], schema=_arrow(_COUNTS))

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        for *key, slots, counts in zip(*columns, batch.column("slots").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            if key != state["key"]:
                if state["key"] is not None:
                    yield done()
                state.update(key=key, counts=np.zeros(0, np.int64))
            at, have = _unpacked(slots), _unpacked(counts)
            if len(at) and at[-1] >= len(state["counts"]):
                state["counts"] = np.concatenate([state["counts"], np.zeros(int(at[-1]) + 1 - len(state["counts"]), np.int64)])
            state["counts"][at] += have
    if state["key"] is not None:
        yield done()


def _sums(counts: DataFrame, *keys: str) -> DataFrame:
    ordered = counts.repartition("lang", "shard").sortWithinPartitions(*keys)
    return ordered.mapInArrow(partial(_summed, keys=keys), _COUNTS)


def probabilities(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / (total + terms)), exact at any size."""
    if len(counts) and (int(counts.max()) + 1) * UNIT >= 1 << 63:
        return np.array([1 + UNIT * (int(c) + 1) // (total + terms) for c in counts], dtype=np.int64)
    return 1 + UNIT * (counts + 1) // (total + terms) if len(counts) else counts


def _best_terms(batches, top: int):
    """Of each group and shard, the terms that it has more of than its language; as many as may be ranked."""
    for batch in batches:
        out: list[tuple[str, str, str, int]] = []
        for r in batch.to_pylist():
            at = _unpacked(r["slots"])
            whole = np.zeros(r["n"], np.int64)
            whole[_unpacked(r["lang_slots"])] = _unpacked(r["lang_counts"])
            p = probabilities(_unpacked(r["counts"]), r["group_total"], r["terms"])
            q = probabilities(whole[at], r["lang_total"], r["terms"])
            more = np.flatnonzero(p > q)
            value = (p[more] - q[more]) ** 2 // q[more]
            ends = np.cumsum(np.frombuffer(r["sizes"], np.int32), dtype=np.int64)
            starts = ends - np.frombuffer(r["sizes"], np.int32)
            best = sorted(
                (-v, r["keys"][starts[s] : ends[s]]) for v, s in zip(value.tolist(), at[more].tolist(), strict=True)
            ) if len(more) <= top else _first(value, at[more], r["keys"], starts, ends, top)
            out += [(r["lang"], r["source"], key.decode(), -v) for v, key in best]
        if out:
            schema = _arrow("lang string, source string, item string, value long")
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _first(value, at, keys, starts, ends, top):
    """The first ``top`` by value (descending) and key; those equal to the last value are all looked at."""
    least = -np.partition(-value, top - 1)[top - 1]
    some = np.flatnonzero(value >= least)
    return sorted((-v, keys[starts[s] : ends[s]]) for v, s in zip(value[some].tolist(), at[some].tolist(), strict=True))[:top]


def _pairs(rows: pa.Table) -> pa.Table:
    """Sums over one shard for every pair of a group of block i and one of block j of a language."""
    left, right = [], []
    for r in rows.to_pylist():
        counts = np.zeros(r["n"], np.int64)
        if r["slots"] is not None:
            counts[_unpacked(r["slots"])] = _unpacked(r["counts"])
        p = probabilities(counts, r["group_total"], r["terms"])
        (left if r["left"] else right).append((r["source"], p))
    lang = rows.column("lang")[0].as_py()
    out = []
    if left and right:
        q = np.stack([p for _, p in right])
        for source, p in left:
            sums = (((p - q) ** 2) // np.maximum(q, 1)).sum(axis=1)
            out += [(lang, source, item, value) for (item, _), value in zip(right, sums.tolist(), strict=True) if item != source]
    schema = _arrow("lang string, source string, item string, value long")
    if not out:
        return schema.empty_table()
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def kept_terms(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, hash, n`` (documents) of the terms in at least ``min_docs`` documents of a language."""
    ship(rows.sparkSession)
    found = rows.select("lang", "text").mapInArrow(_in_documents, "lang string, term string, hash long, n long")
    return found.groupBy("lang", "term", "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def _shards(kept: DataFrame, sizes: DataFrame, shard: int) -> DataFrame:
    """Every shard of every language, built by the executors."""
    def numbered(batches):
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            n = batch.column("shards").to_numpy().astype(np.uint64)
            at = (scramble(hashes ^ _SHARD_SALT) % n).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("term"), pa.array(at)], names=["lang", "term", "shard"])

    dealt = kept.join(sizes.select("lang", "shards"), "lang").select("lang", "term", "hash", "shards")
    rows = dealt.mapInArrow(numbered, "lang string, term string, shard int")
    return rows.groupBy("lang", "shard").applyInArrow(_shard, _SHARDS)


def divergence(
    documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, *, shard: int = SHARD, broadcast: int = BROADCAST, groups: int = GROUPS
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far the groups (lang, source) of ``documents`` lie apart.

    Terms are runs of letters (ASCII letters, A-Z lower-cased, and all code points from 128 on); a language keeps those in at
    least ``min_docs`` of its documents (rows). With count + 1 over N + V as probability p, in parts of 10^9, part ``pair``
    has for each other source of the language the sum of floor((p - q)^2 / q) over kept terms, all ranks; part ``term``
    the group's terms above the language's probability, ranks to ``top``. Ties go by item in UTF-8 order.

    NULL text, lang and source count as empty; each row is a document, repeated rows too; a group without
    terms is compared like others; a language without kept terms has pairs of value 0 and no terms. No rows
    give no rows; further columns are ignored. Very long texts are read whole. ``shard``, ``broadcast`` and ``groups``
    (terms of a shard, bytes broadcast at a time, groups of a block) change the work, not the result.
    """
    spark = documents.sparkSession
    ship(spark)
    empty = F.lit("")
    rows = documents.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    kept = cut(kept_terms(rows, min_docs))
    sizes = cut(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")).withColumn("shards", F.ceil(F.col("terms") / shard).cast("int"))
    )
    shards = cut(_shards(kept, sizes, shard))
    bytes_ = shards.agg(F.sum(F.octet_length("seeds") + F.octet_length("sizes") + F.octet_length("keys"))).first()[0] or 0
    rounds = max(1, -(-bytes_ // broadcast))
    # one row per language; languages are few
    numbers = {r["lang"]: r["shards"] for r in sizes.select("lang", "shards").toLocalIterator()}
    parts = []
    for k in range(rounds):
        some = shards.where(F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == k).orderBy("lang", "shard").collect()
        lookup = spark.sparkContext.broadcast(Lookup(some, numbers))
        del some
        parts.append(cut(rows.mapInArrow(partial(_counted, lookup=lookup), _COUNTS)))
        lookup.unpersist()
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.union(part)
    by_group = cut(_sums(counts, "lang", "source", "shard"))
    by_lang = _sums(by_group, "lang", "shard").drop("source")
    totals = by_group.groupBy("lang", "source").agg(F.sum("total").alias("found"))
    members = rows.select("lang", "source").groupBy("lang", "source").agg(F.lit(1).alias("one"))
    known = members.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    known = cut(
        known.select("lang", "source", F.coalesce("found", F.lit(0)).alias("group_total"), F.coalesce("terms", F.lit(0)).alias("terms"))
    )
    of_lang = known.groupBy("lang").agg(F.sum("group_total").alias("lang_total"), F.count(F.lit(1)).alias("sources"))
    # terms
    whole = by_lang.select("lang", "shard", F.col("slots").alias("lang_slots"), F.col("counts").alias("lang_counts"))
    wide = (
        by_group.drop("total")
        .join(whole, ["lang", "shard"])
        .join(shards.select("lang", "shard", "n", "sizes", "keys"), ["lang", "shard"])
        .join(known, ["lang", "source"])
        .join(of_lang, "lang")
    )
    terms = wide.mapInArrow(partial(_best_terms, top=top), "lang string, source string, item string, value long")
    # pairs: every group in every shard of its language, block of groups against block of groups
    spread = known.join(of_lang, "lang").withColumn("blocks", F.ceil(F.col("sources") / groups).cast("int"))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
    places = spread.join(shards.select("lang", "shard", "n"), "lang", "left").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    places = places.withColumns({"shard": F.coalesce("shard", F.lit(-1)), "n": F.coalesce("n", F.lit(0))})
    dense = places.join(by_group.drop("total"), ["lang", "source", "shard"], "left")
    sides = F.array(
        F.struct(F.col("block").alias("i"), F.col("other").alias("j"), F.lit(True).alias("left")),
        F.struct(F.col("other").alias("i"), F.col("block").alias("j"), F.lit(False).alias("left")),
    )
    dealt = dense.select("lang", "source", "shard", "n", "group_total", "terms", "slots", "counts", F.inline(sides))
    sums = dealt.groupBy("lang", "shard", "i", "j").applyInArrow(_pairs, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [
        found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        for part, found in (("pair", pairs), ("term", terms))
    ]
    return ranked[0].union(ranked[1].where(F.col("rank") <= top))
