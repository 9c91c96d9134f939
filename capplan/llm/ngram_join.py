"""N-gram Jaccard join: which documents are linked, directly or through others, by similar sets of word shingles.

Exact, in four steps. (1) Every document becomes its set of distinct three-word shingles; documents with
equal sets are one node from there on. (2) Two sets that are similar enough differ in few tokens; dealt into
more parts than that, they are equal in one, so nodes are brought together by keys of their parts and go into
one candidate family. Unlike a rare shingle, a part is hardly ever shared by sets that are far from similar. (3) Every node's signature goes to its family, where the dual traversal of a
signature tree leaves the nodes that may be linked; then whole sets of those go the same way, and the
traversal verifies. A family too large for one task is dealt into blocks, and pairs of blocks are traversed.
(4) Components of the links found give the smallest reachable id.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capplan.llm import rarity
from capplan.llm.common import OWN, Words, blocks, cut, expanded, map_arrow, mix, released, scramble, ship, squeezed
from capplan.llm.graph import components
from capplan.llm.sigtree import Tree, signatures

#: Words of a shingle, and hundredths of similarity that link two sets.
SHINGLE, SHARE = 3, 90
#: Sets that one task takes at a time; a family with more is dealt into blocks of about so many.
BLOCK = 8192
#: Parts into which the nodes of a component are dealt to be told its smallest id.
DEALS = 16
#: Rows of one key beyond which it is dealt over several tasks.
HOT = 1 << 16


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (ascending hashes) of all texts in order, and where each text's begin and the last end.

    A text with fewer than ``n`` words but at least one is a single shingle; without words it has none.
    """
    words = Words(texts)
    count = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(count)), count)
    h = words.hashes
    if len(h) >= n:
        joined = h[: len(h) - n + 1]
        for k in range(1, n):
            joined = mix(joined, h[k : len(h) - n + 1 + k])
        whole = owner[: len(joined)] == owner[n - 1 :]
        doc, shingle = owner[: len(joined)][whole], joined[whole]
    else:
        doc, shingle = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        alone = np.full(len(short), 0x5851F42D4C957F2D, dtype=np.uint64)
        for k in range(n - 1):
            has = count[short] > k
            at = np.minimum(words.bounds[short] + k, len(h) - 1)
            alone = np.where(has, mix(alone, h[at]), alone)
        doc, shingle = np.concatenate([doc, short]), np.concatenate([shingle, alone])
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    doc, shingle = doc[fresh], shingle[fresh]
    return shingle, np.searchsorted(doc, np.arange(len(count) + 1))


def set_keys(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for a set, as two signed numbers."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(scramble(tokens + np.uint64(salt)))])
        out.append(scramble(sums[starts[1:]] - sums[starts[:-1]] + np.uint64(1)).view(np.int64))
    return out[0], out[1]


def _classes(share: int, largest: int) -> np.ndarray:
    """Least sizes of the classes of sets: all sizes up to the largest, each class a quarter wider than it begins, or as wide as links reach."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, edges[-1] * max(125, 10000 // share) // 100))
    return np.array(edges)


def part_keys(tokens: np.ndarray, starts: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which similar sets have one in common, and where each set's begin and the last end.

    Sets of a and b tokens that are similar enough differ in at most ``(a + b) * (100 - share) / (100 + share)``
    tokens. Where tokens are dealt by value into one part more than that, such sets are equal in some part: a
    part's key stands for its tokens. There are some more parts, of which each set leaves out so many, those with
    fewest tokens: sets far from similar may be equal in these, and of the parts in which similar sets are
    equal the one with most tokens stays in both. The number of parts goes by the class of the larger set, so a
    set also has the keys of classes above its own that sets similar to it may be in. Where none may differ
    there are no keys, as only equal sets are similar.
    """
    size = np.diff(starts)
    edges = _classes(share, 100 * int(size.max(initial=0)) // share)
    differ = np.append(2 * (edges[1:] - 1) * (100 - share) // (100 + share), 0)
    spare = 1 + differ // 5
    parts = np.where(differ > 0, differ + 1 + spare, 0)  # none in the last class, which is beyond all sets
    own = np.searchsorted(edges, size, side="right") - 1
    top = np.searchsorted(edges, 100 * size // share, side="right") - 1
    spread = scramble(tokens ^ np.uint64(0x452821E638D01377))
    owner = np.repeat(np.arange(len(size)), size)
    keys, sets = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for up in range(int((top - own).max(initial=0)) + 1):
        of = np.where((size > 0) & (own + up <= top), own + up, len(parts) - 1)
        many = parts[of]
        first = np.concatenate([[0], np.cumsum(many)])
        mine = np.flatnonzero(many[owner])
        # tokens of a set ascend, and so do their parts
        part = ((tokens[mine] >> np.uint64(32)) * many[owner[mine]].astype(np.uint64)) >> np.uint64(32)
        flat = first[owner[mine]] + part.astype(np.int64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread[mine])])
        ends = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=int(first[-1])))])
        belongs = np.repeat(np.arange(len(size)), many)
        number = np.arange(len(belongs)) - first[belongs]
        name = scramble((of[belongs].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64) + np.uint64(1))
        key = scramble(sums[ends[1:]] - sums[ends[:-1]] + name)
        # most tokens last
        order = np.lexsort((key, np.diff(ends), belongs))
        kept = number >= spare[of[belongs]]
        keys.append(key[order][kept])
        sets.append(belongs[kept])
    keys, sets = np.concatenate(keys), np.concatenate(sets)
    order = np.argsort(sets, kind="stable")
    return keys[order], np.searchsorted(sets[order], np.arange(len(size) + 1))


_SURVEY = f"doc_id long, key long, size long, k1 long, k2 long, signature binary, parts binary, {rarity.COUNTS}"


def _survey(batches, n: int, share: int):
    """Per document its set's size, key, signature and keys of parts; at the end of the task, how many have these."""
    counter = rarity.Counter()
    names = [c.split()[0] for c in _SURVEY.split(", ")]
    seen: set[int] = set()  # sets of this task, whose parts are given once
    for batch in batches:
        for block in blocks(batch):
            tokens, starts = shingle_sets(block.column("text"), n)
            k1, k2 = set_keys(tokens, starts)
            keys, bounds = part_keys(tokens, starts, share)
            parts: list[bytes | None] = [None] * len(k1)
            for i, key in enumerate(k1.tolist()):
                if bounds[i] < bounds[i + 1] and key not in seen:
                    seen.add(key)
                    parts[i] = keys[bounds[i] : bounds[i + 1]].tobytes()
            counter.add(np.frombuffer(b"".join(p for p in parts if p is not None), dtype=np.uint64))
            none = pa.nulls(len(k1), pa.int32()), pa.nulls(len(k1), pa.binary())
            signed = pa.array([s.tobytes() for s in signatures(tokens, starts)], pa.binary())
            columns = [block.column("doc_id"), block.column("key"), *map(pa.array, (np.diff(starts), k1, k2))]
            yield pa.RecordBatch.from_arrays([*columns, signed, pa.array(parts, pa.binary()), *none], names=names)
    rows = counter.rows()
    none = [pa.nulls(len(rows), pa.int64())] * 5 + [pa.nulls(len(rows), pa.binary())] * 2
    numbers, raw = zip(*rows, strict=True)
    yield pa.RecordBatch.from_arrays([*none, pa.array(numbers, pa.int32()), pa.array(raw, pa.binary())], names=names)


_PARTS = "s long, deal int, id long"


def _parts(steps: np.ndarray, hot: int):
    """A row for each key of a set; those of a key that very many may have are dealt, from 1 on."""

    def step(batch: pa.RecordBatch):
        for block in blocks(batch, "parts"):
            raw = block.column("parts").to_pylist()
            keys = np.frombuffer(b"".join(raw), dtype=np.uint64)
            ids = np.repeat(block.column("id").to_numpy(), [len(r) // 8 for r in raw])
            level = steps[(keys >> np.uint64(64 - rarity.BITS)).astype(np.int64)]
            deals = (np.exp2(level / 8.0) / hot).astype(np.int64) + 1
            deal = np.where(deals > 1, 1 + (scramble(ids.view(np.uint64)) >> np.uint64(1)).astype(np.int64) % deals, 0)
            columns = keys.view(np.int64), deal.astype(np.int32), ids
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["s", "deal", "id"])

    return step


_EDGES = "a long, b long, hot long"


def _stars(batches):
    """Edges of each node to the first of its key and deal; input sorted by those. Of dealt keys, that node with the key."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        s, deal, ids = (batch.column(c).to_numpy() for c in ("s", "deal", "id"))
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (deal[1:] != deal[:-1])
        new[0] = last is None or last[:2] != (s[0], deal[0])
        at = np.flatnonzero(new)
        group = np.cumsum(new)
        first = np.concatenate([[0 if last is None else last[2]], ids[at]])[group]
        last = s[-1], deal[-1], first[-1]
        far = np.flatnonzero(ids != first)
        top = at[deal[at] > 0]
        a, b = np.concatenate([ids[far], ids[top]]), np.concatenate([first[far], ids[top]])
        hot = pa.concat_arrays([pa.nulls(len(far), pa.int64()), pa.array(s[top])])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), hot], names=["a", "b", "hot"])


def _sets(n: int):
    """Sets of the texts whose set is the one asked for."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for block in expanded(batch):
            tokens, starts = shingle_sets(block.column("text"), n)
            k1, k2 = set_keys(tokens, starts)
            right = (k1 == block.column("k1").to_numpy()) & (k2 == block.column("k2").to_numpy())
            raw = [tokens[s:e].tobytes() for s, e in zip(starts[:-1], starts[1:], strict=True)]
            block = pa.RecordBatch.from_arrays(
                [block.column("family"), block.column("id"), pa.array(raw, pa.binary()), block.column("tasks")],
                names=["family", "id", "tokens", "tasks"],
            )
            out.append(block.filter(pa.array(right)))
        return pa.concat_batches(out)

    return step


def _tree(rows: pa.Table, exact: bool) -> tuple[Tree, np.ndarray]:
    """The tree of some rows, with whole sets or with signatures alone, and their ids in its order."""
    ids, sizes = rows.column("id").to_numpy(), rows.column("size").to_numpy()
    raw = rows.column("tokens" if exact else "signature").to_pylist()
    order = sorted(range(len(raw)), key=lambda i: (sizes[i], raw[i][:8], ids[i]))
    sizes = sizes[order]
    data = np.frombuffer(b"".join(raw[i] for i in order), dtype=np.uint64 if exact else np.uint8)
    if not exact:
        return Tree(data.reshape(len(raw), -1), sizes), ids[order]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return Tree(signatures(data, starts), sizes, data, starts), ids[order]


def _edges(ids: np.ndarray, roots: np.ndarray) -> pa.Table:
    far = np.flatnonzero(roots != np.arange(len(roots)))
    return pa.table({"a": pa.array(ids[far]), "b": pa.array(ids[roots[far]])})


def _link(rows: pa.Table, share: int, exact: bool) -> pa.Table:
    """Links (or, from signatures, possible links) within the families of one task, or between the two blocks of a large one."""
    codes = rows.column("family").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((rows.column("id").to_numpy(), codes))
    rows, codes = rows.take(pa.array(order)), codes[order]
    ids = rows.column("id").to_numpy()
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (codes[1:] != codes[:-1])  # repeated rows
    rows, codes = rows.filter(pa.array(new)), codes[new]
    out = [pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})]
    cuts = np.flatnonzero(np.diff(codes)) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(codes)], strict=True):
        if end - start > 1:
            part = rows.slice(start, end - start)
            tree, ids = _tree(part, exact)
            second = dict(zip(part.column("id").to_pylist(), part.column("second").to_pylist(), strict=True))
            border = None if None in second.values() else np.array([second[i] for i in ids.tolist()])
            out.append(_edges(ids, tree.join(share, border=border).roots(0, len(ids))))
    return pa.concat_tables(out)


def link_documents(documents: DataFrame, n: int = SHINGLE, share: int = SHARE, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``documents`` (needs ``doc_id`` and ``text``).

    Words are runs without ASCII white space, A-Z lower-cased, of the whole text. Two sets are linked when
    ``100 * intersection >= share * union``; ``component_id`` is the smallest id reachable. NULL text and text
    without words have no shingles and are linked with nothing; repeated rows are one node and appear each;
    a row without id has the component of its copies, or none. No rows give an empty result.
    """
    return _linked(documents, n, share, block).select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _linked(documents: DataFrame, n: int, share: int, block: int = BLOCK) -> DataFrame:
    """Per row ``doc_id``, ``key`` (tells rows of one id apart by their text), ``size``, ``component`` and ``component_id``.

    A node is a set, numbered by its key: one id may have several texts, so ids do not tell components apart.
    """
    spark = documents.sparkSession
    ship(spark)
    text = F.col("text").cast("string")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    survey = cut(texts.mapInArrow(released(partial(_survey, n=n, share=share)), _SURVEY))
    counted = survey.where("slice is not null").select("slice", "counts")
    steps = rarity.levels(rarity.summed(counted))
    light = survey.where("slice is null").select("doc_id", "key", "size", "k1", "k2")
    firsts = [F.min("doc_id").alias("doc"), F.first("size").alias("size"), F.first("signature").alias("signature")]
    nodes = cut(survey.where("size > 0").groupBy("k1", "k2").agg(*firsts).withColumn("id", F.col("k1")))

    held = survey.where("parts is not null").select(F.col("k1").alias("id"), "parts")
    rows = map_arrow(held, partial(_parts, steps, HOT), _PARTS)
    families = components(_candidates(rows)).select(F.col("node").alias("id"), F.col("component").alias("family"))
    pairs = "a long, b long"
    # possible links within families, from signatures: what they do not bring together needs no whole sets
    members = families.join(nodes.where("doc is not null"), "id")
    coarse = _asked(members, share, block).select("family", "id", "size", "signature", F.inline("tasks"))
    near = components(coarse.groupBy("task").applyInArrow(lambda rows: _link(rows, share, False), pairs))
    fine = near.select(F.col("node").alias("id"), F.col("component").alias("family")).join(
        nodes.select("id", "doc", "k1", "k2", "size"), "id"
    )
    asked = _asked(fine, share, block)
    of = squeezed(texts, "doc_id").join(asked, F.col("doc_id") == F.col("doc")).select("text", "family", "id", "k1", "k2", "tasks")
    kind = "family long, id long, tokens binary, tasks array<struct<task:long,second:boolean>>"
    dealt = map_arrow(of, partial(_sets, n), kind).select(
        "family", "id", (F.octet_length("tokens") / 8).cast("long").alias("size"), "tokens", F.inline("tasks")
    )
    links = dealt.groupBy("task").applyInArrow(lambda rows: _link(rows, share, True), pairs)
    found = components(links).select(F.col("node").alias("id"), "component")
    grouped = cut(nodes.drop("signature").join(found, "id", "left"))
    linked = grouped.where("component is not null").withColumn("deal", F.pmod(F.xxhash64("id"), F.lit(DEALS).cast("long")))
    # a component may be a large part of all sets, so its nodes are dealt
    deals = F.sequence(F.lit(0).cast("long"), F.lit(DEALS - 1).cast("long"))
    least = linked.groupBy("component").agg(F.min("doc").alias("least")).withColumn("deal", F.explode(deals))
    together = linked.join(least, ["component", "deal"]).select("k1", "k2", "component", "least")
    alone = grouped.where("component is null").select("k1", "k2", F.col("id").alias("component"), F.col("doc").alias("least"))
    named = cut(alone.union(together).toDF("c1", "c2", "component", "component_id"))
    out = light.join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("size") > 0), "left")
    return out.select("doc_id", "key", "size", "component", "component_id")


def _candidates(rows: DataFrame) -> DataFrame:
    """Edges between nodes that have a key in common, directly or through others: a star around one node of each key.

    A key that very many nodes have is dealt over tasks, and the middles of its stars are brought together after that.
    """
    near = rows.repartition("s", "deal").sortWithinPartitions("s", "deal")
    edges = cut(near.mapInArrow(released(_stars), _EDGES))
    hot = edges.where("hot is not null")
    across = hot.join(hot.groupBy("hot").agg(F.min("a").alias("m")), "hot").select("a", F.col("m").alias("b"))
    return edges.select("a", "b").union(across).where("a != b")


def _asked(members: DataFrame, share: int, block: int) -> DataFrame:
    """The nodes of families of two or more with ``tasks``: which tasks compare them with which.

    Small families go whole to a task, several to one. A large family is dealt into blocks by size and
    chance; a node goes to every pair of its block with one whose sizes allow a link.
    """
    counts = members.groupBy("family").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    found = cut(members.join(counts, "family").withColumn("family", F.xxhash64("family")))
    small, large = found.where(F.col("members") <= block), found.where(F.col("members") > block)
    tasks = max(1, -(-small.count() * 4 // block))
    alone = F.struct(F.pmod("family", F.lit(tasks)).alias("task"), F.lit(None).cast("boolean").alias("second"))
    columns = [*members.columns, "tasks"]
    whole = small.withColumn("tasks", F.array(alone)).select(*columns)

    band = F.floor(F.log(F.col("size")) / F.log(F.lit(100 / share)) + 1e-9).cast("long")
    banded = large.withColumn("band", band)
    parts = (
        banded.groupBy("family", "band")
        .agg(F.ceil(2 * F.count(F.lit(1)) / block).alias("parts"))
        .select("family", "band", "parts")
    )
    near = parts.select("family", F.col("band").alias("other"), F.col("parts").alias("others"))
    pairs = (
        banded.join(parts, ["family", "band"])
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        .join(near, "family")
        .where(F.abs(F.col("band") - F.col("other")) <= 1)
        .withColumn("against", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)))
    )
    own, far = F.struct("band", "part"), F.struct(F.col("other").alias("band"), F.col("against").alias("part"))
    task = F.xxhash64("family", F.least(own, far), F.greatest(own, far)).alias("task")
    second = F.when(own != far, own > far).alias("second")
    sent = pairs.groupBy("family", "id").agg(F.collect_list(F.struct(task, second)).alias("tasks"))
    return whole.union(large.join(sent, ["family", "id"]).select(*columns))


def keep_one(documents: DataFrame, n: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """``documents`` with one row of each component: one with the smallest id; columns unchanged.

    Rows of one id are told apart by their text: a text goes only if it is linked itself, of several texts of
    the smallest id one stays, and of repeated rows one. Rows without words, or without id, stay as they are.
    """
    rows = cut(_linked(documents, n, share).where("size > 0 and doc_id is not null"))
    first = rows.groupBy("component").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    stays = first.select("first.doc_id", "first.key", F.lit(True).alias("stays"))
    told = rows.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("times")).join(stays, ["doc_id", "key"], "left")
    judged = cut(told.where("stays is null or times > 1"))

    def named(table: DataFrame) -> DataFrame:
        return table.select(F.col("doc_id").alias(f"{OWN}id"), F.col("key").alias(f"{OWN}key"))

    keyed = documents.withColumn(f"{OWN}row", F.xxhash64(F.col("text").cast("string")))
    same = (F.col("doc_id").cast("long") == F.col(f"{OWN}id")) & (F.col(f"{OWN}row") == F.col(f"{OWN}key"))
    left = keyed.join(named(judged), same, "left_anti")
    twice = judged.where("stays")
    if not twice.isEmpty():
        left = left.union(keyed.join(named(twice), same, "left_semi").dropDuplicates(["doc_id", f"{OWN}row"]))
    return left.drop(f"{OWN}row")
