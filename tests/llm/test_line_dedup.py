import pickle
import random
import re
import time
import tracemalloc
from functools import partial


import numpy as np
import pyarrow as pa

from capplan.llm import line_dedup

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(docs, share=80):
    """Lines of each document that an earlier line of the table is similar to."""
    lines = []
    for doc, text in sorted(docs):
        for number, line in enumerate(text.split("\n")):
            words = frozenset(w.encode().lower() for w in WORDS.findall(line))
            if words:
                lines.append((doc, number, words))
    out = {doc: [] for doc, _ in docs}
    for k, (doc, number, words) in enumerate(lines):
        for _, _, other in lines[:k]:
            both = len(words & other)
            if 100 * both >= share * (len(words) + len(other) - both):
                out[doc].append(number)
                break
    return out


def documents(seed, n=120):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "the", "É"]
    texts = []
    for doc in range(n):
        lines = []
        for _ in range(pick.randint(0, 6)):
            if texts and pick.random() < 0.5:
                line = pick.choice(pick.choice(texts)[1].split("\n")).split(" ")
                for _ in range(pick.randint(0, 2)):
                    line[pick.randrange(len(line))] = pick.choice(vocabulary)
            else:
                line = [pick.choice(vocabulary) for _ in range(pick.choice((1, 3, 5, 12, 25)))]
            lines.append(" ".join(line))
        texts.append((doc, "\n".join(lines)))
    return texts


def test_equals_brute_force(spark):
    for seed in range(2):
        docs = documents(seed)
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        found = {row.doc_id: row.removed for row in line_dedup.report(frame).collect()}
        assert found == brute(docs)


def test_a_line_whose_first_candidates_fail_is_compared_with_all(spark):
    """Seven of ten words in common with many earlier lines, nine with the last of them."""
    base = [f"x{i}" for i in range(20)]
    docs = [(i, " ".join(base[:15] + [f"y{i}a{k}" for k in range(5)])) for i in range(30)]
    docs += [(50, " ".join(base)), (60, " ".join(base[:19] + ["z"]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {row.doc_id: row.removed for row in line_dedup.report(frame).collect()}
    assert found == brute(docs)
    assert found[60] == [0]


def test_odd_input(spark, odd, none):
    rows = {(row.doc_id, row.n_lines): (row.n_removed, row.removed) for row in line_dedup.report(odd).collect()}
    assert rows[(1, 1)] == (0, []) and rows[(2, 1)] == (1, [0])
    assert rows[(3, 0)] == rows[(4, 0)] == rows[(5, 0)] == (0, [])
    assert rows[(7, 1)] == (1, [0]) and rows[(None, 1)] == (0, [])
    assert line_dedup.report(odd).count() == odd.count()
    assert line_dedup.report(none).count() == 0
    kept = line_dedup.drop_repeated_lines(odd)
    assert kept.columns == odd.columns
    left = sorted(kept.select("doc_id").collect(), key=str)
    assert [row.doc_id for row in left] == [1, 3, 4, 5, 6, 8, None]
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_text_and_length_follow(spark):
    docs = spark.createDataFrame([(1, "one two three\nx", 15), (2, "one two three\ny", 15)], "doc_id long, text string, n_chars long")
    kept = line_dedup.drop_repeated_lines(docs).orderBy("doc_id").collect()
    assert [tuple(row) for row in kept] == [(1, "one two three\nx", 15), (2, "y", 1)]


def test_marks_miss_no_word(spark):
    words = [(k * 2654435761) % (1 << 62) - (1 << 61) for k in range(5000)]
    marks = line_dedup.Marks.of(spark.createDataFrame([(w,) for w in words], "word long").repartition(3))
    own = np.array(words, dtype=np.int64).view(np.uint64)
    assert marks.has(own).all()
    assert marks.has(own + np.uint64(1)).mean() < 0.01
    assert not line_dedup.Marks.of(spark.createDataFrame([], "word long")).bits.any()


def test_bands_reach_every_similar_size(spark):
    sizes = [*range(1, 60), 999, 100_000]
    words = np.arange(len(sizes), dtype=np.uint64)
    rows = [(int(w), n) for w, n in zip(words, sizes, strict=True)]
    for share in (80, 50):
        found = spark.createDataFrame(rows, "word long, size int").mapInArrow(partial(line_dedup.reached, share=share), "word long")
        marked = {r.word for r in found.collect()}
        for word, n in zip(words, sizes, strict=True):
            near = np.arange(-(-share * n // 100), 100 * n // share + 1)
            keys = line_dedup.banded(np.full(len(near), word), near)
            assert set(keys.view(np.int64).tolist()) <= marked


def test_wide_rows_never_tell_similar_sets_apart():
    """A set's parities differ from another's in at most as many places as the sets have different words."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.choice(60, rng.integers(1, 50), replace=False)) for _ in range(200)]
    lines = line_dedup.Lines(pa.array(texts, pa.large_string()))
    sets = [set(t.split()) for t in texts]
    gap = sum(np.bitwise_count(w[:100] ^ w[100:]).astype(int) for w in lines.wide())
    assert (gap <= [len(a ^ b) for a, b in zip(sets[:100], sets[100:], strict=True)]).all()
    assert gap.max() > 10


def test_parities_of_sets_of_any_size():
    """Parities never say more than the sets differ by, and tell large strangers apart too."""
    rng = np.random.default_rng(4)
    sets = []
    for size in (3, 90, 130, 260, 900, 3000):
        base = rng.choice(100_000, size, replace=False)
        near = np.concatenate([base[size // 8 :], rng.choice(100_000, size // 10, replace=False)])
        sets += [set(base.tolist()), set(near.tolist()), set(rng.choice(100_000, size, replace=False).tolist())]
    lines = line_dedup.Lines(pa.array([" ".join(f"w{k}" for k in s) for s in sets], pa.large_string()))
    found = line_dedup.Parities(np.array(lines.parities(np.arange(len(sets))).to_pylist(), dtype=object))
    x, y = (g.reshape(-1) for g in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    gap = found.gap(x, y)
    assert (gap <= [len(sets[i] ^ sets[j]) for i, j in zip(x, y, strict=True)]).all()
    for k in range(0, len(sets), 3):
        a, c = sets[k], sets[k + 2]
        assert 180 * (len(a) + len(c) - found.gap(np.array([k]), np.array([k + 2]))[0]) < 160 * (len(a) + len(c))


def test_rows_of_a_later_turn_grow_with_the_lines():
    """1,000 wanted lines whose sets all pass every filter: as many candidates as asked for, and not one for every two."""
    n = 1000
    rows = {"word": np.full(2 * n, 5), "id": np.tile(np.arange(n), 2), "line": np.zeros(2 * n, np.int32)}
    rows |= {"size": np.repeat([line_dedup.WANTED, 300], n).astype(np.int32), "place": np.zeros(2 * n, np.int32)}
    rows |= {"tally": np.zeros(2 * n, np.int64), "version": np.zeros(2 * n, np.int64)}
    wide = pa.array([b""] * n + [bytes(64)] * n, pa.binary())
    batch = pa.RecordBatch.from_arrays([*[pa.array(v) for v in rows.values()], wide], names=[*rows, line_dedup.WIDE])
    found = pa.Table.from_batches(line_dedup._pairs([batch.slice(0, 700), batch.slice(700)], 80, 8))
    assert found.num_rows <= 8 * n and np.asarray(found.column("more"))[8 * 20 :].all()
    assert found.num_rows > 7 * n


def test_lines_of_long_near_copies(spark):
    """Long lines near the threshold, equal to brute force, through every turn."""
    pick = random.Random(9)
    base = [f"b{k}" for k in range(300)]
    docs = []
    for doc in range(120):
        line = list(base)
        for k in pick.sample(range(300), pick.randint(10, 25)):
            line[k] = f"d{doc}w{k}"
        docs.append((doc, " ".join(line)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {row.doc_id: row.removed for row in line_dedup.report(frame).collect()}
    assert found == brute(docs)
    assert 0 < sum(map(len, found.values())) < 119


def test_lines_of_one_template_end_in_seconds(spark):
    """100,000 lines that differ in one word: all but the first repeat an earlier one."""
    rows = spark.range(100).selectExpr(
        "id AS doc_id",
        "array_join(transform(sequence(0, 999), k -> concat('page ', id * 1000 + k, ' of the spring catalogue with all its fine things')), '\n') AS text",
    )
    start = time.time()
    found = line_dedup.report(rows)
    assert sum(r.n_removed for r in found.collect()) == 99_999
    assert time.time() - start < 90


def test_rows_come_block_by_block():
    """A batch of several blocks of text gives a batch for each, so what a task holds does not grow with its batches."""
    pick = random.Random(2)
    texts = [" ".join(f"w{pick.randrange(10**6)}" for _ in range(150_000)) for _ in range(6)]
    columns = [pa.array(range(6), pa.int64()), pa.array(range(6), pa.int64()), pa.array(texts, pa.large_string())]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "version", "text"])
    steps = np.zeros(1 << 20, np.uint8)
    found = list(line_dedup._rows(80, steps)(batch))
    assert len(found) > 1 and all(isinstance(f, pa.RecordBatch) for f in found)
    one_by_one = [f for k in range(6) for f in line_dedup._rows(80, steps)(batch.slice(k, 1))]
    keys = ["word", "id", "line", "size", "place"]
    assert pa.Table.from_batches(found).sort_by([(k, "ascending") for k in keys]) == pa.Table.from_batches(one_by_one).sort_by([(k, "ascending") for k in keys])


def test_texts_pass_one_worker_on_their_way_to_comparisons(spark):
    """Texts are told apart and compressed by one Python step; then lines are cut out, and compared."""
    texts = line_dedup._texts(spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "x y z")], "doc_id long, text string"))
    pairs = spark.createDataFrame([(2, 0, 1, 0)], "id long, line int, of_id long, of_line int")
    found = line_dedup._verified(texts, pairs, 80)
    assert found._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 3
    assert [(r.id, r.line, r.of_id, r.of_line) for r in found.collect()] == [(2, 0, 1, 0)]


def test_strangers_of_a_hundred_words_are_told_apart_in_the_first_turn():
    """Sets of one language with a sixth in common: a bound of 64 bits let a twelfth of their pairs through."""
    rng = np.random.default_rng(8)
    sets = [set(rng.choice(400, 130, replace=False).tolist()) for _ in range(300)]
    lines = line_dedup.Lines(pa.array([" ".join(f"w{k}" for k in s) for s in sets], pa.large_string()))
    n, tallies = len(sets), lines.tallies()
    rows = {"word": np.zeros(n, np.int64), "id": np.arange(n), "line": np.zeros(n, np.int32), "size": lines.sizes.astype(np.int32)}
    rows |= {"place": np.zeros(n, np.int32), "tally": tallies[:, 0].view(np.int64), "version": tallies[:, 1].view(np.int64)}
    batch = pa.RecordBatch.from_pydict(rows)
    assert sum(found.num_rows for found in line_dedup._pairs([batch], 80, 1)) <= 3


def test_candidates_that_are_counted_are_not_held():
    """4,000 equal rows of one word: the earliest of each is found without 64 pairs a row in memory."""
    n = 4000
    rows = {"word": np.zeros(n, np.int64), "id": np.arange(n)[::-1].copy(), "line": np.zeros(n, np.int32), "size": np.full(n, 10, np.int32)}
    rows |= {name: np.zeros(n, np.int32) for name in ("place",)} | {name: np.zeros(n, np.uint64) for name in ("tally", "version")}
    tracemalloc.start()
    x, y, more = line_dedup._Group(rows, 80, 1).pairs()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(y) == n - 1 and (rows["id"][x] < rows["id"][y]).all() and more.sum() == n - 2
    assert peak < 2 << 20


def test_near_misses_do_not_pass_the_later_turns():
    """Lines of 30 words with 26 in common (similarity 76): none is sent to a comparison."""
    base = [f"x{k}" for k in range(26)]
    lines = line_dedup.Lines(pa.array([" ".join(base + [f"y{i}a{k}" for k in range(4)]) for i in range(200)], pa.large_string()))
    found = line_dedup.Parities(np.array(lines.parities(np.arange(200)).to_pylist(), dtype=object))
    x, y = np.triu_indices(200, 1)
    assert (180 * (60 - found.gap(x, y)) >= 160 * 60).mean() < 0.1


def test_marks_travel_small():
    """A filter of few words must not cost each stage that uses it 4 MB on every executor's disk."""
    words = line_dedup.scramble(np.arange(1000, dtype=np.uint64))
    marks = line_dedup.Marks()
    marks.add(words)
    raw = pickle.dumps(marks)
    assert len(raw) < 100_000
    assert (pickle.loads(raw).bits == marks.bits).all() and pickle.loads(raw).has(words).all()
