import random

import numpy as np
import pyarrow as pa

from capplan.llm import ngram_join
from capplan.llm.graph import components
from capplan.llm.sigtree import Tree, signatures


def sets_of(docs, n=3):
    out = {}
    for doc, text in docs:
        words = [w.encode().lower() for w in (text or "").split()]
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        out[doc] = grams or ({tuple(words)} if words else set())
    return out


def brute(docs, share=90):
    sets = sets_of(docs)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= share * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def documents(seed, n=150):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = []
    for doc in range(n):
        if docs and pick.random() < 0.6:
            words = pick.choice(docs)[1].split(" ")
            for _ in range(pick.choice((0, 1, 1, 2, 5))):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            words = words[: pick.choice((None, -1, -2))]
        else:
            words = [pick.choice(vocabulary) for _ in range(pick.choice((1, 2, 3, 20, 80, 120)))]
        docs.append((doc * 7 % 1000, " ".join(words)))
    return docs


def result(frame, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_documents(frame, **options).collect()}


def test_equals_brute_force(spark):
    docs = documents(1)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(frame) == brute(docs)


def test_families_dealt_into_blocks(spark, monkeypatch):
    docs = documents(2)
    monkeypatch.setattr(ngram_join, "HOT", 4)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(frame, block=3) == brute(docs)


def test_trees_find_what_all_pairs_find():
    random_ = np.random.default_rng(0)
    for _ in range(20):
        bases = [random_.integers(0, 2**63, 60).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(90):
            one = bases[random_.integers(4)].copy()
            k = random_.integers(0, 5)
            one[random_.integers(0, 60, k)] = random_.integers(0, 2**63, k).astype(np.uint64)
            sets.append(np.unique(one[: random_.integers(50, 61)]))
        sets.sort(key=len)
        tokens, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        roots = Tree(signatures(tokens, starts), sizes, tokens, starts).join(90).roots(0, len(sets))
        parent = list(range(len(sets)))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(len(sets)):
            for j in range(i + 1, len(sets)):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
        assert roots.tolist() == [find(i) for i in range(len(sets))]


def test_similar_sets_have_a_key_in_common():
    random_ = np.random.default_rng(1)
    for share in (90, 60, 100):
        for size in [*range(1, 45), 97, 124, 125, 300, 999]:
            a = np.unique(random_.integers(0, 2**64, size, dtype=np.uint64))
            for gone in range(size):
                for new in (0, gone, size * (100 - share) // share):
                    b = np.unique(np.concatenate([a[gone:], random_.integers(0, 2**64, new, dtype=np.uint64)]))
                    both = len(a) - gone
                    if 100 * both < share * (len(a) + len(b) - both) or np.array_equal(a, b):
                        continue
                    starts = np.array([0, len(a), len(a) + len(b)])
                    keys, bounds = ngram_join.part_keys(np.concatenate([a, b]), starts, share)
                    assert set(keys[: bounds[1]].tolist()) & set(keys[bounds[1] :].tolist()), (share, size, gone, new)
                if 100 * (size - gone) < share * size:
                    break


def test_strangers_with_a_rare_shingle_are_no_family(spark, monkeypatch):
    """Each text has its rarest shingles in common with its neighbours; only true near copies are compared at all."""
    pick = random.Random(7)
    texts = [pick.choices("abcdefghij", k=80) for _ in range(200)]
    for i in range(199):
        texts[i][50:55] = texts[i + 1][10:15] = ["a", "b", f"s{i}", "c", "d"]
    texts += [[*texts[i][:79], "end"] for i in range(0, 200, 20)]
    docs = [(i, " ".join(words)) for i, words in enumerate(texts)]
    asked, plain = [], ngram_join._asked

    def counted(members, share, block):
        asked.append(members.count())
        return plain(members, share, block)

    monkeypatch.setattr(ngram_join, "_asked", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = result(frame)
    assert {i: c for i, (_, c) in found.items() if i != c} == {200 + k: 20 * k for k in range(10)}
    assert asked == [20, 20]


def test_odd_input(spark, odd, none):
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(odd).collect()), key=str)
    assert found == sorted(
        [(1, 24, 1), (2, 24, 1), (2, 24, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 29998, 6), (7, 29999, 6), (8, 1, 8), (None, 1, None)],
        key=str,
    )
    assert ngram_join.link_documents(none).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, 5, 6, 8, None]


def test_one_row_of_a_component_stays_and_texts_of_an_id_are_told_apart(spark):
    def prose(doc, n=60):
        return " ".join(f"d{doc}w{i}" for i in range(n))

    near = prose("a") + " end"
    rows = [(1, prose("a")), (1, prose("a")), (1, near), (2, prose("a")), (2, prose("b")), (2, prose("b")), (3, prose("c"))]
    rows += [(4, prose("c")), (4, prose("d")), (5, prose("d")), (6, "")] + [(6, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((r.doc_id, r.text) for r in ngram_join.keep_one(frame).collect())
    one = [k for k in kept if k[0] == 1]
    assert len(one) == 1 and one[0][1] in (prose("a"), near)
    assert kept[1:] == [(2, prose("b")), (3, prose("c")), (4, prose("d")), (6, ""), (6, "")]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(5, i) for i in range(300, 360)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 181)} | {i: 5 for i in [5, *range(300, 360)]}


def test_shingles_of_short_and_missing_texts():
    tokens, starts = ngram_join.shingle_sets(pa.array(["a b", None, "", "A  B", "a b c a b c", "b a"]), 3)
    assert np.diff(starts).tolist() == [1, 0, 0, 1, 3, 1]
    assert tokens[0] == tokens[1] and tokens[0] != tokens[-1]
