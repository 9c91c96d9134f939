import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from capplan.llm import variants
from capplan.llm.runs import Latin
from tests.llm.test_source_audit import lower

WORD = re.compile("[A-Za-zÀ-ÿ]+")


def count(rows, min_length=7, min_count=2):
    found = Counter()
    for i, text in rows:
        for run in WORD.findall(lower(text)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= min_length and n >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, **options):
    n = count(rows, **options)
    out, forms = {}, {}
    for w in n:
        others = sorted((-n[o], o) for o in n if near(w, o))
        if others and -others[0][0] >= 10 * n[w]:
            forms[w] = others[0][1]
        out[w] = (n[w], len(others))
    roots = {}
    for w in n:
        root = w
        while root in forms:
            root = forms[root]
        roots[w] = root
    return sorted((w, *out[w], forms.get(w), n.get(forms.get(w)), roots[w]) for w in n)


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    letters = "abcdefgé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 10))) for _ in range(40)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = base[int(rng.random() ** 3 * len(base))]
            if rng.random() < 0.05:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "z" + w[k:], w[:k] + "Ü" + w[k + 1 :]])
            words.append(w.title() if rng.random() < 0.2 else w)
        rows.append((i if i % 17 else None, rng.choice([" ", "_", "÷ ", "\n9"]).join(words)))
    return rows + [(1000, None), (1001, ""), (1002, "a" * 3000 + " " + "a" * 3001), (1003, "a" * 3000 + " " + "a" * 3001)]


@pytest.mark.parametrize("cell", [1 << 16, 60, 5])
def test_equals_brute_force(spark, cell):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = variants.group_variants(frame, cell=cell)
    expected = brute(rows)
    assert sorted(tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()) == expected
    assert sum(r[3] is not None for r in expected) > 20


def test_roots_follow_forms_to_the_end(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(18)] + [("x", "w3")]
    found = dict(map(tuple, variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert set(found.values()) == {"w18"} and len(found) == 19


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=30, unique=True))
def test_the_search_reaches_all_near_words(words):
    letters = variants.Letters(words)
    counts = letters.counts(variants._FINE, variants.FINE)
    found = set()
    for i, j in variants.Trie(counts).search(counts, states=7):
        true = variants.one_apart(letters, i, letters, j)
        found |= {(words[a], words[b]) for a, b in zip(i[true].tolist(), j[true].tolist(), strict=True)}
    assert found == {(a, b) for a in words for b in words if near(a, b)}


def test_checksums():
    texts = ["é", "abc Öäz x", "y" * 300, ""]
    runs = Latin(pa.array(texts))
    raw = [runs.raw(k) for k in range(len(runs.starts))]
    assert [r.decode() for r in raw] == ["é", "abc", "Öäz", "x", "y" * 300]
    crc = variants._crc32(runs, np.arange(len(raw)))
    assert crc.tolist() == [zlib.crc32(r) for r in raw]
    heads = np.array([zlib.crc32(f"{k}:".encode()) for k in range(len(raw))], dtype=np.uint32)
    both = variants._followed(heads, crc, np.array([len(r) for r in raw]))
    assert both.tolist() == [zlib.crc32(f"{k}:".encode() + r) for k, r in enumerate(raw)]


def test_odd_input(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = variants.group_variants(odd, min_length=1)
    assert sorted(tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()) == brute(rows, min_length=1)
    assert variants.group_variants(none).count() == 0


def test_children_are_looked_up_without_a_search(monkeypatch):
    """The same pairs with tables of children and by searches, which tables do without."""
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("abcdefgh"), rng.integers(7, 10))) for _ in range(3000)})
    letters = variants.Letters(words)
    counts = letters.counts(variants._FINE, variants.FINE)

    def found(trie):
        return {(int(i), int(j)) for x, y in trie.search(counts, 500) for i, j in zip(x, y, strict=True)}

    tables = variants.Trie(counts)
    with monkeypatch.context() as patch:
        patch.setattr(variants, "CHILDREN", 0)
        searched = variants.Trie(counts)
    wanted = found(searched)
    assert all(c is None for c in searched.children) and len(wanted) > len(words)
    monkeypatch.setattr(variants.np, "searchsorted", None)
    assert found(tables) == wanted
