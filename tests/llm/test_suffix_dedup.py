import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from capplan.llm import suffix_dedup
from capplan.llm.common import table
from tests.llm.conftest import SF


def brute(rows, length):
    """Per (id, text): removed runs, by a dictionary of all strings."""
    texts = sorted({(float("inf") if i is None else i, t or "") for i, t in rows})
    seen, out = set(), {}
    for i, text in texts:
        raw = text.encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - length + 1):
            string = raw[p : p + length]
            if string in seen:
                gone[p : p + length] = True
            seen.add(string)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[:-1], [False]]).astype(int)))
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out[i, text] = (kept, list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
    return out


def check(spark, rows, length, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.remove_repeats(frame, length, **options).collect()
    expected = brute(rows, length)
    got = sorted(((r.doc_id is None, r.doc_id or 0), bytes(r.kept), [(s.start, s.stop) for s in r.spans]) for r in found)
    want = sorted(((i is None, i or 0), *expected[float("inf") if i is None else i, t or ""]) for i, t in rows)
    assert got == want


def family(seed, n, alphabet="ab é"):
    """Texts that are copies with edits of one another, with a passage that all hold."""
    rng = random.Random(seed)
    common = "".join(rng.choice(alphabet) for _ in range(60))
    base = "".join(rng.choice("abcdefgh ij\n") for _ in range(400))
    rows = []
    for i in range(n):
        text = list(base[rng.randrange(100) :])
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = rng.choice(["", "x", "yy", "é"])
        at = rng.randrange(len(text))
        own = "".join(rng.choice("klmnop") for _ in range(rng.randrange(80)))
        rows.append((i * 3 % n, "".join(text[:at]) + own + common + own[::-1] + "".join(text[at:])))
    return [(i, t) for i, t in dict(rows).items()]


@pytest.mark.parametrize("hot", [1 << 14, 4])
@pytest.mark.parametrize("length", [10, 25])
def test_equals_a_dictionary_of_all_strings(spark, length, hot):
    check(spark, family(length, 60), length, hot=hot)


def test_periodic_texts(spark):
    rows = [(1, "ab" * 100), (2, "a" * 150), (3, "ba" * 30 + "a" * 40), (4, "abc" * 50), (5, "a" * 19), (6, "a" * 20)]
    check(spark, rows, 20)
    check(spark, rows, 20, hot=1)


def test_chunks_do_not_show(spark, monkeypatch):
    rows = [(0, "".join(t for _, t in family(3, 8))), *[(i + 1, t) for i, t in family(4, 5)]]
    texts = pa.array([t for _, t in rows])
    raw, edges = suffix_dedup._bytes(texts)

    def windows():
        out = {}
        for doc, at, left, owned, grams, _ in suffix_dedup.anchors(raw, edges, 20):
            for d, a, b, k, g in zip(doc, at, left, owned, grams, strict=True):
                for j in range(k):
                    out[int(d), int(a - b + j)] = (int(a), int(g))
        return out

    whole = windows()
    monkeypatch.setattr(suffix_dedup, "CHUNK", 37)
    assert windows() == whole
    assert len(whole) == sum(max(0, len(t.encode()) - 19) for _, t in rows)


def test_odd_input(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = {(r.doc_id, bytes(r.kept)): len(r.spans) for r in suffix_dedup.remove_repeats(odd).collect()}
    expected = brute(rows, 100)
    assert len(got) == len({(i, t or "") for i, t in rows})
    for i, t in rows:
        kept, spans = expected[float("inf") if i is None else i, t or ""]
        assert got[i, kept] == len(spans)
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [1 << 14, 2])
def test_repeated_rows_do_not_remove_each_other(spark, hot):
    rows = [*family(5, 20), *family(6, 20)[:3]]
    rows = [r for r in rows if r[0] not in (3, 6)] + [(30, "q" * 30)] * 2 + [(31, "zq" * 20 + "k")] * 3
    once = {(i, t) for i, t in rows}
    rows = [r for r in rows if sum(i == r[0] for i, _ in once) == 1]
    check(spark, rows * 2, 12, hot=hot)


def test_rows_of_one_id_with_two_texts(spark):
    rows = [(1, "x" * 30 + "abcdefghijklmnop"), (1, "abcdefghijklmnop" + "y" * 5), (2, "abcdefghijklmnop")]
    found = {(r.doc_id, r.n_bytes): bytes(r.kept) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()}
    assert found[2, 16] == b""
    assert sum(b"abcdefghijklmnop" in kept for kept in found.values()) == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(min_size=6, max_size=20).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=12))
def test_sort_of_suffixes(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    suffixes = np.arange(len(data) - 5)
    sorter = suffix_dedup._Sorter(data, 6)
    order = sorter.sorted(suffixes, np.array([0]), np.array([len(suffixes)]))
    assert order.tolist() == sorted(suffixes.tolist(), key=lambda p: (data[p : p + 6].tobytes(), p))


def test_a_collision_is_sorted_by_bytes(monkeypatch):
    data = np.frombuffer(b"abcabdabcabd", np.uint8)
    sorter = suffix_dedup._Sorter(data, 3)
    monkeypatch.setattr(sorter.hashes, "of", lambda s, e: np.zeros(len(s), np.uint64))
    order = sorter.sorted(np.array([0, 3, 6, 9]), np.array([0]), np.array([4]))
    same = sorter.equal_before(order, np.array([0]), np.array([4]))
    assert order.tolist() == [0, 6, 3, 9] and same.tolist() == [False, True, False, True]


def test_whole_table(spark):
    documents = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    expected = brute(rows, 100)
    found = suffix_dedup.remove_repeats(documents).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert (bytes(r.kept), [(s.start, s.stop) for s in r.spans]) == expected[r.doc_id, texts[r.doc_id] or ""]
