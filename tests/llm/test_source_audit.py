import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from capplan.llm import runs, source_audit

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, min_docs=3, top=200):
    unit = source_audit.UNIT
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall(lower(text))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def p(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + unit * (count[t] + 1) // (n + v) for t in kept}

        whole = p(sum((counts[lang, s] for s in sources), Counter()))
        ps = {s: p(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum((ps[s][t] - ps[o][t]) ** 2 // ps[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [
                (-((ps[s][t] - whole[t]) ** 2 // whole[t]), t.encode()) for t in kept if counts[lang, s][t] and ps[s][t] > whole[t]
            ]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -x, k + 1) for k, (x, i) in enumerate(items)]
    return sorted(out)


def corpus(n=150):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in "abcdÉ" for b in ["x", "é", "Yz", "漢"] for c in "klmno"]
    rows = []
    for i in range(n):
        source = f"s{rng.integers(7)}"
        shift = int(source[1]) * 3
        text = " ".join(words[(int(k) + shift) % len(words)] for k in rng.zipf(1.4, size=40) % len(words))
        rows.append((i, text + f" 12own{i}_x", ["en", "de", None][i % 3], source if i % 11 else None))
    return rows + [(900, "", "en", "empty"), (901, None, "xx", "a"), (902, "alone", "xx", "b"), (903, "", "yy", None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("options", [{}, {"shard": 7, "broadcast": 300, "groups": 2}])
def test_equals_brute_force(spark, options):
    rows = corpus()
    found = sorted(tuple(r) for r in source_audit.divergence(frame(spark, rows), **options).collect())
    expected = brute(rows)
    assert found == expected
    assert {r[2] for r in expected} == {"pair", "term"}


def test_ranks_end_where_they_are_told(spark):
    rows = corpus()
    found = sorted(tuple(r) for r in source_audit.divergence(frame(spark, rows), top=3, shard=11).collect())
    assert found == brute(rows, top=3)


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    rows = corpus()
    from types import SimpleNamespace

    shards = []
    terms = sorted({t for r in rows for t in TERM.findall(lower(r[1])) if (r[2] or "") == "en"})
    shards.append(dict(source_audit._shard(pa.table({"term": terms, "lang": ["en"] * len(terms), "shard": pa.array([0] * len(terms), pa.int32())})).to_pylist()[0]))
    lookup = SimpleNamespace(value=source_audit.Lookup(shards, {"en": 1}))
    some = [r for r in rows if r[2] == "en"]
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] for r in some]), pa.array([r[3] or "" for r in some]), pa.array([r[1] for r in some])], names=["lang", "source", "text"])

    def counted():
        out = Counter()
        for b in source_audit._counted(iter([batch, batch]), lookup):
            for r in b.to_pylist():
                for s, c in zip(source_audit._unpacked(r["slots"]), source_audit._unpacked(r["counts"]), strict=True):
                    out[r["source"], lookup.value.key(int(s)).decode()] += int(c)
        return out

    whole = counted()
    assert whole == {k: 2 * v for k, v in Counter((r[3] or "", t) for r in some for t in TERM.findall(lower(r[1]))).items()}
    monkeypatch.setattr(source_audit, "HELD", 10)
    assert counted() == whole


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash_is_minimal(keys):
    hashes = np.array(sorted(keys), dtype=np.uint64)
    seeds, slots = source_audit.perfect_hash(hashes)
    assert sorted(slots.tolist()) == list(range(len(hashes)))


def test_stored_keys_decide(monkeypatch):
    monkeypatch.setattr(runs.Words, "_hash", lambda self: (self.ends - self.starts).astype(np.uint64))
    terms = ["aa", "bb", "ccc", "dd"]
    shard = source_audit._shard(pa.table({"term": terms, "lang": ["l"] * 4, "shard": pa.array([0] * 4, pa.int32())})).to_pylist()
    lookup = source_audit.Lookup(shard, {"l": 1})
    asked = runs.Terms(pa.array(["bb aa ccc dd ee AA zzz bb"]))
    first, number = asked.distinct()
    found = lookup.find("l", asked, first)[number]
    assert [lookup.key(s).decode() if s >= 0 else None for s in found.tolist()] == ["bb", "aa", "ccc", "dd", None, "aa", None, "bb"]


def test_odd_input(spark, odd, none):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd.select("doc_id", "text", "lang", "source").collect()]
    assert sorted(tuple(r) for r in source_audit.divergence(odd, min_docs=2).collect()) == brute(rows, min_docs=2)
    assert source_audit.divergence(none).count() == 0


def test_equal_runs_are_told_by_bytes():
    """Whatever the hashes: the first of each different run, its bytes, and the text of every run."""
    texts = ["One two, one", "", "TWO \u00e9t\u00e9 one-three", None, "x"]
    terms = runs.Terms(pa.array(texts, pa.large_string()))
    terms.hashes[:] = np.arange(len(terms.hashes))
    first, number = terms.distinct()
    assert terms.pick(first).to_pylist() == [w.encode() for w in ("one", "two", "\u00e9t\u00e9", "three", "x")]
    assert number.tolist() == [0, 1, 0, 1, 2, 0, 3, 4] and terms.owners().tolist() == [0, 0, 0, 2, 2, 2, 2, 4]
