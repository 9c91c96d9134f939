import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from capplan.llm import packing
from capplan.llm.queries import QUERIES, tokenizer_file
from tests.test_oracle import SF


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_file())


def pieces_of(tokenizer, text, capacity=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    first = len(ids) - (len(ids) - 1) // capacity * capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [
        (k, s, e - s, zlib.crc32(np.array(ids[s:e], dtype="<u4").tobytes()))
        for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
    ]


def test_words_one_by_one_give_the_ids_of_the_text(tokenizer):
    pick = random.Random(1)
    signs = [" ", "  ", "\n", "\t", " ", "a", "B", "é", "1", "!", "'s", "<|endoftext|>", "中", "\x1c", "\x85", "😀", "\r\n", "don", "_"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 30))) for _ in range(5000)]
    encoder = packing.Encoder(tokenizer_file())
    for text, ids in zip(texts, encoder.texts(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_and_places_of_the_table(spark, tokenizer):
    rows = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    found, sequences = {}, {}
    for r in rows:
        found.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(found) == set(texts)
    for doc, text in texts.items():
        assert sorted(found[doc]) == pieces_of(tokenizer, text), doc
    for parts in sequences.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 2048
    total = sum(r.length for r in rows)
    assert len(sequences) <= -(-total // 2048) + 2


def test_many_shards_hold_every_piece_once(spark):
    pick = random.Random(2)
    data = [(i, pick.choice((1, 5, 700, 1024, 1500, 2048))) for i in range(3000)]
    pieces = spark.createDataFrame(data, "doc_id long, length long").repartition(7)
    rows = packing.pack(pieces, shard=500).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted(data)
    loads = {}
    for r in rows:
        loads[r.sequence_id] = loads.get(r.sequence_id, 0) + r.length
    assert max(loads.values()) <= 2048


def test_crossover_keeps_every_item_in_one_bin():
    random_ = np.random.default_rng(0)
    lengths = np.sort(random_.integers(1, 2049, 400))[::-1].astype(np.int64)
    first = packing.first_packings(lengths, 2048, random_, 3)
    for _ in range(20):
        child = first[0].crossed(first[1], random_)
        loads = child.loads()
        assert (child.bins >= 0).all() and loads.max() <= 2048 and loads.min() > 0
    best = packing.evolve(first, random_, 30)[0]
    assert best.score() <= first[-1].score()


def test_odd_input(spark, odd, none, tokenizer):
    rows = packing.pack(packing.token_pieces(odd, tokenizer_file())).collect()
    texts = sorted((str(r.doc_id), p) for r in odd.collect() for p in pieces_of(tokenizer, r.text))
    assert sorted((str(r.doc_id), (r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == texts
    assert all(len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack(packing.token_pieces(none, tokenizer_file())).count() == 0


def test_parts_of_plain_texts_are_those_of_the_rule():
    """Cut before each space that follows a character that isn't white space; white space at the end stays."""
    pick = random.Random(3)
    for _ in range(4000):
        text = "".join(pick.choices(" \t\n\x0b\x1c\x1fab.,\u00e9\u2003", k=pick.randint(0, 10)))
        found = packing._parts(text)
        assert " ".join(found) == text
        assert all(part and not part[-1].isspace() for part in found[:-1]) or not text.strip(), (text, found)
        if not re.search(r"\s( |$)|^ ", text) and not text[-1:].isspace() and text:
            assert found == text.split(" ")


def test_a_run_of_letters_is_encoded_once_whatever_follows_it(tokenizer, monkeypatch):
    pick = random.Random(4)
    cores, tails = ["was", "Erewhon", "theand", "café", "it's", "x1"], ["", ".", ",", "?!", "\nthe", " ", ")"]
    texts = [" ".join(pick.choice(cores) + pick.choice(tails) for _ in range(pick.randint(0, 12))) for _ in range(600)]
    monkeypatch.setattr(packing, "REMEMBERED", 2)  # forgotten again and again
    encoder = packing.Encoder(tokenizer_file())
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        for text, ids in zip(part, encoder.texts(part), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.undo()
    encoder, met = packing.Encoder(tokenizer_file()), []
    encoder.tokenize = lambda run, f=encoder.tokenize: met.append(run) or f(run)
    encoder.texts(["a theand theand. theand, theand) theand", "b theand: was"])
    assert sorted(met) == ["Ġtheand", "Ġwas"]
