"""Packing: patterns of histograms, ranks, and exact ids of the pieces."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from kerbside.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def _checked(histogram, size):
    """Padding of the packed histogram, each document lying in it once and sequences without gaps."""
    groups, tickets = packing.packs(histogram, size)
    places = packing.Places(packing.placements(groups, tickets, 3))
    sequences = {}
    for length, count in histogram.items():
        for rank in range(count):
            at = 0
            for start, taken, sequence, offset in sorted(places.of(length, rank)):
                assert start == at and taken > 0
                at += taken
                sequences.setdefault(sequence, []).append((offset, taken))
            assert at == length
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, taken in sorted(pieces):
            assert offset == at
            at += taken
        assert at <= size
        padding += size - at if at & (at - 1) else 0
    assert sorted(sequences) == list(range(3, 3 + len(sequences)))
    return padding


@pytest.mark.parametrize("seed", range(40))
def test_histograms(seed):
    rng = random.Random(seed)
    size = rng.choice([64, 256, 4096])
    histogram = Counter(rng.randint(1, size - 1) for _ in range(rng.randint(1, 300)))
    if seed % 2:
        histogram = {rng.randint(1, size - 1): rng.randint(1, 2000) for _ in range(rng.randint(1, 4))}
    padding = _checked(histogram, size)
    if not seed % 2 and size == 4096:
        assert padding <= size + 0.02 * sum(n * c for n, c in histogram.items())


@pytest.mark.parametrize("histogram", [{3000: 2000}, {2100: 5000, 3000: 1000}, {1: 10_000}, {4095: 100, 1: 3}, {2049: 1000}, {2048: 7}])
def test_hot_lengths(histogram):
    padding = _checked(histogram, 4096)
    assert padding <= 0.02 * sum(n * c for n, c in histogram.items())


def test_counts_do_not_change_the_work():
    groups, _ = packing.packs({3000: 10**12, 1000: 10**12, 7: 10**9}, 4096)
    assert len(groups) < 1000 and sum(g.count * sum(i[5] * i[1] for i in g.items) for g in groups) == 4000 * 10**12 + 7 * 10**9


def test_documents_one_by_one():
    """Before packs are closed, the histogram gives what packing one document at a time does: each to a pack with most room."""
    rng = random.Random(3)
    histogram = Counter(rng.randint(1, 255) for _ in range(400))
    rooms = []
    for length in sorted(histogram.elements(), reverse=True):
        best = max(range(len(rooms)), key=rooms.__getitem__, default=None)
        if best is None or rooms[best] < length:
            rooms.append(256 - length)
        else:
            rooms[best] -= length
    groups, _ = packing.packs(histogram, 256, least_room=256)
    assert sorted(g.room for g in groups for _ in range(g.count)) == sorted(rooms)


TEXTS = ["", None, "One two\tthree's\nfour  \x1c five six \x85seven", "a" * 300 + " b", "é é ǅ ΑΣ İ <|endoftext|> x<|startoftext|>", "日本語 テスト 👍🏽",
         " ".join(f"w{k}" for k in range(6000)), "\r\n  x"] + ["same text here"] * 200 + ["one", None]


def test_words_of_all_kinds():
    whole = Tokenizer.from_file(PATH)
    tokenizer = packing.WordTokenizer(PATH)
    rng = random.Random(8)
    plain = [chr(c) for c in (*range(33, 127), *range(0xA1, 0x100))]
    more = ["\u0130", "\u03a3", "\u0301", "\u00ad", "\u0085", "\u00a0", "\x1c", "'s", "'LL", "don't", "\u212a", "\ufb01", "\u4e2d", "\U0001f600"]
    texts = [" ".join("".join(rng.choice(plain if rng.random() < 0.9 else more) for _ in range(rng.randint(1, 12))) for _ in range(60)) for _ in range(200)]
    for _ in range(2):  # the second time from what is remembered
        for text, ids in zip(texts, tokenizer(pa.array(texts))):
            assert np.frombuffer(ids, tokenizer.kind).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_words_apart_give_the_ids_of_the_whole_text():
    whole = Tokenizer.from_file(PATH)
    tokenizer = packing.WordTokenizer(PATH)
    for text, ids in zip(TEXTS, tokenizer(pa.array(TEXTS))):
        assert np.frombuffer(ids, tokenizer.kind).tolist() == whole.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("size", [4096, 64])
def test_pieces(spark, size):
    rows = [(k, t, "p", 1, 2, 3) for k, t in enumerate(TEXTS)] + [(None, "no id", "p", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, rest int, n int, before int").repartition(4)
    pieces = packing.pack(docs, PATH, size=size).toPandas()
    whole = Tokenizer.from_file(PATH)
    for doc_id, text, *_ in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        own = pieces[pieces.doc_id.isna() if doc_id is None else pieces.doc_id == doc_id].sort_values("start")
        assert [x for p in own.ids for x in np.frombuffer(p, "<u4").tolist()] == ids
        assert set(own.doc_tokens) == {len(ids)} and own.start.tolist() == [0, *np.cumsum(own.ids.str.len() // 4)[:-1]]
    for _, own in pieces.groupby("sequence_id"):
        lengths = own.sort_values("offset").ids.str.len() // 4
        assert lengths.sum() <= size and own.offset.sort_values().tolist() == [0, *np.cumsum(lengths)[:-1]]
    assert sorted(pieces.sequence_id.unique()) == list(range(pieces.sequence_id.nunique()))
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_common_words_are_remembered_when_others_go(monkeypatch):
    monkeypatch.setattr(packing, "MOST_WORDS", 3)
    whole = Tokenizer.from_file(PATH)
    tokenizer = packing.WordTokenizer(PATH)
    learned = []
    inner = tokenizer._learn
    monkeypatch.setattr(tokenizer, "_learn", lambda new: learned.append(sorted(new)) or inner(new))
    for texts in (["the cat", "cat's sat."], ["the dog's", None, "the"], ["dog's the\nCat sat.", ""], ["the <|endoftext|>x"]):
        for text, ids in zip(texts, tokenizer(pa.array(texts, pa.string())), strict=True):
            assert np.frombuffer(ids, tokenizer.kind).tolist() == whole.encode(text or "", add_special_tokens=False).ids
    assert learned == [["cat", "cat's", "sat.", "the"], ["", "dog's"], ["Cat", "sat."], ["<|endoftext|>x"]]
    assert tokenizer(pa.array([], pa.string())) == [] and tokenizer(pa.array([None, ""], pa.string())) == [b"", b""]
