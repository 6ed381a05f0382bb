"""Anchors, segments and transforms of op2 against plain Python: words for symbols, borders of chunks, short periods."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

from kerbside.llm import suffix_bwt

PERIODS = [b"a", b"ab", b"abcdefgh", bytes(range(97, 123))]


def _texts(rng):
    base = [bytes(rng.choice(rng.choice(PERIODS)) for _ in range(rng.randrange(120))) for _ in range(3)]
    base.append(rng.choice(PERIODS) * rng.randrange(90))

    def text():
        made = bytearray(rng.choice(base) + rng.choice(base) * rng.randrange(3))
        for _ in range(rng.randrange(3) if made else 0):
            made[rng.randrange(len(made))] = rng.choice(b"abcxyz")
        return bytes(made) if rng.random() > 0.1 else None

    return [[text() for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 3))]


def _found(blocks, length, gram, buckets=3):
    """For every block, for every byte of its texts, whether a string that starts there is found elsewhere too."""
    texts = [suffix_bwt.Bytes(SimpleNamespace(texts=t), length, gram) for t in blocks]
    times = Counter(k for t in texts for k in t.keys.tolist())
    asked, told = zip(*(suffix_bwt._segments(t, np.array([times[k] > 1 for k in t.keys.tolist()], bool), buckets) for t in texts))
    replies = [{} for _ in blocks]
    for bucket in {b for messages in asked for b, _ in messages}:
        to = [(k, m) for k, messages in enumerate(asked) for b, m in messages if b == bucket]
        for (k, _), reply in zip(to, suffix_bwt._tell_repeated(length)([m for _, m in to])):
            replies[k][bucket] = np.unpackbits(suffix_bwt.unpacked(reply, np.uint8))
    for text, (first, count, bit), reply in zip(texts, told, replies):
        hit = [False] * len(text.data)
        bits = np.concatenate([reply[b] for b in sorted(reply)]) if reply else []
        for a, n, at in zip(first.tolist(), count.tolist(), bit.tolist()):
            for k in range(n):
                hit[a + k] = bool(bits[at + k])
        yield hit


@pytest.mark.parametrize("chunk", [7, 64, 1 << 14])
def test_repeated_strings_of_blocks(monkeypatch, chunk):
    rng = random.Random(chunk)
    monkeypatch.setattr(suffix_bwt, "CHUNK", chunk, raising=False)
    for _ in range(150):
        blocks, length = _texts(rng), rng.choice([1, 5, 8, 9, 16, 33])
        seen = Counter(t[k : k + length] for texts in blocks for t in texts if t for k in range(len(t) - length + 1))
        for texts, hit in zip(blocks, _found(blocks, length, rng.randint(1, length))):
            want = [k <= len(t) - length and seen[t[k : k + length]] > 1 for t in texts if t for k in range(len(t))]
            assert hit == want


def test_repeated_starts_without_anchors():
    rng = random.Random(5)
    for _ in range(100):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(40))) for _ in range(rng.randint(1, 6))]
        twice, length = np.array([rng.random() < 0.2 for _ in strings]), rng.choice([1, 5, 8, 10])
        seen = Counter()
        for string, two in zip(strings, twice.tolist()):
            for k in range(len(string) - length + 1):
                seen[string[k : k + length]] += 1 + two
        for string, got in zip(strings, suffix_bwt.repeated_starts(strings, twice, length)):
            assert got.tolist() == [seen[string[k : k + length]] > 1 for k in range(len(string) - length + 1)]


def test_buckets_sort_words(monkeypatch):
    """What a round passes over, summed over the rounds: with bytes for symbols it was bytes times bytes of a segment."""
    rng, work, taken = random.Random(1), [], []
    merge, starts = np.searchsorted, suffix_bwt.repeated_starts

    def watched(keys, fresh, *more):
        work.append(len(keys))
        return merge(keys, fresh, *more)

    def kept(strings, *more):
        taken.extend(map(len, strings))
        return starts(strings, *more)

    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(2_000))
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(150)) + passage[k:-1 - k] + b"x" * k + passage[:700] for k in range(1, 12)]
    monkeypatch.setattr(suffix_bwt, "repeated_starts", kept)
    monkeypatch.setattr(np, "searchsorted", watched)
    hit = next(_found([texts], 200, 96, 1))
    assert sum(hit) > 20_000 and sum(taken) > 10_000
    assert sum(work) < sum(taken) * max(taken) / 32
    # Equal segments of a text of a short period are one, and are not looked at one by one.
    text = suffix_bwt.Bytes(SimpleNamespace(texts=[b"a" * 50_000]), 200, 96)
    assert len(text.keys) == 49_801
    assert len(set(suffix_bwt._alike(text.data, 200, text.keys, text.first, text.count).tolist())) == 1
