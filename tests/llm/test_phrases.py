"""Phrase mining against a plain count, and its automata on their own."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from kerbside.llm import phrases

SCHEMA = "doc_id long, text string, lang string, shard string, words int, counts string, cell string, place int, number int"


def _frame(spark, rows):
    return spark.createDataFrame([(k, t, g, "s", 1, "c", "x", 2, 3) for k, (t, g) in enumerate(rows)], SCHEMA).repartition(3)


def _plain(rows, least=10, held=50, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                for k in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[k : k + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= held * f[q]}
        rows_ = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def _rows(seed):
    rng = random.Random(seed)
    words = ["a", "b", "a\x01", "Ab", "é", "z\x00", "...", "q", "日本"]
    return [("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "\n", ", ", "  "]) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "de", None, ""])) for _ in range(60)]


EDGES = [(None, "en"), ("", None), (" \t ", "en"), ("one two three", None), ("one", "und")] + [("x y z", "en")] * 12


@pytest.mark.parametrize("rows,shard_bytes,range_phrases", [
    (_rows(1), 8 << 20, 2_000_000), (_rows(2), 200, 40), (_rows(3) + EDGES, 50, 10), (EDGES, 8 << 20, 1)])
def test_phrases(spark, rows, shard_bytes, range_phrases):
    got = phrases.collocations(_frame(spark, rows), shard_bytes=shard_bytes, range_phrases=range_phrases)
    assert sorted(map(tuple, got.collect())) == _plain(rows)


def test_ties_at_the_last_place(spark):
    rows = [(" , ".join(f"{w} {w}{w}" for w in "cabfed"), "en")] * 10
    got = phrases.collocations(_frame(spark, rows), top=3)
    assert sorted(map(tuple, got.collect())) == _plain(rows, top=3)


def test_empty_table(spark):
    got = phrases.collocations(_frame(spark, EDGES).limit(0))
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_automaton_reads_its_phrases_back():
    rng = np.random.default_rng(5)
    rows = sorted({(int(a) << 32 | int(b), int(c)) for a, b, c in zip(*rng.integers(0, 9, (2, 300)), rng.integers(-1, 9, 300))})
    pairs, thirds = (np.array([r[k] for r in rows], np.int64) for k in (0, 1))
    weights = np.where(thirds < 0, rng.integers(1, 9, len(rows)), 1)
    automaton = phrases.Automaton.of(np.arange(9), np.arange(9) + 50, pairs, thirds, weights)
    for a in (automaton, phrases.Automaton.unboxed(automaton.boxed())):
        assert all((x == y).all() for x, y in zip(a.phrases(), (pairs, thirds, weights)))
        assert a.total(np.array([3, 8])).tolist() == [53, 58]


def test_equal_states_are_one():
    # Every pair goes on with the same two words and weights: one state is enough for all.
    pairs = np.repeat(np.arange(20, dtype=np.int64) << 32 | 1, 2)
    automaton = phrases.Automaton.of(np.arange(20), np.ones(20, np.int64), pairs, np.tile([2, 3], 20), np.tile([7, 8], 20))
    assert len(automaton.begin) == 2 and automaton.third.tolist() == [2, 3] and len(automaton.target) == 20


def test_ranges_cut_inside_a_pair():
    ranges = phrases.Ranges.of([(5, k) for k in range(100)] + [(9, 1)], 4)
    at = ranges(np.array([4, 5, 5, 5, 5, 9]), np.array([7, -1, 10, 50, 99, 0]))
    assert at.tolist() == sorted(at.tolist()) and len(set(at[1:5].tolist())) > 2


def test_scores_past_64_bits():
    a, big = np.array([3, 10**12]), np.array([4, 10**12 + 7])
    assert phrases.scores(a, big, big).tolist() == [1_000_000 * 9 // 16, 10**30 // (10**12 + 7) ** 2]
