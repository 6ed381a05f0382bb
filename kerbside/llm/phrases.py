"""Phrase collocations by weighted acyclic automata over words.

A shard of documents becomes one automaton per language: a transducer that reads a phrase of up to three words and
gives its count. It is built from the shard's sorted phrases, prefixes shared as they come and states with equal
transitions registered as one (``Automaton``). Then

1. single words are summed over all shards; those seen often enough get numbers in the order of their bytes. No phrase with a
   rarer word can be a candidate, so transitions with other words are dropped;
2. shard automata are cut at prefix ranges and the parts of each range are united, equal phrases' weights summed, rare phrases
   pruned. Ranges are cut by a bounded sample of phrases, inside a frequent word or pair too; that moves work only;
3. each candidate of three words is composed with the ranges of its parts: the automaton that reads a part answers with its
   weight, and keeps for that part the largest candidate that holds it.

A candidate's score is ``a * a / (l * r)`` in millionths at its worst cut, in exact arithmetic. Candidates of two words that a longer
one with at least ``HELD`` hundredths of their count holds are left out.

A null text has no words, a null lang is ``und``, repeated rows and rows without an id count like any other. Ties in score go to
the larger count, then to the smaller phrase by UTF-8 bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.cells import boxed, led, rows_of, unboxed
from kerbside.llm.graph import stored
from kerbside.llm.text import bounded, mix, table, text_bytes

LEAST = 10
HELD = 50
TOP = 2000
UNIT = 1_000_000

SHARD_BYTES = 8 << 20
# Phrases of a prefix range, counted in the shards that hold them; ranges at most; phrases that cut the ranges.
RANGE_PHRASES = 2_000_000
MOST_RANGES = 4096
SAMPLE = 100_000
SAMPLE_OF_SHARD = 64

ENDS = b".,;:!?\n\x0b\x0c\r"
PIECES = bytes(10 if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
LOW_BITS = np.int64(0xFFFFFFFF)
SYMBOLS = ("place", "number", "total")


class Automaton:
    """Counts of phrases of one to three words, as transitions with weights.

    From the start, ``words[i]`` leads with weight ``totals[i]`` to the state whose transitions are ``second[first[i]:first[i + 1]]``.
    Transition ``j`` of those has weight ``pair_weight[j]`` (0: the phrase itself isn't held) and leads to state ``target[j]``, whose
    transitions are ``third[begin[s]:begin[s + 1]]`` with ``third_weight``.
    """

    def __init__(self, words, totals, first, second, pair_weight, target, begin, third, third_weight):
        self.words, self.totals, self.first, self.second, self.pair_weight = words, totals, first, second, pair_weight
        self.target, self.begin, self.third, self.third_weight = target, begin, third, third_weight

    @classmethod
    def of(cls, words, totals, pairs, thirds, weights) -> Automaton:
        """From sorted phrases: ``pairs`` are two words in one number, ``thirds`` the third word or -1, ``words`` all words' sorted ids."""
        new = np.r_[True, pairs[1:] != pairs[:-1]] if len(pairs) else np.zeros(0, bool)
        own = pairs[new]
        longer = thirds >= 0
        weight = np.zeros(len(own), np.int64)
        state = np.cumsum(new) - 1
        weight[state[~longer]] = weights[~longer]
        counts = np.bincount(state[longer], minlength=len(own))
        target, begin, third, third_weight = _registered(counts, thirds[longer], weights[longer])
        heads = own >> 32
        first = np.searchsorted(heads, np.r_[words, np.iinfo(np.int64).max])
        return cls(words, totals, first, own & LOW_BITS, weight, target, begin, third, third_weight)

    def pairs(self) -> np.ndarray:
        return np.repeat(self.words, np.diff(self.first)) << 32 | self.second

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All held phrases of two and three words in order: ``pairs, thirds, weights``."""
        pairs, sizes = self.pairs(), np.diff(self.begin)[self.target]
        at = np.repeat(self.begin[self.target] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        # Each pair stands before its longer phrases.
        place = np.arange(len(pairs)) + np.cumsum(sizes) - sizes
        out = np.ones(len(pairs) + len(at), bool)
        out[place] = False
        all_pairs = np.repeat(pairs, sizes + 1)
        thirds, weights = np.full(len(out), -1, np.int64), np.zeros(len(out), np.int64)
        thirds[out], weights[out] = self.third[at], self.third_weight[at]
        weights[place] = self.pair_weight
        held = weights > 0
        return all_pairs[held], thirds[held], weights[held]

    def total(self, words: np.ndarray) -> np.ndarray:
        return self.totals[np.searchsorted(self.words, words)]

    def place_of(self, pairs: np.ndarray) -> np.ndarray:
        """Where each pair's transition is; all are held."""
        return np.searchsorted(self.pairs(), pairs)

    def boxed(self) -> bytes:
        """With increments in place of sorted numbers and the smallest type for each array."""
        return boxed([_least(np.diff(a, prepend=a.dtype.type(0)) if k in (0, 2, 6) else a) for k, a in enumerate(self._arrays())])

    @classmethod
    def unboxed(cls, data: bytes) -> Automaton:
        arrays = [a.astype(np.int64) for a in unboxed(data)]
        return cls(*(np.cumsum(a) if k in (0, 2, 6) else a for k, a in enumerate(arrays)))

    def _arrays(self):
        return (self.words, self.totals, self.first, self.second, self.pair_weight, self.target, self.begin, self.third, self.third_weight)


def _least(array: np.ndarray) -> np.ndarray:
    top = array.max(initial=0)
    return array.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.int64) if top <= np.iinfo(k).max))


def _registered(counts: np.ndarray, symbols: np.ndarray, weights: np.ndarray):
    """States with equal transitions made one: ``target`` of each, and ``begin, symbols, weights`` of the distinct ones."""
    starts = np.cumsum(counts) - counts
    hashes = mix(symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(weights.astype(np.uint64)))
    sums = np.r_[np.uint64(0), np.cumsum(hashes, dtype=np.uint64)]
    _, own, target = np.unique(sums[starts + counts] - sums[starts] + counts.astype(np.uint64), return_index=True, return_inverse=True)
    alike, within = own[target], np.arange(len(symbols)) - np.repeat(starts, counts)
    if not (counts[alike] == counts).all():
        own = target = np.arange(len(counts))
    else:
        there = np.repeat(starts[alike], counts) + within
        if not ((symbols[there] == symbols) & (weights[there] == weights)).all():  # two sums met: leave all apart
            own = target = np.arange(len(counts))
    sizes = counts[own]
    at = np.repeat(starts[own] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    return target, np.r_[0, np.cumsum(sizes)].astype(np.int64), symbols[at], weights[at]


class _Numbers(dict):
    """Words numbered as they come; the empty word and the end of a piece have numbers of their own."""

    def __init__(self):
        super().__init__({b"": -2, b"\n": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 2
        return number


def shard_automaton(texts: list[bytes]) -> tuple[list[bytes], Automaton]:
    """The sorted words of ``texts`` and the automaton of their phrases, with words as places in that list."""
    numbers = _Numbers()
    split = b"\n".join(texts).translate(PIECES).replace(b"\n", b" \n ").split(b" ")
    seen = np.fromiter(map(numbers.__getitem__, split), np.int64, len(split))
    del split
    words = [w for w in numbers if w not in (b"", b"\n")]
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words) + 1, np.int64)
    rank[order], rank[-1] = np.arange(len(words)), -1
    seen = rank[seen[seen != -2]]
    totals = np.bincount(seen[seen >= 0], minlength=len(words))
    within = (seen[:-1] >= 0) & (seen[1:] >= 0)
    both = seen[:-1] << 32 | seen[1:] & LOW_BITS
    pairs, which, pair_counts = np.unique(both[within], return_inverse=True, return_counts=True)
    number = np.full(len(both) + 1, -1, np.int64)
    number[:-1][within] = which
    tail = within[:-1] & within[1:] if len(within) else within
    triples, counts = np.unique(number[: len(tail)][tail] << 32 | seen[2:][tail], return_counts=True)
    longer = triples >> 32
    # Pairs and triples in one order: each pair right before the triples that begin with it.
    place = np.r_[np.arange(len(pairs)) + np.searchsorted(longer, np.arange(len(pairs))), np.arange(len(triples)) + longer + 1]
    out = [np.empty(len(place), np.int64) for _ in range(3)]
    for column, a, b in zip(out, (pairs, np.full(len(pairs), -1), pair_counts), (pairs[longer], triples & LOW_BITS, counts)):
        column[place] = np.r_[a, b]
    return [words[k] for k in order], Automaton.of(np.arange(len(words)), totals, *out)


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES, lang: str = "lang", text: str = "text") -> DataFrame:
    """``shard, lang, words, counts, phrases, sample, data``: an automaton a row, of one language in one run of documents."""

    def rows(texts: dict[str, list[bytes]]):
        for lang_, own in texts.items():
            words, automaton = shard_automaton(own)
            pairs, thirds, _ = automaton.phrases()
            longer = np.flatnonzero(thirds >= 0)
            longer = longer[:: max(1, len(longer) // SAMPLE_OF_SHARD)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang_]), pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                 pa.array([automaton.totals.tolist()], pa.list_(pa.int64())), pa.array([len(pairs)], pa.int64()),
                 pa.array([boxed((pairs[longer], thirds[longer]))], pa.binary()), pa.array([automaton.boxed()], pa.binary())],
                ["lang", "words", "counts", "phrases", "sample", "data"])

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in bounded(batches, limit=shard_bytes):
            for lang_, text_ in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text"))):
                if text_:
                    held.setdefault(lang_, []).append(text_)
                    size += len(text_)
            if size >= shard_bytes:
                yield from rows(held)
                held, size = {}, 0
        yield from rows(held)

    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    made = texts.mapInArrow(run, "lang string, words array<string>, counts array<long>, phrases long, sample binary, data binary")
    return stored(made.select(F.monotonically_increasing_id().alias("shard"), "*"), "shards")


def frequent_words(parts: DataFrame, least: int) -> DataFrame:
    """``lang, word, total, number`` of the words seen ``least`` times, numbered in the order of language and bytes."""
    counted = parts.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", "w.words", "w.counts")
    often = counted.groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("total")).where(F.col("total") >= least)
    often = stored(often.repartitionByRange("lang", "word").sortWithinPartitions("lang", "word").select(
        F.monotonically_increasing_id().alias("place"), "*"), "words")
    part = F.shiftright("place", 33)
    # One row for each partition of the range sort.
    sizes = sorted((r.part, r.n) for r in often.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    spark = parts.sparkSession
    starts = spark.createDataFrame(starts, "part long, start long")
    return often.withColumn("part", part).join(starts, "part").select(
        "lang", "word", "total", (F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))


class Ranges:
    """Prefix ranges of phrases, cut at sorted ``(pair, third)`` bounds."""

    def __init__(self, pairs: np.ndarray, thirds: np.ndarray):
        self.pairs, self.thirds = pairs, thirds

    @classmethod
    def of(cls, sample: list[tuple[int, int]], ranges: int) -> Ranges:
        sample = sorted(sample)
        cuts = sorted({sample[len(sample) * k // ranges] for k in range(1, ranges)}) if sample else []
        return cls(*(np.array([c[k] for c in cuts], np.int64) for k in (0, 1)))

    def __call__(self, pairs: np.ndarray, thirds: np.ndarray) -> np.ndarray:
        """The number of bounds that are not above each phrase."""
        out, end = np.searchsorted(self.pairs, pairs, "left"), np.searchsorted(self.pairs, pairs, "right")
        inside = np.flatnonzero(out < end)  # pairs that are themselves cut
        for pair in np.unique(pairs[inside]):
            at = inside[pairs[inside] == pair]
            a, b = out[at[0]], end[at[0]]
            out[at] = a + np.searchsorted(self.thirds[a:b], thirds[at], "right")
        return out


def collocations(
    docs: DataFrame, least: int = LEAST, held: int = HELD, top: int = TOP, range_phrases: int = RANGE_PHRASES,
    shard_bytes: int = SHARD_BYTES, lang: str = "lang", text: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best ``top`` phrases."""
    parts = shards(docs, shard_bytes, lang, text)
    words = stored(frequent_words(parts, least), "numbers")
    placed = parts.select("shard", "lang", F.posexplode("words").alias("place", "word"))
    symbols = stored(placed.join(words, ["lang", "word"]).groupBy("shard").agg(
        F.collect_list(F.struct("place", "number", "total")).alias("s")).select("shard", "s.place", "s.number", "s.total"), "symbols")
    known = parts.join(symbols, "shard")

    size = parts.agg(F.sum("phrases").alias("phrases"), F.count("*").alias("shards")).first()
    ranges = int(max(1, min(MOST_RANGES, (size.phrases or 0) // range_phrases)))
    fraction = min(1.0, SAMPLE / SAMPLE_OF_SHARD / max(1, size.shards))
    sampled = known.where((F.xxhash64("shard") % 1_000_000 + 1_000_000) % 1_000_000 < int(fraction * 1_000_000))
    cut = Ranges.of([tuple(r) for r in sampled.select(*SYMBOLS, "sample").mapInArrow(_sampled, "pair long, third long").collect()], ranges)

    cells = max(1, ranges * 2)
    sent = known.select("lang", *SYMBOLS, "data").mapInArrow(_cut(cut), "cell string, data binary")
    united = stored(led(sent, sent.limit(0), cells, _united(least), "cell string, data binary"), "ranges")
    asked = united.mapInArrow(_asked(cut), "cell string, data binary")
    found = led(united, asked, cells, _composed(held),
                "lang string, pair long, third long, a long, cut int, l long, r long, score long, held boolean")
    found = stored(found, "candidates")

    worst = F.min(F.struct("score", "cut", "l", "r")).alias("w")
    longer = found.where("third >= 0").groupBy("lang", "pair", "third", "a").agg(worst).select("lang", "pair", "third", "a", "w.*")
    kept = longer.unionByName(found.where("third < 0 and not held").drop("held"))
    # All ties at the last place stay until their phrases can be compared.
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    kept = stored(kept.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= top), "best")
    names = [words.select("lang", F.col("number").alias(f"number{k}"), F.col("word").alias(f"word{k}")) for k in (1, 2, 3)]
    kept = kept.withColumn("number1", F.shiftright("pair", 32)).withColumn("number2", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    kept = kept.withColumn("number3", F.col("third"))
    for k, how in ((1, "inner"), (2, "inner"), (3, "left")):
        kept = kept.join(names[k - 1], ["lang", f"number{k}"], how)
    kept = kept.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3"))
    totals = parts.select("lang", F.expr("aggregate(counts, 0L, (s, x) -> s + x)").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _with_symbols(batches, *names: str) -> Iterator[tuple]:
    """Rows one at a time: the numbers and totals of the shard's words by place, then the named columns."""
    for batch in batches:
        for k in range(batch.num_rows):
            place, number, total = (batch.column(c)[k].values.to_numpy() for c in SYMBOLS)
            yield (place, number, total, *(batch.column(n)[k].as_py() for n in names))


def _by_place(place: np.ndarray, values: np.ndarray, words: int, rare: int) -> np.ndarray:
    out = np.full(words, rare, np.int64)
    out[place] = values
    return out


def _renumbered(pairs, thirds, number):
    """``pairs, thirds`` in the numbers of all shards, and which of them have only frequent words."""
    a, b, c = number[pairs >> 32], number[pairs & LOW_BITS], np.where(thirds < 0, -1, number[np.maximum(thirds, 0)])
    good = (a >= 0) & (b >= 0) & ((thirds < 0) | (c >= 0))
    return a << 32 | b & LOW_BITS, c, good


def _sampled(batches):
    for place, number, _, data in _with_symbols(batches, "sample"):
        pairs, thirds = unboxed(data)
        words = 1 + max(int(a.max(initial=0)) for a in (pairs >> 32, pairs & LOW_BITS, thirds, place))
        pairs, thirds, good = _renumbered(pairs, thirds, _by_place(place, number, words, -1))
        yield pa.RecordBatch.from_pydict({"pair": pairs[good], "third": thirds[good]})


def _row(cell: str, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([cell]), pa.array([data], pa.binary())], ["cell", "data"])


def _cut(ranges: Ranges):
    """Shard automata in common numbers, cut at the prefix ranges."""

    def run(batches):
        for place, number, total, lang, data in _with_symbols(batches, "lang", "data"):
            automaton = Automaton.unboxed(data)
            number, total = _by_place(place, number, len(automaton.words), -1), _by_place(place, total, len(automaton.words), 0)
            pairs, thirds, weights = automaton.phrases()
            del automaton
            pairs, thirds, good = _renumbered(pairs, thirds, number)
            pairs, thirds, weights = pairs[good], thirds[good], weights[good]
            at = ranges(pairs, thirds)
            heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
            known, totals = number[number >= 0], total[number >= 0]
            for a, b in zip(heads, [*heads[1:], len(at)]):
                p, t = pairs[a:b], thirds[a:b]
                words = np.unique(np.r_[p >> 32, p & LOW_BITS, t[t >= 0]])
                part = Automaton.of(words, totals[np.searchsorted(known, words)], p, t, weights[a:b])
                yield _row(f"{at[a]}:{lang}", part.boxed())

    return run


def _united(least: int):
    """The union of a cell's automata, with weights summed and rare phrases pruned."""

    def work(cell: str, parts: list[bytes], _: Iterator[bytes]):
        found = [Automaton.unboxed(d) for d in parts]
        pairs, thirds, weights = (np.concatenate(x) for x in zip(*(a.phrases() for a in found)))
        words, at = np.unique(np.concatenate([a.words for a in found]), return_index=True)
        totals = np.concatenate([a.totals for a in found])[at]
        del found
        order = np.lexsort((thirds, pairs))
        pairs, thirds, weights = pairs[order], thirds[order], weights[order]
        heads = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]) | (thirds[1:] != thirds[:-1])])
        weights = np.add.reduceat(weights, heads)
        pairs, thirds = pairs[heads], thirds[heads]
        often = weights >= least
        if often.any():
            yield _row(cell, Automaton.of(words, totals, pairs[often], thirds[often], weights[often]).boxed())

    return work


def _asked(ranges: Ranges):
    """Candidates of three words, sent to the ranges of their first two and their last two words."""

    def run(batches):
        for cell, data in rows_of(batches, "cell", "data"):
            lang, automaton = cell.split(":", 1)[1], Automaton.unboxed(data)
            pairs, thirds, weights = automaton.phrases()
            longer = thirds >= 0
            pairs, thirds, weights = pairs[longer], thirds[longer], weights[longer]
            ends = automaton.total(pairs >> 32), automaton.total(thirds)
            for cut, part, other in ((2, pairs, ends[1]), (1, (pairs & LOW_BITS) << 32 | thirds, ends[0])):
                at = ranges(part, np.full(len(part), -1))
                order = np.argsort(at, kind="stable")
                placed = at[order]
                heads = np.flatnonzero(np.r_[True, placed[1:] != placed[:-1]]) if len(at) else []
                for a, b in zip(heads, [*heads[1:], len(at)]):
                    own = order[a:b]
                    yield _row(f"{placed[a]}:{lang}", boxed((cut, part[own], pairs[own], thirds[own], weights[own], other[own])))

    return run


def scores(a: np.ndarray, l: np.ndarray, r: np.ndarray) -> np.ndarray:  # noqa: E741
    """``floor(UNIT * a * a / (l * r))``, exact."""
    if a.max(initial=0) < 3_000_000 and l.max(initial=0) < 3_000_000_000 and r.max(initial=0) < 3_000_000_000:
        return UNIT * a * a // (l * r)
    return np.array([UNIT * x * x // (y * z) for x, y, z in zip(a.tolist(), l.tolist(), r.tolist())], np.int64)


def _composed(held: int):
    """Answers for the parts of longer candidates; then the range's own candidates of two words, held in a longer one or not."""

    def rows(lang, pairs, thirds, a, cut, left, right, inside):
        for at in range(0, len(pairs), 50_000):
            k = slice(at, at + 50_000)
            n = len(pairs[k])
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * n, "pair": pairs[k], "third": thirds[k], "a": a[k], "cut": pa.array([cut] * n, pa.int32()), "l": left[k],
                "r": right[k], "score": scores(a[k], left[k], right[k]), "held": inside[k]})

    def work(cell: str, own: list[bytes], asked: Iterator[bytes]):
        lang, automaton = cell.split(":", 1)[1], Automaton.unboxed(own[0])
        known = automaton.pairs()
        most = np.zeros(len(known), np.int64)
        for data in asked:
            cut, part, pairs, thirds, a, other = unboxed(data)
            at = np.searchsorted(known, part)
            weight = automaton.pair_weight[at]
            np.maximum.at(most, at, a)
            left, right = (weight, other) if cut == 2 else (other, weight)
            yield from rows(lang, pairs, thirds, a, cut, left, right, np.zeros(len(a), bool))
        own_ = automaton.pair_weight > 0
        pairs, a = known[own_], automaton.pair_weight[own_]
        yield from rows(lang, pairs, np.full(len(pairs), -1), a, 1, automaton.total(pairs >> 32), automaton.total(pairs & LOW_BITS),
                        100 * most[own_] >= held * a)

    return work


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    """The best phrases of each language in all ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
    SELECT lang, unnest(w) AS phrase, 1 AS words FROM split
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM split
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM split
), f AS (
    SELECT lang, phrase, words, count(*) AS a FROM grams GROUP BY ALL
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= {LEAST}
), parts AS (
    SELECT lang, phrase, words, a, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
    FROM candidates, (SELECT unnest([1, 2]) AS k) WHERE k < words
), cuts AS (
    SELECT p.lang, p.phrase, p.a, p.k, x.a AS l, y.a AS r,
           CAST(({UNIT}::HUGEINT * p.a * p.a) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.head JOIN f y ON y.lang = p.lang AND y.phrase = p.tail
), worst AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), dropped AS (
    SELECT s.lang, s.phrase FROM candidates s
    JOIN (SELECT lang, a, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) AS inner_ FROM candidates WHERE words = 3) t
      ON t.lang = s.lang AND t.inner_ = s.phrase
    WHERE s.words = 2 AND 100 * t.a >= {HELD} * s.a
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst JOIN totals USING (lang) WHERE NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = worst.lang AND d.phrase = worst.phrase)
QUALIFY rank <= {TOP}
"""
