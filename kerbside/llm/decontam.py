"""Benchmark decontamination: binary search of benchmark suffixes in training suffix arrays.

A shard is a bounded run of whole training documents. Each shard sorts the suffixes of its
word sequence into a suffix array, ordered as deep as a match has to be long; every suffix of
every benchmark text is then looked up by binary search, which gives the range of training
positions that share its first words. Ranges as deep as a window are verbatim matches. Those of following
suffixes of one benchmark text at following positions are one longer match, so what comes out for each item are its longest matches,
with their places in the document and in the item. Documents are whole inside a shard, so nothing
is shuffled and a passage that every document quotes costs no more than its own occurrences.

Words follow ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Benchmark words
are numbered; a training word that no benchmark text has is 0, where no match can begin or
pass. Benchmark texts travel to the tasks in blocks of at most ``BLOCK_BYTES`` and one pass
over the documents serves one block, so no broadcast grows with the benchmark.

Null or wordless texts have no words, hit nothing and are hit by nothing. Repeated documents
are separate rows; repeated benchmark texts and repeated item ids count by distinct item id;
items without an id are ignored. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.text import LOWER, bounded, free_name, table, text_bytes

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20

# Everything but digits, letters and bytes of non-ASCII characters separates words.
_WORDS = bytes(LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


class TestSuffixes:
    """Numbered words, windows and suffixes of one block of benchmark texts."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        texts = [(item, words_of(text)) for item, text in items]
        for _, words in texts:
            for word in words:
                self.ids.setdefault(word, len(self.ids) + 1)
        self.bits = max(1, len(self.ids).bit_length())
        self.per_key = max(1, min(window, 62 // self.bits))
        self.n_keys = -(-window // self.per_key)
        windows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for text, (_, words) in enumerate(texts):
            numbers = [self.ids[w] for w in words]
            for at in range(max(1, len(numbers) - window + 1) if numbers else 0):
                windows.setdefault(tuple(numbers[at : at + window]), []).append((text, at))
        self.length = np.array([len(w) for w in windows], np.int64)
        self.item_of = [item for item, _ in texts]
        # Where each window stands: texts and places in them, those of window w from ``begin[w]`` on.
        places = np.array([p for found in windows.values() for p in found], np.int64).reshape(-1, 2)
        self.text, self.place = places[:, 0], places[:, 1]
        self.begin = np.cumsum([0, *map(len, windows.values())])
        padded = np.zeros((len(windows), self.per_key * self.n_keys), np.int64)
        for row, w in enumerate(windows):
            padded[row, : len(w)] = w
        self.low = self.keys_of_rows(padded)
        # A shorter window ends where any word may follow.
        top = (1 << self.bits) - 1
        free = np.arange(padded.shape[1])[None, :] >= self.length[:, None]
        self.high = self.keys_of_rows(np.where(free, top, padded))

    def keys_of_rows(self, padded: np.ndarray) -> list[np.ndarray]:
        keys = []
        for k in range(self.n_keys):
            key = np.zeros(len(padded), np.int64)
            for j in range(self.per_key):
                key = (key << self.bits) | padded[:, k * self.per_key + j]
            keys.append(key)
        return keys


class SuffixArray:
    """Word positions of a shard ordered by the words from there on, ``window`` words deep."""

    def __init__(self, numbers: np.ndarray, tests: TestSuffixes):
        depth = tests.per_key * tests.n_keys
        padded = np.concatenate([numbers, np.zeros(depth, np.int64)])
        key = np.zeros(len(numbers) + depth - tests.per_key + 1, np.int64)
        for j in range(tests.per_key):
            key <<= tests.bits
            key |= padded[j : j + len(key)]
        starts = np.flatnonzero(numbers)
        keys = [key[starts + k * tests.per_key] for k in range(tests.n_keys)]
        order = np.lexsort(keys[::-1]) if len(starts) else np.empty(0, np.int64)
        self.positions = starts[order]
        self.keys = [k[order] for k in keys]

    def bound(self, wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """For each wanted key the first place whose key is not below it, or is above it."""
        low = np.zeros(len(wanted[0]), np.int64)
        high = np.full(len(wanted[0]), len(self.positions), np.int64)
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, 0)
            below, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
            for own, key in zip(self.keys, wanted):
                found = own[middle]
                below |= equal & (found < key)
                equal &= found == key
            right = open_ & (below | equal if after else below)
            low, high = np.where(right, middle + 1, low), np.where(open_ & ~right, middle, high)
        return low

    def matches(self, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
        """Every (training position, window number) where a benchmark window stands verbatim."""
        if not len(self.positions) or not len(tests.length):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first, last = self.bound(tests.low, False), self.bound(tests.high, True)
        count = last - first
        which = np.repeat(np.arange(len(count)), count)
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return self.positions[place], which


def longest_matches(position: np.ndarray, which: np.ndarray, tests: TestSuffixes) -> np.ndarray:
    """Rows ``start, length, text, place`` of the matches that no match of the same text contains on the same course.

    Windows at following positions that stand at following places of a text are one match. Of those that begin at
    one position in one text, the longest stays.
    """
    count = np.diff(tests.begin)[which]
    at = np.repeat(tests.begin[which] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    start, text, place = np.repeat(position, count), tests.text[at], tests.place[at]
    order = np.lexsort((start, start - place, text))
    start, text, place, length = start[order], text[order], place[order], np.repeat(tests.length[which], count)[order]
    head = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(start - place) != 0) | (np.diff(start) != 1)]) if len(start) else np.empty(0, np.int64)
    last = np.r_[head[1:], len(start)] - 1 if len(head) else head
    length = length[head] + start[last] - start[head]
    start, text, place = start[head], text[head], place[head]
    order = np.lexsort((place, -length, text, start))
    first = np.r_[True, (np.diff(start[order]) != 0) | (np.diff(text[order]) != 0)] if len(order) else np.empty(0, bool)
    return np.stack([start, length, text, place], 1)[order][first]


def _search_shard(texts: list[bytes | None], tests: TestSuffixes):
    """Per document: word count, matched runs [start, end) of word numbers, matched items and their longest matches."""
    get = tests.ids.get
    parts, sizes = [], []
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))  # no match passes a document's end
        sizes.append(len(words))
    numbers = np.concatenate(parts) if parts else np.empty(0, np.int64)
    begins = np.cumsum([0, *(n + 1 for n in sizes)])
    position, which = SuffixArray(numbers, tests).matches(tests)
    cover = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(cover, position, 1)
    np.add.at(cover, position + tests.length[which], -1)
    hit = (np.cumsum(cover) > 0).astype(np.int8)
    edge = np.diff(hit, prepend=0)
    starts, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    owner = np.searchsorted(begins, starts, "right") - 1
    runs: list[list[tuple[int, int]]] = [[] for _ in sizes]
    for d, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist()):
        runs[d].append((a - int(begins[d]), b - int(begins[d])))
    matches: list[list[dict]] = [[] for _ in sizes]
    for start, length, text, place in longest_matches(position, which, tests).tolist():
        d = int(np.searchsorted(begins, start, "right")) - 1
        matches[d].append({"item": tests.item_of[text], "start": start - int(begins[d]), "length": length, "item_start": place})
    return sizes, runs, [{m["item"] for m in found} for found in matches], matches


def _merge(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = pa.struct([
    ("n_words", pa.int64()),
    ("starts", pa.list_(pa.int64())),
    ("ends", pa.list_(pa.int64())),
    ("items", pa.list_(pa.string())),
    ("matches", pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("item_start", pa.int64())]))),
])
_FOUND_DDL = ("struct<n_words: bigint, starts: array<bigint>, ends: array<bigint>, items: array<string>, "
              "matches: array<struct<item: string, start: bigint, length: bigint, item_start: bigint>>>")


def _item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Benchmark texts block by block; the driver holds one block of bounded size at a time."""
    rows = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row.item, bytes(row.text)))
        size += len(row.text)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES, into: str = "found") -> DataFrame:
    """``docs`` with a struct column ``into``: word count, matched word runs, matched items and longest matches.

    ``starts[i]`` to ``ends[i]``, end exclusive and counted in words, are the runs that matches of any item cover together;
    ``matches`` are each item's longest ones, ``start`` and ``length`` in the document's words and ``item_start`` in the item's.
    A column of that name is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(into)
    out, schema = docs, _schema_with(docs, into)
    for number, block in enumerate(chain(_item_blocks(benchmark, block_bytes), [None])):
        if block or not number:
            shared = spark.sparkContext.broadcast(block or [])
            out = out.mapInArrow(_search_task(shared, window, into, number > 0), schema)
    return out


def _schema_with(docs: DataFrame, into: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return ", ".join([*fields, f"`{into}` {_FOUND_DDL}"])


def _search_task(shared, window: int, into: str, later: bool):
    """The pass over the documents for one block; a ``later`` one adds to what earlier ones have found."""

    def run(batches):
        tests = TestSuffixes(shared.value, window)
        for batch in bounded(batches, limit=SHARD_BYTES):
            sizes, runs, items, matches = _search_shard(text_bytes(batch.column("text")), tests)
            names = batch.schema.names
            if later:
                before = batch.column(into).to_pylist()
                runs = [_merge([*zip(o["starts"], o["ends"]), *r]) for o, r in zip(before, runs)]
                items = [{*o["items"], *i} for o, i in zip(before, items)]
                matches = [o["matches"] + m for o, m in zip(before, matches)]
            found = pa.array([
                {"n_words": n, "starts": [a for a, _ in r], "ends": [b for _, b in r], "items": sorted(i),
                 "matches": sorted(m, key=lambda x: (x["start"], x["item"], -x["length"]))}
                for n, r, i, m in zip(sizes, runs, items, matches)
            ], _FOUND)
            kept = [c for n, c in zip(names, batch.columns) if n != into]
            yield pa.RecordBatch.from_arrays([*kept, found], [n for n in names if n != into] + [into])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, columns as they were."""
    into = free_name(docs, "found")
    return match_benchmark(docs, benchmark, window, into=into).where(F.size(f"{into}.starts") == 0).select(*docs.columns)


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = match_benchmark(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate(F.arrays_zip("found.starts", "found.ends"), F.lit(0).cast("long"),
                      lambda s, x: s + x["ends"] - x["starts"])
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("found.items")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + 9], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
m AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
       FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""
