"""Duplicate passages by relative Lempel-Ziv parsing against an index of all reference blocks.

The reference is the corpus itself, in blocks (``blocks.py``). A document is factored against all
text that documents with smaller ids hold, in whichever block it lies: at each word the parse
takes the earliest place where the next ``window`` words stand, and follows it word by word as
long as the text agrees. Factors of ``window`` words or more become duplicate spans. A greedy factor ends where its
source differs, and a passage may go on in another source there; so the words around each
factor's end are looked up as well, from every word whose window crosses it.

The index answers for windows that can be repeated at all:

1. Anchors: of the 7-word grams inside a window the one with the least hash. Equal windows have
   equal anchors. Blocks learn by a bit which of their anchors occur twice anywhere.
2. Windows whose anchor does are looked up in the index: their 64-bit hashes meet in buckets, with
   the earliest document and place of each block, and each block gets back where a window stood first.
3. Blocks parse their documents with these places and drop the words that factors cover.

Words are ``[^\\x20\\x09-\\x0D]+``, taken unchanged. Null texts have none. Repeated rows have one id,
which is not smaller than itself, so they are not duplicates of each other. Rows without an id are
neither sources nor parsed, and stay whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.blocks import (Block, _rows, _with_replies, answered, ask_shared, bucket_count, by_bucket, hear_shared,
                                 packed, sent, stored_blocks, tell_shared, unpacked)
from kerbside.llm.graph import stored
from kerbside.llm.text import WordHashes, free_name, gram_hashes, sha256, table

WINDOW = 13
ANCHOR = 7


class Words:
    """Words of a block's documents in one array of hashes, and the windows inside documents."""

    def __init__(self, block: Block, window: int, hashes: WordHashes):
        self.ids = block.ids
        # Only hashes stay: the words of a block take ten times the room of its text.
        parts = [hashes.array(t.split()) if t else np.empty(0, np.uint64) for t in block.texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.hashes = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        asks = np.array([i is not None for i in self.ids], bool)
        last = np.where(asks, sizes - window + 1, 0).clip(0)
        self.doc = np.repeat(np.arange(len(sizes)), last)
        self.start = np.arange(len(self.doc)) - np.repeat(np.cumsum(last) - last, last) + self.begins[self.doc]
        self.doc_id = np.array([i or 0 for i in self.ids], np.int64)

    def anchors(self, window: int, size: int) -> np.ndarray:
        """For each window the hash of its least gram of ``size`` words."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        grams = gram_hashes(self.hashes, size)
        least = grams
        width, wanted = 1, window - size + 1
        while width < wanted:  # minima of runs, by doubling
            step = min(width, wanted - width)
            least = np.minimum(least[: len(least) - step], least[step:])
            width += step
        return least[self.start]

    def places(self, anchors: np.ndarray) -> np.ndarray:
        """The anchors once for each stretch of windows that has them."""
        if not len(anchors):
            return anchors
        return anchors[np.r_[True, (anchors[1:] != anchors[:-1]) | (self.doc[1:] != self.doc[:-1])]]


def _index_messages(words: Words, keep: np.ndarray, window: int, buckets: int):
    """Distinct windows of a block with their first document and place, by bucket."""
    start, doc = words.start[keep], words.doc[keep]
    hashed = gram_hashes(words.hashes, window)[start] if len(start) else np.empty(0, np.uint64)
    doc_id, place = words.doc_id[doc], start - words.begins[doc]
    order = np.lexsort((place, doc_id, hashed))
    first = order[np.r_[True, hashed[order][1:] != hashed[order][:-1]]] if len(order) else order
    own = hashed[first]
    placed, parts = by_bucket(own, buckets)
    return own, doc_id[first], place[first], placed, parts


def _tell_first(messages: list[bytes]) -> list[bytes]:
    """For each window of each message where an earlier document has it: a bit, then id and place."""
    heads = [int.from_bytes(m[:4], "little") for m in messages]
    parts = [unpacked(m[4:], np.uint64).reshape(3, n) for m, n in zip(messages, heads)]
    hashed, doc_id, place = np.concatenate(parts, 1)
    doc_id, place = doc_id.view(np.int64), place.view(np.int64)
    order = np.lexsort((place, doc_id, hashed))
    head = np.r_[True, hashed[order][1:] != hashed[order][:-1]]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(head) - 1
    first = order[head][group]
    earlier = doc_id[first] < doc_id
    replies, at = [], 0
    for n in heads:
        bits, source = earlier[at : at + n], first[at : at + n]
        found = np.stack([doc_id[source[bits]], place[source[bits]]])
        replies.append(packed(np.packbits(bits)) + b"|" + packed(found) if bits.any() else b"")
        at += n
    return replies


def factors(doc_windows: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors ``(start, length, source document, source place)`` of one document.

    ``doc_windows`` are the word numbers where a window with an earlier source starts. A factor goes on
    while the next window follows in the same source.
    """
    if not len(doc_windows):
        return []
    follows = (np.diff(doc_windows) == 1) & (np.diff(source) == 0) & (np.diff(place) == 1)
    cut = np.flatnonzero(np.r_[True, ~follows])
    size = np.diff([*cut, len(doc_windows)])
    return [(int(doc_windows[c]), int(n) + window - 1, int(source[c]), int(place[c])) for c, n in zip(cut, size)]


def _parsed(words: Words, keep: np.ndarray, window: int, buckets: int, replies: dict[int, bytes]):
    """Per document its factors, from the places that the index gave for the block's windows."""
    own, first_id, first_place, placed, parts = _index_messages(words, keep, window, buckets)
    source, place = first_id.copy(), first_place.copy()  # the block's own first, or one before it
    for bucket, a, b in parts:
        reply = replies[bucket]
        if reply:
            size = _frame_size(reply)
            bits = np.unpackbits(unpacked(reply[:size], np.uint8), count=b - a) > 0
            found = unpacked(reply[size + 1 :], np.int64).reshape(2, -1)
            source[placed[a:b][bits]], place[placed[a:b][bits]] = found
    start, doc = words.start[keep], words.doc[keep]
    which = np.searchsorted(own, gram_hashes(words.hashes, window)[start]) if len(start) else np.empty(0, np.int64)
    earlier = source[which] < words.doc_id[doc]
    start, doc, which = start[earlier], doc[earlier], which[earlier]
    bounds = np.searchsorted(doc, np.arange(len(words.ids) + 1))
    for d, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        yield factors(start[a:b] - words.begins[d], source[which[a:b]], place[which[a:b]], window)


def _frame_size(reply: bytes) -> int:
    """Bytes of the first of two compressed parts, which a bar divides."""
    reader = zstandard.ZstdDecompressor().decompressobj()
    reader.decompress(reply)
    return len(reply) - len(reader.unused_data)


_SPANS = pa.struct([
    ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()),
    ("factors", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "source", "place")]))),
])
_SPANS_DDL = ("struct<n_words: bigint, n_removed: bigint, kept_sha256: string, kept: string, "
              "factors: array<struct<start: bigint, length: bigint, source: bigint, place: bigint>>>")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _spans_of(text: bytes | None, found: list[tuple[int, int, int, int]]) -> dict:
    words = text.split() if text else []
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, _, _ in found:
        cover[start] += 1
        cover[start + length] -= 1
    left = (np.cumsum(cover)[:-1] == 0).tolist()
    kept = text
    if found:
        kept = b"".join(w for w, k in zip(_WORD.findall(text), left) if k)
    return {
        "n_words": len(words), "n_removed": len(words) - sum(left),
        "kept_sha256": sha256(b" ".join(w for w, k in zip(words, left) if k)),
        "kept": None if kept is None else kept.decode(),
        "factors": [dict(zip(("start", "length", "source", "place"), f)) for f in found],
    }


def duplicate_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, into: str = "spans") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words, n_removed, kept_sha256, kept, factors``.

    ``kept`` is the text without the words that factors cover and the blanks after them; the hash is
    of the words kept, joined by single spaces. ``factors`` are structs ``start, length, source,
    place``: places and lengths in words, the source a doc_id. A column named ``into`` is replaced.
    """
    docs = docs.drop(into)
    blocks = stored_blocks(docs)
    buckets = bucket_count(blocks)
    hashes = WordHashes()  # each task fills a copy of its own

    def ask(block, _):
        words = Words(block, window, hashes)
        yield from ask_shared(words.places(words.anchors(window, anchor)), buckets)

    shared = stored(answered(sent(blocks, None, ask), tell_shared), "shared")

    def look_up(block, replies):
        words = Words(block, window, hashes)
        keep = hear_shared(words.anchors(window, anchor), buckets, replies)
        own, doc_id, place, placed, parts = _index_messages(words, keep, window, buckets)
        for bucket, a, b in parts:
            at = placed[a:b]
            message = np.stack([own[at], doc_id[at].view(np.uint64), place[at].view(np.uint64)])
            yield bucket, (b - a).to_bytes(4, "little") + packed(message)

    # The parse hears both answers; those about anchors come under negative bucket numbers.
    places = answered(sent(blocks, shared, look_up), _tell_first).unionByName(
        shared.withColumn("bucket", -1 - F.col("bucket")))

    def parse(batches):
        for _, row, replies in _rows(batches):
            block = Block.of_row(row)
            words = Words(block, window, hashes)
            about = {-1 - bucket: data for bucket, data in replies.items() if bucket < 0}
            keep = hear_shared(words.anchors(window, anchor), buckets, about)
            parsed = _parsed(words, keep, window, buckets, replies)
            found = [_spans_of(t, f) for t, f in zip(block.texts, parsed)]
            yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(found, _SPANS)], [*block.rows.schema.names, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return _with_replies(blocks, places).mapInArrow(parse, f"{schema}, `{into}` {_SPANS_DDL}")


def drop_duplicate_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the words of duplicate spans taken out of their texts, columns as they were."""
    into = free_name(docs, "spans")
    found = duplicate_spans(docs, window, into=into)
    return found.withColumn("text", F.col(f"{into}.kept")).select(*docs.columns)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = duplicate_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "spans.n_words", "spans.n_removed", "spans.kept_sha256")


SQL = r"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM t WHERE len(ws) >= 13)),
d AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS f FROM g) WHERE f < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM d),
r AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM c GROUP BY doc_id),
w AS (SELECT doc_id, p, ws[p] AS w FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM t)),
k AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS kept FROM w ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""
