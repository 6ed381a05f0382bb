"""Packing token sequences: shortest pack first over the histogram of lengths.

Documents are tokenized once and stored with their ids. A document of more than ``size`` tokens gives whole sequences
and one rest; the rests are packed by their histogram alone, which has ``size`` entries at most whatever the
corpus holds (``packs``):

1. Lengths are placed longest first. Each goes to the shortest packs with room for it, as many at once as there are
   copies of a packing pattern; where none has room, new packs take as many of that length as fit. Only the counts of patterns
   change, so a step handles any number of documents.
2. Packs left with much room are closed: the shortest ones are poured into the rooms of others, cutting documents where a
   room ends. Rooms below a 64th of ``size`` stay padding. A last pack that no rooms can take becomes sequences of
   powers of two, which need no padding.

Patterns come back to documents by rank: within its length, a document's rank is its place among the equal lengths of its
partition plus those of the partitions before, so a length that a third of all documents have is numbered without
bringing them together. Ranks are looked up in the table of patterns, which is bounded by ``size`` as well.

A null text is empty, and an empty text is the end id alone. Repeated rows and rows without an id are documents of their own.
An empty table gives no pieces. Ids below 2^16 take two bytes in between.
"""

from __future__ import annotations

import bisect
import heapq
import os
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.graph import stored
from kerbside.llm.text import bounded, table

SIZE = 4096
END = 2
# Pourings at most; what is left then stays padding.
MOST_POURED = 20_000
# Words, and pieces, whose ids a worker remembers before it begins anew.
MOST_WORDS = 400_000

# --- fixed values: the tokenizer's own pieces of lower-cased text, its mark of a word's end, and characters that normal forms leave alone ---
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
PLAIN = regex.compile("[!-~\u00a1-\u00ac\u00ae-\u00ff]+")
# --- end of fixed values ---

_TOKENIZERS: dict = {}


class WordTokenizer:
    """Token ids of texts by a byte-pair tokenizer that drops white space and lower-cases, so that words can be tokenized apart.

    A word of plain characters (``PLAIN``) is cut into the tokenizer's own pieces, so that new words are mostly made of known pieces.
    Other words are left to the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor are its parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # The last token of a piece, and no other, carries the mark of a word's end.
        self.ends = np.array([(self.tokenizer.id_to_token(k) or "").endswith(WORD_END) for k in range(size)])
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.pieces: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordTokenizer:
        if path not in _TOKENIZERS:
            _TOKENIZERS.clear()
            _TOKENIZERS[path] = cls(path)
        return _TOKENIZERS[path]

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as bytes of ``kind``; a null text has none."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        names = words.dictionary.cast(pa.string())
        at = pc.index_in(names, self.words)
        if len(self.words) > MOST_WORDS:
            # Words of these texts are common, or needed at once; the others go.
            kept = at.drop_null()
            self.words, self.ids = self.words.take(kept), self.ids.take(kept)
            at = pc.index_in(names, self.words)
        if at.null_count:
            unknown = at.is_null()
            new = names.filter(unknown)
            ids = pa.array(self._learn(new.to_pylist()), pa.large_binary())
            places = pa.array(np.arange(len(self.words), len(self.words) + len(new), dtype=np.int32))
            at = pc.replace_with_mask(at, unknown, places)
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, ids])
        out = self.ids.take(at.take(words.indices))
        _, offsets, data = out.buffers()
        # Offsets of the words behind the last one of each text, in bytes.
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        cuts = np.frombuffer(offsets, np.int64)[out.offset + last].tolist() if len(out) else [0] * len(texts)
        raw = data.to_pybytes() if data is not None else b""
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn(self, new: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        whole, cut, odd = [], {}, []
        for word in new:
            if word.isascii() and word.isprintable() or PLAIN.fullmatch(word):
                if word.isalpha():
                    whole.append(word)
                elif "<|" in word:  # the text of a special token, perhaps
                    odd.append(word)
                else:
                    cut[word] = PIECES.findall(word.lower())
            else:
                odd.append(word)
        lowered = [*map(str.lower, whole)]
        wanted = {*lowered, *chain.from_iterable(cut.values())}
        if len(self.pieces) > MOST_WORDS:
            self.pieces = {p: self.pieces[p] for p in wanted if p in self.pieces}
        rest = list(wanted.difference(self.pieces))
        for at in range(0, len(rest), 5000):
            part = rest[at : at + 5000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            data = ids.astype(self.kind).tobytes()
            self.pieces.update(zip(part, map(data.__getitem__, map(slice, [0, *ends], ends))))
        piece = self.pieces.__getitem__
        found = dict(zip(whole, map(piece, lowered)))
        found.update((w, b"".join(map(piece, ps))) for w, ps in cut.items())
        found.update((w, np.array(e.ids, self.kind).tobytes()) for w, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)))
        return [*map(found.__getitem__, new)]


def tokens(docs: DataFrame, path: str, end: int = END, size: int = SIZE, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``part, doc_id, tokens, rest, place, fulls_before, ids`` of every document, stored.

    ``rest`` is what whole sequences leave of ``tokens``, ``place`` counts the documents of its part before it with that
    rest, and ``fulls_before`` their whole sequences.
    """

    def run(batches):
        tokenizer = WordTokenizer.of(path)
        last = np.array([end], tokenizer.kind).tobytes()
        places: Counter = Counter()
        fulls = 0
        for batch in bounded(batches):
            ids = [x + last for x in tokenizer(batch.column("text"))]
            counts = [len(x) // tokenizer.kind.itemsize for x in ids]
            rests, at, before = [n % size for n in counts], [], []
            for n, rest in zip(counts, rests):
                at.append(places[rest])
                before.append(fulls)
                places[rest] += 1
                fulls += n // size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (counts, rests, at, before)), pa.array(ids, pa.binary()),
                 pa.array([tokenizer.kind.itemsize] * len(ids), pa.int32())],
                ["doc_id", "tokens", "rest", "place", "fulls_before", "ids", "width"])

    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, tokens long, rest long, place long, fulls_before long, ids binary, width int")
    # The part is the task that wrote the row: fixed by the write, as the places are.
    return stored(rows.select(F.shiftright(F.monotonically_increasing_id(), 33).alias("part"), "*"), "tokens")


class Group:
    """``count`` packs of one pattern: ``items`` of ``(length, times, ticket, first, start, taken)``.

    A whole item stands ``times`` times and has no ticket. A cut one holds ``taken`` tokens from ``start`` of the documents
    ``first``, ``first + 1``, ... of its ticket, one for each pack.
    """

    def __init__(self, room: int, count: int, items: tuple):
        self.room, self.count, self.items = room, count, items

    def split(self, count: int) -> Group:
        """The first ``count`` packs; the others stay here."""
        taken = Group(self.room, count, self.items)
        self.count -= count
        self.items = tuple((a, b, t, f + count, s, n) if t is not None else (a, b, t, f, s, n) for a, b, t, f, s, n in self.items)
        return taken


def packs(histogram: dict[int, int], size: int = SIZE, least_room: int | None = None) -> tuple[list[Group], list[tuple[int, int]]]:
    """The patterns that hold ``histogram`` (documents by length), and the ``(length, count)`` of each ticket.

    Rooms below ``least_room``, a 64th of ``size`` unless given, stay padding.
    """
    least_room = least_room or max(1, size // 64)
    heap: list[tuple[int, int, Group]] = []
    order = 0

    def put(room, count, items):
        nonlocal order
        order += 1
        heapq.heappush(heap, (-room, order, Group(room, count, items)))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and heap and -heap[0][0] >= length:
            group = heap[0][2]
            count = min(left, group.count)
            if count == group.count:
                heapq.heappop(heap)
            group.count -= count
            put(group.room - length, count, _with(group.items, length))
            left -= count
        if left:
            fit = size // length
            for count, times in ((left // fit, fit), (1, left % fit)):
                if count and times:
                    put(size - length * times, count, ((length, times, None, 0, 0, length),))
    return _closed([g for _, _, g in sorted(heap, key=lambda h: h[:2])], size, least_room)


def _with(items: tuple, length: int) -> tuple:
    if items and items[-1][0] == length and items[-1][2] is None:
        return (*items[:-1], (length, items[-1][1] + 1, None, 0, 0, length))
    return (*items, (length, 1, None, 0, 0, length))


def _closed(groups: list[Group], size: int, least_room: int) -> tuple[list[Group], list[tuple[int, int]]]:
    """``groups``, by falling room, after pouring the shortest packs into the rooms of others."""
    tickets: list[tuple[int, int]] = []
    done = [g for g in groups if g.room < least_room]
    wide = [g for g in groups if g.room >= least_room]

    def poured(donor: Group, rooms: list[int]) -> list[list[tuple]]:
        """The donor's tokens cut along ``rooms``; whole documents that get cut are given a ticket."""
        out: list[list[tuple]] = [[]]
        left = rooms[0]
        for length, times, ticket, first, start, taken in donor.items:
            for _ in range(times):
                own, at, rest = ticket, start, taken
                while rest:
                    if not left:
                        out.append([])
                        left = rooms[len(out) - 1]
                    n = min(rest, left)
                    if own is None and n < length:
                        own = len(tickets)
                        tickets.append((length, donor.count))
                    out[-1].append((length, 1, own, first, at, n))
                    at, rest, left = at + n, rest - n, left - n
        return out

    for _ in range(MOST_POURED):
        if not wide or (len(wide) == 1 and wide[0].count == 1):
            break
        donor, need = wide[0], size - wide[0].room
        # Receivers by falling room, the donor's own like included: how many packs of each group one donor fills.
        uses: list[tuple[Group, int]] = []
        for group in wide:
            most = group.count - (group is donor)
            n = min(most, -(-need // group.room))
            if n > 0:
                uses.append((group, n))
                need -= n * group.room
            if need <= 0:
                break
        if need > 0:
            break
        count = min(donor.count // (1 + sum(n for g, n in uses if g is donor)), *(g.count // n for g, n in uses if g is not donor), donor.count)
        giver = donor.split(count)
        takers = [group.split(count) for group, n in uses for _ in range(n)]
        for taker, items in zip(takers, poured(giver, [t.room for t in takers])):
            taker.items = (*taker.items, *items)
            taker.room -= sum(i[5] for i in items)
        wide = [g for g in wide if g.count]
        for taker in takers:
            if taker.room < least_room:
                done.append(taker)
            else:
                bisect.insort(wide, taker, key=lambda g: -g.room)
    if wide and wide[0].count == 1:
        last = wide.pop(0)
        used = size - last.room
        powers = [1 << k for k in range(used.bit_length() - 1, -1, -1) if used >> k & 1]
        done += [Group(0, 1, tuple(items)) for items in poured(last, powers)]
    return done + wide, tickets


def placements(groups: list[Group], tickets: list[tuple[int, int]], first_sequence: int) -> dict[int, dict[str, np.ndarray]]:
    """For each length, by rank: ``begin`` of the ranks of an entry, and of its pieces ``times, sequence, start, taken, offset``.

    Entries of a length are sorted by ``begin``; an entry of a cut document has several rows. Lengths, patterns and so
    entries are bounded by the size of a sequence, not by the corpus.
    """
    rows: dict[int, list[tuple]] = {}
    ranks: Counter = Counter()
    begins = []
    for length, count in tickets:
        begins.append(ranks[length])
        ranks[length] += count
    sequence = first_sequence
    for group in groups:
        offset = 0
        for length, times, ticket, first, start, taken in group.items:
            if ticket is None:
                rows.setdefault(length, []).append((ranks[length], group.count * times, times, sequence, 0, length, offset))
                ranks[length] += group.count * times
            else:
                rows.setdefault(length, []).append((begins[ticket] + first, group.count, 1, sequence, start, taken, offset))
            offset += taken * times
        sequence += group.count
    names = ("begin", "count", "times", "sequence", "start", "taken", "offset")
    return {length: dict(zip(names, np.array(sorted(found), np.int64).T)) for length, found in rows.items()}


class Places:
    """Where the document of a rank goes: whole ones by binary search, cut ones among the ranges of tickets."""

    def __init__(self, entries: dict[int, dict[str, np.ndarray]]):
        self.whole, self.cut = {}, {}
        for length, e in entries.items():
            whole = (e["start"] == 0) & (e["taken"] == length)
            self.whole[length] = {k: v[whole] for k, v in e.items()}
            self.cut[length] = {k: v[~whole] for k, v in e.items()}

    def of(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """``start, taken, sequence, offset`` of each piece."""
        e = self.cut[length]
        pieces = np.flatnonzero((e["begin"] <= rank) & (rank < e["begin"] + e["count"]))
        for k in pieces:
            yield int(e["start"][k]), int(e["taken"][k]), int(e["sequence"][k] + rank - e["begin"][k]), int(e["offset"][k])
        if len(pieces):
            return
        e = self.whole[length]
        k = int(np.searchsorted(e["begin"], rank, "right")) - 1
        copy, within = divmod(rank - int(e["begin"][k]), int(e["times"][k]))
        yield 0, length, int(e["sequence"][k]) + copy, int(e["offset"][k]) + within * length


def pack(docs: DataFrame, path: str, end: int = END, size: int = SIZE, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, ids, doc_tokens, sequence_id, offset``: the pieces of all documents.

    ``ids`` are the piece's ids as unsigned 32-bit little-endian integers.
    """
    rows = tokens(docs, path, end, size, ident, text)
    counts = rows.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.expr(f"tokens div {size}")).alias("fulls"))
    # Whole sequences are numbered as one more length.
    counts = stored(counts.select("part", "rest", "n").unionByName(
        counts.groupBy("part").agg(F.sum("fulls").alias("n")).select("part", F.lit(size).cast("long").alias("rest"), "n")), "counts")
    histogram = {r.rest: r.n for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    whole = histogram.pop(size, 0)
    histogram.pop(0, None)
    groups, tickets = packs(histogram, size)
    places = Places(placements(groups, tickets, whole))

    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = before.where(F.col("rest") < size).select("part", "rest", "before").join(
        before.where(F.col("rest") == size).select("part", F.col("before").alias("fulls_part")), "part")

    def run(batches):
        for batch in batches:
            for part in bounded([batch], "ids"):
                out = []
                for r in part.to_pylist():
                    ids, n = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4"), r["tokens"]
                    fulls = n // size
                    for k in range(fulls):
                        out.append((r["doc_id"], k * size, ids[k * size : (k + 1) * size].tobytes(), n, r["fulls_part"] + r["fulls_before"] + k, 0))
                    if n % size:
                        for start, taken, sequence, offset in places.of(n % size, r["before"] + r["place"]):
                            start += fulls * size
                            out.append((r["doc_id"], start, ids[start : start + taken].tobytes(), n, sequence, offset))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

    return rows.join(starts, ["part", "rest"]).mapInArrow(
        run, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")


def op12_pack_sequences(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 4096 tokens, with a checksum of each piece's ids."""
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")
