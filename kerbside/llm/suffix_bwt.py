"""Repeated byte strings by a multi-document Burrows-Wheeler transform, built column by column.

A collection's transform grows by one symbol of every string in each round, from the last symbol to the
first, and the array of common prefixes with it (``collection_bwt``). In the end suffixes that
share ``length`` bytes stand side by side, and their common prefixes say so. The published method keeps both arrays in
files that each round reads and writes from front to end; rounds are as many as the longest
string has bytes. Here strings are short and a collection is bounded, so the two arrays are held in memory and
each round still passes over them once, in order.

Whole documents as strings would need a round per byte of the longest one, each over the whole
table. So documents are cut, without losing a match:

1. Anchors: of the 96-byte grams inside each ``length``-byte string the first with the least hash. Equal
   strings have equal anchors at equal places. Blocks of documents (``blocks.py``) learn by a bit which of their anchors stand at two
   places or more; strings around other anchors are unique.
2. The strings around one place of an anchor overlap to one segment, of a start for each place of the anchor in them at most. Segments of
   shared anchors go to the anchor's bucket, each distinct one once for each block, with the word whether it stood there twice.
3. A bucket builds the transform of its distinct segments. Symbols are words of ``WORD`` bytes counted from the anchor, so that equal strings
   are cut into equal words: rounds and arrays are an eighth each of what they are with bytes. Segments that are alone around
   their anchor are left out; all their strings stand twice if they do as a whole, and none otherwise.
4. Buckets of more than ``BUCKET_MOST`` bytes (a passage of very many documents in different surroundings has
   a segment for each around one anchor) are not sorted in one place. Their strings are dealt anew, each by its own hash of
   128 bits and each distinct one once for each block; strings with equal hashes count as equal.
5. Blocks learn by a bit which strings start elsewhere too, and remove the bytes they cover.

Texts are UTF-8 bytes; cuts may fall inside a character, and ``kept`` is binary for that reason. Null and empty
texts have no bytes. Repeated rows repeat each other's strings, whatever their ids; no id is used.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.blocks import (BUCKET_TEXT, Block, _grouped, _rows, _with_replies, answered, ask_shared, bucket_count, by_bucket,
                                 hear_shared, packed, sent, stored_blocks, tell_shared, unpacked)
from kerbside.llm.graph import stored
from kerbside.llm.text import mix, sha256, table

LENGTH = 200
GRAM = 96
BLOCK_BYTES = 2 << 20
# Bytes of segments that are sorted in one bucket.
BUCKET_MOST = 2 * BUCKET_TEXT
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Symbols of the strings in buckets are words of this many bytes.
WORD = 8
# Starts whose grams are hashed at once; their arrays stay in a processor's cache.
CHUNK = 1 << 14
# A random number for each byte, and the odd factor of the sums that hash grams.
SPREAD = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTORS[0]))
FACTOR = 0xD1342543DE82EF95


def collection_bwt(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefixes of all suffixes of ``strings``, empty ones first.

    Symbols are bytes plus one; 0 ends a string. ``lcp[k]`` is what
    suffix ``k`` shares with the one before it. Ends of strings match nothing, and sort by string.
    """
    symbols = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    return _columns(symbols, np.array([len(s) for s in strings], np.int64))


def _columns(symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transform and common prefixes of strings of ``size`` symbols each, positive numbers that stand string after string."""
    n = len(size)
    bits = np.int64(int(len(symbols) + n).bit_length())
    mask = np.int64((1 << int(bits)) - 1)
    ends = np.cumsum(size)
    bwt = np.where(size > 0, symbols[np.maximum(ends - 1, 0)] if len(symbols) else 0, 0)
    lcp = np.zeros(n, np.uint16 if size.max(initial=0) < 1 << 16 else np.int64)
    # Symbols of the transform with their places, in order: that of the suffixes which start with
    # them. ``ranks`` are those whose suffix is not in yet, of the strings ``owner``.
    owner = np.argsort(bwt, kind="stable")[int(np.count_nonzero(bwt == 0)):]
    keys = bwt[owner] << bits | owner
    ranks = np.arange(len(keys))
    # What the suffixes that are in start with.
    heads = np.empty(0, np.int64)
    done = 0
    while len(ranks):
        done += 1
        new = n + ranks
        going = size[owner] > done
        after = np.zeros(len(owner), np.int64)
        after[going] = symbols[ends[owner[going]] - done - 1]
        # What a suffix shares with the one before it: one more than what their tails share.
        touched = np.unique(np.concatenate([ranks, ranks[ranks + 1 < len(keys)] + 1]))
        here, before = keys[touched], keys[np.maximum(touched - 1, 0)]
        same = (touched > 0) & (here >> bits == before >> bits)
        shared = same.astype(lcp.dtype)
        # Tails that start with different symbols, or are empty, share nothing.
        low, high = (before[same] & mask) - n, (here[same] & mask) - n
        alike = (low >= 0) & (high >= 0)
        alike[alike] = heads[low[alike]] == heads[high[alike]]
        if alike.any():
            low, high = low[alike] + n, high[alike] + n
            least = lcp[high]
            # From the last range to the first, so that what lies between two of them is none.
            far = np.flatnonzero(high - low > 1)
            far = far[np.argsort(-low[far])]
            if len(far):
                least[far] = np.minimum.reduceat(np.append(lcp, lcp[:1]), np.stack([low[far] + 1, high[far] + 1], 1).ravel())[::2]
            shared[np.flatnonzero(same)[alike]] = least + 1
        # One pass puts the new symbols and prefixes between the old ones.
        stay = np.ones(len(bwt) + len(new), bool)
        stay[new] = False
        old = np.flatnonzero(stay)
        # Old symbols keep their order at shifted places.
        place = keys & mask
        keys += old[place] - place
        grown, prefixes = np.empty(len(stay), np.int64), np.empty(len(stay), lcp.dtype)
        grown[new], grown[old] = after, bwt
        prefixes[old] = lcp
        prefixes[n + touched] = shared
        bwt, lcp = grown, prefixes
        heads = keys >> bits
        # New ones are ranked among their like.
        fresh = after[going] << bits | new[going]
        sort = np.argsort(fresh)
        fresh, owner = fresh[sort], owner[going][sort]
        ranks = np.searchsorted(keys, fresh) + np.arange(len(fresh))
        stay = np.ones(len(keys) + len(ranks), bool)
        stay[ranks] = False
        merged = np.empty(len(stay), np.int64)
        merged[ranks], merged[stay] = fresh, keys
        keys = merged
    return bwt, lcp


def suffix_places(bwt: np.ndarray, strings: list[bytes]):
    """``(k, places)``: for each suffix length ``k`` where the strings' suffixes of it stand, -1 for shorter strings."""
    return _places(bwt, np.array([len(s) for s in strings], np.int64))


def _places(bwt: np.ndarray, size: np.ndarray):
    order = np.argsort(bwt, kind="stable")[int(np.count_nonzero(bwt == 0)):]
    step = np.full(len(bwt), -1, np.int64)
    step[order] = len(size) + np.arange(len(order))
    at = np.arange(len(size))
    for k in range(int(size.max(initial=0)) + 1):
        yield k, np.where(size >= k, at, -1)
        at = np.where(size > k, step[at], at)


def repeated_starts(strings: list[bytes], twice: np.ndarray, length: int, lead: np.ndarray | None = None) -> list[np.ndarray]:
    """For each string, for each start of ``length`` bytes, whether these bytes start elsewhere too.

    ``twice`` tells which strings stand at two places or more as a whole. ``lead`` says how many bytes stand before a string's anchor,
    where equal runs of ``length`` bytes have the anchor at equal places. Then symbols are words of ``WORD`` bytes, the anchor starting one: a
    run is the suffix that starts with the first whole word in it, and up to ``WORD - 1`` bytes of the word before, which the transform holds.
    """
    word = WORD if lead is not None and length >= WORD else 1
    size = np.array([len(s) for s in strings], np.int64)
    front = -lead % word if word > 1 else np.zeros(len(size), np.int64)
    count = np.maximum(size - length + 1, 0)
    room = -(-(front + size) // word) * word
    begin = np.cumsum(room) - room + front
    # What fills words up is in no run.
    filled = b"".join(bytes(f) + s + bytes(r - f - len(s)) for s, f, r in zip(strings, front.tolist(), room.tolist()))
    words = np.frombuffer(filled, f">u{word}").astype(np.uint64)
    bwt, lcp = _columns(np.unique(words, return_inverse=True)[1].astype(np.int64) + 1, room // word)
    ends = np.cumsum(room // word)
    # Where each suffix starts and where its string ends.
    at, end, owner = np.zeros(len(bwt), np.int64), np.zeros(len(bwt), np.int64), np.zeros(len(bwt), np.int64)
    for k, places in _places(bwt, room // word):
        own = np.flatnonzero(places >= 0)
        at[places[own]], end[places[own]], owner[places[own]] = ends[own] - k, ends[own], own
    common = lcp.astype(np.int64)
    close = np.flatnonzero((common * word < length) & (common * word + word > length - word + 1))
    mine, other = at[close] + common[close], at[close - 1] + common[close]
    inside = (close > 0) & (mine < end[close]) & (other < end[close - 1])
    close = close[inside]
    apart = words[mine[inside]] ^ words[other[inside]]
    common *= word
    for k in range(1, word):
        common[close] += apart >> np.uint64(8 * (word - k)) == 0
    weight = 1 + np.asarray(twice, np.int64)
    wanted = np.zeros(len(filled) + 1, bool)
    starts = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
    wanted[starts] = True
    found = np.zeros(len(filled), bool)
    for ahead in range(word):
        group = np.cumsum(common < length - ahead)
        spot = np.where(at < end, at * word - ahead, -1)
        own = np.flatnonzero(wanted[spot])
        own = own[np.bincount(group[own], weight[owner[own]])[group[own]] > 1] if len(own) else own
        if ahead and len(own):
            rest = words[at[own] - 1] & np.uint64((1 << 8 * ahead) - 1)
            order = np.lexsort((rest, group[own]))
            own, rest = own[order], rest[order]
            which = np.cumsum(np.r_[True, (rest[1:] != rest[:-1]) | (group[own][1:] != group[own][:-1])]) - 1
            own = own[np.bincount(which, weight[owner[own]])[which] > 1]
        found[spot[own]] = True
    return np.split(found[starts], np.cumsum(count)[:-1]) if len(count) else []


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ``FACTOR`` and of its inverse."""
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, f, np.uint64)]) for f in (FACTOR, pow(FACTOR, -1, 1 << 64)))


class Bytes:
    """Bytes of a block's texts in one array, and the anchors of all strings of ``length`` in them.

    ``keys`` are the anchors' hashes, ``place`` where they stand; ``first`` and ``count`` tell the starts of the strings around each.
    """

    def __init__(self, block: Block, length: int, gram: int):
        texts = [t or b"" for t in block.texts]
        self.length = length
        self.data = b"".join(texts)
        values = np.frombuffer(self.data, np.uint8)
        starts = max(0, len(values) - length + 1)
        valid = np.zeros(len(values), bool)
        end = 0
        for size in map(len, texts):
            if size >= length:
                valid[end : end + size - length + 1] = True
            end += size
        low = np.uint64((1 << (CHUNK + length).bit_length()) - 1)
        up, down = _powers(CHUNK + length)
        parts = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
        for base in range(0, starts, CHUNK):
            inside = valid[base : min(base + CHUNK, starts)]
            part = values[base : base + len(inside) + length - 1]
            # Sums of numbers by powers, up to each byte; a gram's is a difference of two, shifted to the first power.
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(SPREAD[part] * up[: len(part)], out=sums[1:])
            grams = mix((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
            # The first of equal grams is the least.
            least = _slid(grams & ~low | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
            place = np.where(inside, (least & low).astype(np.int64), -1)
            cut = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            place = place[cut]
            parts.append((grams[place], np.where(place < 0, -1, place + base), cut + base))
        keys, place, first = map(np.concatenate, zip(*parts))
        head = np.r_[True, place[1:] != place[:-1]][: len(place)]
        keys, place, first = keys[head], place[head], first[head]
        count = np.diff(first, append=starts)
        own = place >= 0
        self.keys, self.place, self.first, self.count = keys[own], place[own], first[own], count[own]


def _slid(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every run of ``width`` values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def _alike(data: bytes, length: int, keys, first, count) -> np.ndarray:
    """For each segment an equal one: where a text has a short period, and so a segment for each, the first of them; else itself."""
    same = np.r_[False, (keys[1:] == keys[:-1]) & (count[1:] == count[:-1]) & (first[1:] - first[:-1] == count[:-1]), False]
    edge = np.flatnonzero(same[1:] != same[:-1])
    of = np.arange(len(keys))
    for a, b in edge.reshape(-1, 2).tolist():
        period, end = int(count[a]), int(first[b] + count[b]) + length - 1
        if data[first[a] : end - period] == data[first[a] + period : end]:
            of[a : b + 1] = a
    return of


def _segments(text: Bytes, shared: np.ndarray, buckets: int):
    """``(bucket, message)`` with the distinct segments around shared anchors, and ``first, count, bit`` of every one.

    ``bit`` is where the answers on a segment's starts begin when the replies of all buckets stand one after another.
    """
    keys, first, count, lead = text.keys[shared], text.first[shared], text.count[shared], (text.place - text.first)[shared]
    of = _alike(text.data, text.length, keys, first, count)
    own = np.flatnonzero(of == np.arange(len(of)))
    known: dict[tuple[int, bytes], int] = {}
    which = np.empty(len(of), np.int64)
    which[own] = [known.setdefault((key, text.data[a:b]), len(known)) for key, a, b in
                  zip(keys[own].tolist(), first[own].tolist(), (first + count + text.length - 1)[own].tolist())]
    which = which[of]
    strings = [string for _, string in known]
    _, sample, times = np.unique(which, return_index=True, return_counts=True)
    bucket = ((keys[sample] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bit, base, messages = np.empty(len(order), np.int64), 0, []
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        n = count[sample[part]]
        bit[part] = base + np.cumsum(n) - n
        base += -(-int(n.sum()) // 8) * 8
        message = _sent_strings(keys[sample[part]], [strings[k] for k in part.tolist()], lead[sample[part]], times[part] > 1)
        messages.append((int(bucket[part[0]]), message))
    return messages, np.stack([first, count, bit[which]])


def _sent_strings(keys, strings: list[bytes], lead, twice) -> bytes:
    sizes = np.array([len(s) for s in strings], np.uint32)
    # The size stands first and big-endian, for ``_size``.
    head = int(sizes.sum()).to_bytes(4, "big") + len(strings).to_bytes(4, "little") + keys.tobytes() + sizes.tobytes()
    rest = lead.astype(np.uint32).tobytes() + np.packbits(twice).tobytes()
    return head + rest + zstandard.ZstdCompressor(level=3).compress(b"".join(strings))


def _heard_strings(message: bytes):
    n = int.from_bytes(message[4:8], "little")
    keys = np.frombuffer(message, np.uint64, n, 8)
    sizes, lead = np.frombuffer(message, np.uint32, 2 * n, 8 + 8 * n).astype(np.int64).reshape(2, n)
    bits = (n + 7) // 8
    twice = np.unpackbits(np.frombuffer(message, np.uint8, bits, 8 + 16 * n), count=n) > 0
    data = zstandard.ZstdDecompressor().decompress(message[8 + 16 * n + bits :])
    ends = np.cumsum(sizes).tolist()
    return keys, [data[e - s : e] for e, s in zip(ends, sizes.tolist())], lead, twice


def _tell_repeated(length: int):
    def tell(messages: list[bytes]) -> list[bytes]:
        known: dict[tuple[int, bytes], int] = {}
        heard = []
        for message in messages:
            keys, strings, lead, twice = _heard_strings(message)
            heard.append(([known.setdefault(k, len(known)) for k in zip(keys.tolist(), strings)], lead, twice))
        which = np.concatenate([w for w, _, _ in heard]).astype(np.int64)
        lead = np.zeros(len(known), np.int64)
        lead[which] = np.concatenate([x for _, x, _ in heard])
        several = np.bincount(which, 1 + np.concatenate([x for _, _, x in heard]).astype(np.int64)) > 1
        strings = [s for _, s in known]
        _, anchor, variants = np.unique(np.fromiter((k for k, _ in known), np.uint64, len(known)), return_inverse=True, return_counts=True)
        # Alone around their anchor: their strings stand where the segment does, and nowhere else.
        sorted_ = np.flatnonzero(variants[anchor] > 1)
        found = [np.full(len(s) - length + 1, many) for s, many in zip(strings, several.tolist())]
        if len(sorted_):
            starts = repeated_starts([strings[k] for k in sorted_.tolist()], several[sorted_], length, lead[sorted_])
            for k, bits in zip(sorted_.tolist(), starts):
                found[k] = bits
        return [packed(np.packbits(np.concatenate([found[k] for k in w]))) for w, _, _ in heard]

    return tell


def _size():
    return F.conv(F.hex(F.substring("data", 1, 4)), 16, 10).cast("long")


def _distinct_strings(message: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a message's distinct strings in two halves, whether one stands twice, and which each start has."""
    _, segments, _, twice = _heard_strings(message)
    sizes = np.array([len(s) for s in segments], np.int64)
    data = np.frombuffer(b"".join(segments), np.uint8).astype(np.uint64)
    counts = sizes - length + 1
    begin = np.cumsum(sizes) - sizes
    starts = np.arange(int(counts.sum())) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
    halves = []
    for factor in map(np.uint64, FACTORS):
        values, width = mix(data + factor), 1
        while 2 * width <= length:
            values = mix(values[:-width] * factor + values[width:])
            width *= 2
        # Two runs that overlap make up the whole string.
        halves.append(mix(values[starts] * factor + values[starts + length - width]))
    order = np.lexsort(halves[::-1])
    high, low = halves[0][order], halves[1][order]
    head = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(head) - 1
    times = np.bincount(which, np.repeat(1 + np.array(twice, np.int64), counts))
    return high[head], low[head], times > 1, which


def _tell_same(messages: list[bytes]) -> list[bytes]:
    """A bit for each string of each message: whether it stands at two places or more in all of them."""
    counts = [_strings_in(m) for m in messages]
    high = np.concatenate([np.frombuffer(m, np.uint64, n) for m, n in zip(messages, counts)])
    low = np.concatenate([np.frombuffer(m, np.uint64, n, 8 * n) for m, n in zip(messages, counts)])
    twice = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8, offset=16 * n), count=n) for m, n in zip(messages, counts)])
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) - 1
    many = np.bincount(which, 1 + twice.astype(np.int64)) > 1
    shared, ends = many[which], np.cumsum(counts)
    return [np.packbits(shared[e - n : e]).tobytes() for n, e in zip(counts, ends)]


def _strings_in(message: bytes) -> int:
    # 16 bytes a string and a bit each, in whole bytes.
    n = len(message) * 8 // 129
    while 16 * n + (n + 7) // 8 > len(message):
        n -= 1
    return n


def _answered_by_string(messages: DataFrame, length: int, buckets: int) -> DataFrame:
    """The replies that ``_tell_repeated`` has for ``messages``, with every string in a bucket of its own hash."""
    asking = stored(messages.select(F.monotonically_increasing_id().alias("block"), F.col("block").alias("owner"),
                                    F.col("bucket").alias("home"), "data"), "hot")

    def batches_of(rows):
        for bucket, block, data in _grouped(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(block, pa.int64()), pa.array(data, pa.binary())],
                ["bucket", "block", "data"])

    def ask(batches):
        for number, row, _ in _rows(batches):
            high, low, twice, _ = _distinct_strings(row["data"], length)
            order, parts = by_bucket(high, buckets)
            for bucket, a, b in parts:
                own = order[a:b]
                yield bucket, number, high[own].tobytes() + low[own].tobytes() + np.packbits(twice[own]).tobytes()

    def hear(batches):
        for _, row, replies in _rows(batches):
            high, _, twice, which = _distinct_strings(row["data"], length)
            order, parts = by_bucket(high, buckets)
            many = np.zeros(len(high), bool)
            for bucket, a, b in parts:
                many[order[a:b]] = np.unpackbits(np.frombuffer(replies[bucket], np.uint8), count=b - a) > 0
            yield row["home"], row["owner"], packed(np.packbits(many[which]))

    kind = "bucket long, block long, data binary"
    told = answered(asking.mapInArrow(lambda batches: batches_of(ask(batches)), kind), _tell_same)
    return _with_replies(asking, told).mapInArrow(lambda batches: batches_of(hear(batches)), kind)


_REMOVED = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                      ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])
_REMOVED_DDL = ("struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept_sha256: string, starts: array<bigint>, "
                "ends: array<bigint>, kept: binary>")


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, into: str = "repeated",
                   kept: bool = True) -> DataFrame:
    """``docs`` with a struct column ``into``: byte counts, removed spans ``[start, end)`` and kept bytes.

    A column of that name is replaced.
    """
    docs = docs.drop(into)
    blocks = stored_blocks(docs, BLOCK_BYTES)
    buckets = bucket_count(blocks)

    def ask(block, _):
        yield from ask_shared(Bytes(block, length, gram).keys, buckets)

    shared = stored(answered(sent(blocks, None, ask), tell_shared), "shared")

    def look_up(block, replies):
        text = Bytes(block, length, gram)
        asked, told = _segments(text, hear_shared(text.keys, buckets, replies), buckets)
        yield from asked
        yield -1, packed(told)

    messages = stored(sent(blocks, shared, look_up), "segments")
    told = messages.where("bucket < 0")
    segments = messages.where("bucket >= 0")
    large = stored(segments.groupBy("bucket").agg(F.sum(_size()).alias("size")).where(F.col("size") > BUCKET_MOST), "large")
    size = large.agg(F.sum("size")).first()[0]
    if size:
        # Hashes of strings take some nine times the room of their segments.
        hot = segments.join(large.select("bucket"), "bucket", "left_semi").select("bucket", "block", "data")
        told = told.unionByName(_answered_by_string(hot, length, max(buckets, 9 * size // BUCKET_TEXT)))
        segments = segments.join(large.select("bucket"), "bucket", "left_anti").select("bucket", "block", "data")
    told = answered(segments, _tell_repeated(length)).unionByName(told)

    def remove(batches):
        for _, row, replies in _rows(batches):
            block = Block.of_row(row)
            first, count, bit = unpacked(replies.pop(-1), np.int64).reshape(3, -1)
            texts = [t or b"" for t in block.texts]
            cover = np.zeros(sum(map(len, texts)) + 1, np.int32)
            if len(first):
                bits = np.unpackbits(np.concatenate([unpacked(replies[b], np.uint8) for b in sorted(replies)])) > 0
                # Every start is in one segment.
                step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                starts = (np.repeat(first, count) + step)[bits[np.repeat(bit, count) + step]]
                cover[starts] += 1
                cover[starts + length] -= 1
            gone = np.cumsum(cover)[:-1] > 0
            found, begin = [], 0
            for data in texts:
                mask = gone[begin : begin + len(data)]
                edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
                starts, ends = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
                left = np.frombuffer(data, np.uint8)[~mask].tobytes() if len(starts) else data
                found.append({"n_bytes": len(data), "n_removed": int(mask.sum()), "n_spans": len(starts), "kept_sha256": sha256(left),
                              "starts": starts.tolist(), "ends": ends.tolist(), "kept": left if kept else None})
                begin += len(data)
            yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(found, _REMOVED)], [*block.rows.schema.names, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return _with_replies(blocks, told).mapInArrow(remove, f"{schema}, `{into}` {_REMOVED_DDL}")


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), kept=False)
    return found.select("doc_id", "repeated.n_bytes", "repeated.n_removed", "repeated.n_spans", "repeated.kept_sha256")
