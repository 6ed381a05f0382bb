"""Blocks of whole documents that ask hashed buckets about their keys and get one answer each.

Finding what texts share needs every key's occurrences in one place. Blocks keep that small: a
block is a bounded run of documents, stored once as a row of a table in the shared folder. It sends each distinct
key it holds to the key's bucket, once, so a key that a third of all documents hold is a
row per block there and not one per document. A bucket answers per block, in the order of the
keys that the block sent, and the answers come back to the block in one join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.graph import stored
from kerbside.llm.text import bounded, give_back, text_bytes

BLOCK_BYTES = 4 << 20
# Text bytes for each bucket; a bucket holds the keys of that much text.
BUCKET_TEXT = 4 << 20


def packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Block:
    """The documents of one block: all their columns, and ids and texts apart."""

    def __init__(self, rows: pa.RecordBatch):
        self.rows = rows
        self.ids: list[int | None] = pc.cast(rows.column("doc_id"), pa.int64()).to_pylist()
        self.texts = text_bytes(rows.column("text"))

    @classmethod
    def of_row(cls, row: dict) -> Block:
        return cls(pa.ipc.open_stream(row["rows"]).read_next_batch())


def stored_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, bytes, rows``: the documents with all their columns, compressed, a block a row."""

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in bounded(batches, limit=block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column("text").nbytes], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                ["bytes", "rows"])

    # The numbers are settled by the write: what is read back is the same for every reader.
    rows = docs.mapInArrow(run, "bytes long, rows binary")
    return stored(rows.select(F.monotonically_increasing_id().alias("block"), "*"), "blocks")


def bucket_count(blocks: DataFrame) -> int:
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    return max(512, total // BUCKET_TEXT)


def sent(blocks: DataFrame, replies: DataFrame | None, work: Callable) -> DataFrame:
    """``bucket, block, data``: what ``work(block, {bucket: reply})`` yields as ``(bucket, data)``."""

    def run(batches):
        for number, row, replies_ in _rows(batches):
            for bucket, data in work(Block.of_row(row), replies_):
                yield number, bucket, data

    def batches_of(batches):
        for number, bucket, data in _grouped(run(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(number, pa.int64()), pa.array(data, pa.binary())],
                ["bucket", "block", "data"])

    return _with_replies(blocks, replies).mapInArrow(batches_of, "bucket long, block long, data binary")


def _grouped(rows: Iterator[tuple], most_bytes: int = 4 << 20):
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 16
        if size >= most_bytes:
            yield zip(*held)
            held, size = [], 0
    if held:
        yield zip(*held)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield row["block"], row, {r["bucket"]: r["data"] for r in row.get("replies") or []}
    give_back()


def _with_replies(blocks: DataFrame, replies: DataFrame | None) -> DataFrame:
    if replies is None:
        return blocks
    gathered = replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias("replies"))
    return blocks.join(gathered, "block", "left")


def answered(messages: DataFrame, work: Callable) -> DataFrame:
    """``bucket, block, data``: the replies of ``work([data, ...])``, one for each message of a bucket.

    One task holds the messages of a bucket. Where a block sends each hashed key once, and a key is of fixed size, that is
    about ``BUCKET_TEXT`` and a row per block; callers that send more for a key split large buckets first.
    """

    def run(batches):
        bucket, blocks, data = None, [], []
        for batch in batches:
            for b, block, d in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "data"))):
                if b != bucket and blocks:
                    yield from zip(blocks, [bucket] * len(blocks), work(data))
                    blocks, data = [], []
                bucket = b
                blocks.append(block)
                data.append(d)
        if blocks:
            yield from zip(blocks, [bucket] * len(blocks), work(data))
        give_back()

    def batches_of(batches):
        for number, bucket, data in _grouped(run(batches)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(number, pa.int64()), pa.array(data, pa.binary())],
                ["bucket", "block", "data"])

    dealt = messages.repartition("bucket").sortWithinPartitions("bucket", "block")
    return dealt.mapInArrow(batches_of, "bucket long, block long, data binary")


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of ``keys`` by bucket and value, and ``(bucket, start, end)`` of each bucket in it."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((keys, bucket))
    placed = bucket[order]
    cut = np.flatnonzero(np.r_[True, placed[1:] != placed[:-1]]) if len(placed) else np.empty(0, np.int64)
    return order, [(int(placed[a]), int(a), int(b)) for a, b in zip(cut, [*cut[1:], len(placed)])]


# Keys that occur more than once anywhere: a filter, so 32 bits of a key beside its bucket do.

def ask_shared(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Messages with each distinct key of a block and whether the block itself has it twice."""
    keys, count = np.unique(keys, return_counts=True)
    order, parts = by_bucket(keys, buckets)
    low, twice = keys[order].astype(np.uint32), count[order] > 1
    for bucket, a, b in parts:
        yield bucket, low[a:b].tobytes() + np.packbits(twice[a:b]).tobytes()


def tell_shared(messages: list[bytes]) -> list[bytes]:
    """A bit for each key of each message: whether it occurs twice or more in all of them."""
    counts = [_keys_in(m) for m in messages]
    keys = np.concatenate([np.frombuffer(m, np.uint32, n) for m, n in zip(messages, counts)])
    twice = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8, offset=4 * n), count=n) for m, n in zip(messages, counts)])
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    many = np.bincount(which, twice) + count > 1
    shared, ends = many[which], np.cumsum(counts)
    return [np.packbits(shared[e - n : e]).tobytes() for n, e in zip(counts, ends)]


def _keys_in(message: bytes) -> int:
    # 4 bytes a key and a bit each, in whole bytes.
    n = len(message) * 8 // 33
    while 4 * n + (n + 7) // 8 > len(message):
        n -= 1
    return n


def hear_shared(keys: np.ndarray, buckets: int, replies: dict[int, bytes]) -> np.ndarray:
    """For each of a block's keys whether it occurs twice or more anywhere."""
    if not len(keys):
        return np.zeros(0, bool)
    # Runs of equal keys are looked up once.
    head = np.r_[True, keys[1:] != keys[:-1]]
    if not head.all():
        return hear_shared(keys[head], buckets, replies)[np.cumsum(head) - 1]
    own, which = np.unique(keys, return_inverse=True)
    order, parts = by_bucket(own, buckets)
    shared = np.zeros(len(own), bool)
    for bucket, a, b in parts:
        shared[order[a:b]] = np.unpackbits(np.frombuffer(replies[bucket], np.uint8), count=b - a) > 0
    return shared[which]
