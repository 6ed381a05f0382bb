"""Small helpers that the operators' tasks share: bounded batches, word splitting, hashing."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text a task works on at once; bounds its memory whatever the partition holds.
BATCH_BYTES = 8 << 20

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text, None for null."""
    return pc.cast(column, pa.large_binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: a worker lives on for other stages, and memory that it holds free is no other's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bounded(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` text bytes; a longer text stands alone. After the last one, memory is given back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
    give_back()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit BLAKE2 hash of a word, remembered for up to ``most`` words."""

    most = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of ``n`` values; empty where there are fewer than ``n``."""
    if len(values) < n:
        return np.empty(0, np.uint64)
    out = values[: len(values) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += values[k : len(values) - n + 1 + k]
        out ^= out >> np.uint64(29)
    return mix(out)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text falls on ``fold`` of ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or a longer name where ``df`` already has such a column."""
    while wish.lower() in {c.lower() for c in df.columns}:
        wish += "_"
    return wish
