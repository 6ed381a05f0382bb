"""Cells: a few leading rows held in a task while any number of following rows stream past them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def boxed(value) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def unboxed(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of ``batches`` one at a time, so that only one payload is copied out of Arrow at once."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in columns)


def led(leaders: DataFrame, followers: DataFrame, tasks: int, work: Callable, schema: str) -> DataFrame:
    """What ``work(cell, leaders, followers)`` yields as record batches, for each cell.

    Both frames have ``cell`` and ``data``; ``work`` gets the leaders' data as a list, which its caller
    keeps bounded, and the followers' as an iterator. The number of tasks is given, since the size of the rows says
    little about the work on them.
    """

    def run(batches):
        for cell, rows in groupby(rows_of(batches, "cell", "follows", "data"), key=lambda r: r[0]):
            first, rest = [], iter(rows)
            held = None
            for row in rest:
                if row[1]:
                    held = row[2]
                    break
                first.append(row[2])
            yield from work(cell, first, _chain(held, rest))

    both = leaders.select("cell", F.lit(0).alias("follows"), "data").unionByName(
        followers.select("cell", F.lit(1).alias("follows"), "data"))
    return both.repartition(tasks, "cell").sortWithinPartitions("cell", "follows").mapInArrow(run, schema)


def _chain(held, rest) -> Iterator[bytes]:
    if held is not None:
        yield held
    for row in rest:
        yield row[2]
