"""Ordered operators that stay parallel when one key holds most rows.

A plain window over ``partitionBy(road)`` sorts a whole road in one task. The helpers here
deal the rows by time chunks (one road-hour or road-day per group) once and carry the little that crosses a
chunk border through a summary holding a row per chunk. The result is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.session import pin

_BEFORE = (Window.unboundedPreceding, Window.currentRow)


def _in_chunks(df: DataFrame, keys: Sequence[str], order: str, unit: str, tie: Sequence[str]) -> DataFrame:
    """Rows dealt by key and ``_chunk`` and sorted in time, pinned: the one exchange of all rows.

    What follows reads them where they lie, as Spark knows how they are dealt and sorted, so the input is evaluated
    once however often its rows are looked at.
    """
    chunked = df.withColumn("_chunk", F.date_trunc(unit, F.col(order)))
    return pin(chunked.repartition(*keys, "_chunk").sortWithinPartitions(*keys, "_chunk", order, *tie))


def lag_in_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    depth: int = 3,
    unit: str = "DAY",
    tie: Sequence[str] = (),
) -> DataFrame:
    """``<column>_lag_<1..depth>`` per key by time."""
    keys = list(keys)
    payload = F.struct(*columns)
    chunked = _in_chunks(df, keys, order, unit, tie)
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(order, *tie)
    numbered = chunked.withColumn("_row", F.row_number().over(in_chunk))
    for k in range(1, depth + 1):
        numbered = numbered.withColumn(f"_lag{k}", F.lag(payload, k).over(in_chunk))

    # The last `depth` rows of every chunk are all that later chunks can look back on: one row a chunk.
    newest = chunked.select(*keys, "_chunk", payload.alias("_payload"), F.row_number().over(
        Window.partitionBy(*keys, "_chunk").orderBy(F.desc(order), *[F.desc(t) for t in tie])).alias("_back"))
    tails = newest.filter(F.col("_back") <= depth).groupBy(*keys, "_chunk").agg(
        F.sort_array(F.collect_list(F.struct("_back", "_payload"))).alias("_tail"))
    # Chunks in order of time hold what came before them: the tails of the last chunks, newest first.
    across = Window.partitionBy(*keys).orderBy("_chunk")
    tails_before = F.array(*[F.lag("_tail", k).over(across) for k in range(1, depth + 1)])
    carried = tails.withColumn("_before", F.flatten(F.filter(tails_before, lambda t: t.isNotNull()))).drop("_tail")
    joined = numbered.join(carried, [*keys, "_chunk"], "left")
    for k in range(1, depth + 1):
        # Row r of its chunk has r-1 predecessors inside it; the rest come from before.
        earlier = F.get("_before", F.lit(k) - F.col("_row")).getField("_payload")
        value = F.when(F.col("_row") > k, F.col(f"_lag{k}")).otherwise(earlier)
        for column in columns:
            joined = joined.withColumn(f"{column}_lag_{k}", value.getField(column))
    helper = ["_chunk", "_row", "_before", *[f"_lag{k}" for k in range(1, depth + 1)]]
    return joined.drop(*helper)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    payload: str,
    unit: str = "DAY",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Replace a null ``payload`` by the last non-null one before it, per key by time."""
    keys = list(keys)
    chunked = _in_chunks(df, keys, order, unit, tie)
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(order, *tie).rowsBetween(*_BEFORE)
    position = F.struct(order, *tie)
    latest = F.max_by(F.col(payload), F.when(F.col(payload).isNotNull(), position)).alias("_latest")
    # One row per key and chunk: chunks that hold readings, and chunks that only need them.
    chunks = chunked.groupBy(*keys, "_chunk").agg(latest)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*keys, "_chunk", F.last("_latest", ignorenulls=True).over(earlier).alias("_carry"))
    filled = chunked.withColumn("_seen", F.last(payload, ignorenulls=True).over(in_chunk))
    return (
        filled.join(carried, [*keys, "_chunk"], "left")
        .withColumn(payload, F.coalesce("_seen", "_carry"))
        .drop("_chunk", "_seen", "_carry")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], whole_keys: bool = False) -> DataFrame:
    """One row per key, the first by ``order``; Spark limits each group before the shuffle.

    With ``whole_keys`` a null in a key equals nothing: each such row is a group of its own.
    """
    apart = []
    if whole_keys:
        broken = reduce(or_, [F.col(k).isNull() for k in keys])
        df = df.withColumn("_apart", F.when(broken, F.monotonically_increasing_id()))
        apart = ["_apart"]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, *apart).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank", *apart)


def last_values(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], n: int = 3, tie: Sequence[str] = ()
) -> DataFrame:
    """Per key, ``<column>_last`` = its last ``n`` values, oldest first; short histories are
    padded in front with their oldest value."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order), *[F.desc(t) for t in tie])
    recent = df.withColumn("_back", F.row_number().over(newest)).filter(F.col("_back") <= n)
    grouped = recent.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("_back")).alias("_at"), *columns))).alias("_recent")
    )
    def field_of(name: str):
        return lambda row: row[name]

    out = grouped
    for column in columns:
        seen = F.transform("_recent", field_of(column))
        padding = F.array_repeat(F.element_at(seen, 1), n - F.size("_recent"))
        out = out.withColumn(f"{column}_last", F.concat(padding, seen))
    return out.drop("_recent")


def last_row(df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest time per key, as an aggregate with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(order, *tie)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def hourly_extremes(df: DataFrame, keys: Sequence[str], flow: str = "avg_flow") -> DataFrame:
    """``peakFlow`` and ``minFlow`` of the row's hour on every row, without a self-join."""
    hour = Window.partitionBy(*keys)
    return df.withColumns({
        "peakFlow": F.round(F.max(flow).over(hour), 2),
        "minFlow": F.round(F.min(flow).over(hour), 2),
    })
