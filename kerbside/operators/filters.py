"""Row filters and slices that reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import roads, times, values


def named_roads(df: DataFrame, column: str = "road_name") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def on_date(df: DataFrame, day: str | date) -> DataFrame:
    """One partition's rows."""
    return df.filter(F.col("date") == F.lit(str(day)).cast("date"))


def on_partitions_of(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of the partitions that occur in ``keys``; null values match nothing.

    The values never visit the driver: where ``keys`` is small enough to be broadcast, the scan of ``df`` is
    pruned at run time. Spark does so only if the other side has a comparison, which could make it selective;
    hence one that is true of every value.
    """
    wanted = keys.select(*columns).distinct().filter(F.hash(*columns) >= F.lit(-(1 << 31)))
    return df.join(wanted, list(columns), "left_semi")


def on_dates_of(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows on any date that occurs in ``keys``; the date list never visits the driver."""
    return on_partitions_of(df, keys, ["date"])


def has_hourly_rows(weather: DataFrame, day: str | date) -> DataFrame:
    """One row, ``has_hourly``: is there an on-the-hour reading on ``day``? Reads up to one hit."""
    hits = on_date(weather, day).filter(F.col("datetime").endswith(":00")).limit(1)
    return hits.agg((F.count(F.lit(1)) > 0).alias("has_hourly"))


def for_road(df: DataFrame, road: str | None) -> DataFrame:
    """Exact match on the trimmed name. A blank name filters nothing; a frame without a
    road column has no matching rows."""
    wanted = (road or "").strip()
    if not wanted:
        return df
    column = values.first_column(df, values.ROAD_CANDIDATES)
    if column is None:
        return df.limit(0)
    return df.filter(values.trimmed(F.coalesce(F.col(column).cast("string"), F.lit(""))) == wanted)


def latest_date(df: DataFrame) -> DataFrame:
    """The newest day's rows, through a scalar subquery on the partition column."""
    newest = df.agg(F.max("date").alias("newest")).scalar()
    return df.filter(F.col("date") == newest)


def between_dates(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Both bounds included; reversed bounds are an error."""
    start, end = str(start), str(end)
    if start > end:
        raise ValueError("start date must not be after end date")
    return df.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def in_any_order(start: str, end: str) -> tuple[str, str]:
    """Bounds for listing, which accepts them either way round."""
    return (start, end) if start <= end else (end, start)


def search_rows(
    df: DataFrame, road_part: str | None = None, time_from: str | None = None, time_to: str | None = None
) -> DataFrame:
    """Road substring, ignoring case, and an inclusive HH:mm range; rows without a time pass
    the range."""
    if road_part:
        column = values.first_column(df, values.ROAD_DISPLAY_CANDIDATES)
        name = F.coalesce(F.col(column), F.lit("")) if column else F.lit("")
        df = df.filter(F.lower(name).contains(road_part.lower()))
    if time_from or time_to:
        clock = F.regexp_extract(F.coalesce(F.col("recordDatetime"), F.lit("")), r"(\d{2}:\d{2})", 1)
        keep = clock == ""
        inside = F.lit(True)
        if time_from:
            inside = inside & (clock >= time_from)
        if time_to:
            inside = inside & (clock <= time_to)
        df = df.filter(keep | inside)
    return df


def up_to_now(df: DataFrame, as_of: Column, bucket: str = "bucket") -> DataFrame:
    """Earlier days whole, the day of ``as_of`` up to its current bucket."""
    today = F.to_date(as_of)
    return df.filter(
        (F.col("date") < today) | ((F.col("date") == today) & (F.col(bucket) <= times.bucket_of(as_of)))
    )


def real_edges(df: DataFrame, column: str = "id") -> DataFrame:
    """Without junction-internal edges and edges that name no way."""
    return df.filter(roads.way_of_edge(F.col(column)).isNotNull())


def known_to(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    return df.join(dimension.select(key), key, "left_semi")


def up_to_anchor(df: DataFrame, anchor: Column, ts: str = "rec_ts") -> DataFrame:
    return df.filter(F.col(ts) <= anchor)


def drawable_ways(df: DataFrame) -> DataFrame:
    """Ways with a class, a name, at least one edge and at least two resolved points, as ``coordinates`` or as a count."""
    points = F.col("points") if "points" in df.columns else F.size("coordinates")
    return df.filter(
        F.col("highway").isNotNull()
        & (F.col("highway") != "")
        & F.col("name").isNotNull()
        & (F.col("name") != "")
        & (F.size("edge_ids") >= 1)
        & (points >= 2)
    )
