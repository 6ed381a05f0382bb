"""Grouped summaries. Every group-by combines on the map side, so a road or label that holds
most rows shrinks to one partial row per task before it is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import roads, times, values
from kerbside.schemas import SILVER_MEANS, SILVER_TOTALS


def lanes_to_roads(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lane rows to one row per key: rounded means and totals; an absent flow reads 0.0."""
    columns = []
    for name, source in SILVER_MEANS.items():
        mean = values.mean_or_zero(F.col(source)) if name == "avg_flow" else F.round(F.avg(source), 2)
        columns.append(mean.alias(name))
    for name, source in SILVER_TOTALS.items():
        columns.append(F.round(F.sum(source), 2).alias(name))
    return bronze.groupBy(*keys).agg(*columns)


def hourly_flow_stats(silver: DataFrame, keys: Sequence[str], flow: str = "avg_flow") -> DataFrame:
    return silver.groupBy(*keys).agg(
        F.round(F.max(flow), 2).alias("peakFlow"), F.round(F.min(flow), 2).alias("minFlow")
    )


def dataset_stats(df: DataFrame) -> DataFrame:
    """Row, road, weather and time-range figures as one row.

    Rows are first counted per (road, weather), so the distinct counts see only that small
    result instead of an expanded copy of the input.
    """
    groups = df.groupBy("road_name", "weather").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("recordDatetime").alias("_lo"),
        F.max("recordDatetime").alias("_hi"),
    )
    with_road = F.sum(F.when(F.col("road_name").isNotNull(), F.col("_n")))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(with_road, F.lit(0)).alias("rows_with_road_name"),
        F.countDistinct("road_name").alias("unique_roads"),
        F.countDistinct("weather").alias("unique_weather"),
        F.min("_lo").alias("min_record_datetime"),
        F.max("_hi").alias("max_record_datetime"),
    )


def road_count(df: DataFrame) -> DataFrame:
    """Distinct road names as they are, nulls left out; 0 for a frame without a road column."""
    column = values.first_column(df, values.ROAD_CANDIDATES)
    if column is None:
        return df.limit(0).agg(F.count(F.lit(1)).alias("unique_roads"))
    return df.agg(F.countDistinct(column).alias("unique_roads"))


def road_list(df: DataFrame) -> DataFrame:
    """Distinct trimmed names, blanks left out, sorted."""
    column = values.first_column(df, values.ROAD_CANDIDATES)
    name = values.text_of(df, column) if column else F.lit(None).cast("string")
    return df.select(name.alias("road_name")).filter("road_name IS NOT NULL").distinct().orderBy("road_name")


def affected(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def dominant(df: DataFrame, by: Sequence[str], label: Column, seen: Sequence[Column], name: str) -> DataFrame:
    """Most frequent label per group; a tie goes to the label seen first, then by the alphabet."""
    labelled = df.select(*by, label.alias("_label"), F.struct(*seen).alias("_seen")).filter("_label IS NOT NULL")
    counts = labelled.groupBy(*by, "_label").agg(F.count(F.lit(1)).alias("_n"), F.min("_seen").alias("_first"))
    best = F.min_by("_label", F.struct((-F.col("_n")).alias("n"), "_first", "_label"))
    return counts.groupBy(*by).agg(best.alias(name))


def counters(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct roads and distinct 3-minute buckets; ``df`` carries ``bucket``."""
    column = values.first_column(df, values.ROAD_DISPLAY_CANDIDATES)
    name = F.nullif(F.col(column), F.lit("")) if column else F.lit(None).cast("string")
    groups = df.groupBy(*by, name.alias("_road"), "bucket").agg(F.count(F.lit(1)).alias("_n"))
    return groups.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records"),
        F.countDistinct("_road").alias("roads"),
        F.countDistinct("bucket").alias("buckets"),
    )


def latest_record_time(df: DataFrame) -> DataFrame:
    """Greatest parseable record time as one row; an error at run time when none parses."""
    column = values.first_column(df, values.TIME_CANDIDATES)
    if column is None:
        raise ValueError("the frame has no record time column")
    latest = F.max(times.parse_local(F.col(column)))
    failed = F.raise_error(F.lit("no record time could be parsed")).cast("timestamp_ntz")
    return df.agg(F.coalesce(latest, failed).alias("latest"))


# --- density per lookup key -------------------------------------------------------------


def density_records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keys`` (array), ``minute`` and ``density`` of each row, from whichever columns it has.

    A segment id gives the keys; only rows without one fall back to the road name.
    """
    minutes = []
    for column in values.present(df, values.SEGMENT_TIME_CANDIDATES):
        kind = dict(df.dtypes)[column]
        if kind.startswith("timestamp"):
            minutes.append(F.hour(column) * 60 + F.minute(column))
        elif kind == "string":
            minutes.append(times.minute_from_text(F.col(column)))
        else:
            minutes.append(times.minute_from_number(values.number_of(df, column)))
    # Resolved in a projection of its own, so that the keys read plain columns.
    resolved = df.select(
        *keep,
        values.first_text(df, values.SEGMENT_CANDIDATES).alias("_segment"),
        values.first_text(df, values.SEGMENT_NAME_CANDIDATES).alias("_name"),
        (F.coalesce(*minutes) if minutes else F.lit(None).cast("int")).alias("minute"),
        values.number_of_first(df, values.DENSITY_CANDIDATES).alias("density"),
    )
    keys = F.when(F.col("_segment").isNotNull(), roads.edge_keys(F.col("_segment"))).otherwise(roads.name_keys(F.col("_name")))
    return resolved.select(*keep, keys.alias("keys"), "minute", "density")


def _selected(minute: Column, selected: int | None) -> Column:
    """Does a minute round to the selected one (1440 means the day's last interval)? No
    selection takes all."""
    if selected is None:
        return F.lit(True)
    wanted = 1437 if selected == times.MINUTES_PER_DAY else selected
    return F.coalesce(times.nearest_step(minute) == wanted, F.lit(False))


def _per_key(records: DataFrame, by: Sequence[str], taken: Column | None = None) -> DataFrame:
    """A row for each key of the records ``taken``, which are all unless given."""
    known = records.filter("density IS NOT NULL")
    # Rows not taken lose their keys here: a filter would go below and write the minute's expressions out many times.
    keys = F.col("keys") if taken is None else F.when(taken, F.col("keys"))
    # explode_outer: a plain explode also filters on the list's size below, computing it twice.
    keyed = known.select(*by, "minute", "density", F.explode_outer(keys).alias("key"))
    return keyed.filter("key IS NOT NULL")


def density_by_key(records: DataFrame, selected: int | None, by: Sequence[str] = ()) -> DataFrame:
    """Mean density and row count per key at the selected minute."""
    at = _selected(F.col("minute"), selected)
    return _per_key(records, by, at).groupBy(*by, "key").agg(F.avg("density").alias("density"), F.count(F.lit(1)).alias("rows"))


def density_range_by_key(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _per_key(records, by).groupBy(*by, "key").agg(F.min("density").alias("min"), F.max("density").alias("max"))


def density_figures_by_key(records: DataFrame, selected: int | None, by: Sequence[str] = ()) -> DataFrame:
    """Both of the above in one pass; density and rows are null for keys the minute misses."""
    at = _selected(F.col("minute"), selected)
    rows = F.count_if(at)
    return _per_key(records, by).groupBy(*by, "key").agg(
        F.avg(F.when(at, F.col("density"))).alias("density"),
        F.when(rows > 0, rows).alias("rows"),
        F.min("density").alias("min"),
        F.max("density").alias("max"),
    )


def available_minutes(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct minutes with records, rounded to 3, in order."""
    minutes = records.filter("minute IS NOT NULL").select(*by, times.nearest_step(F.col("minute")).alias("minute"))
    return minutes.distinct().orderBy(*by, "minute")


def bounding_box(features: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Box around all points, as one row; the map file's own bounds win; 0 without points."""
    point = features.select(F.explode("coordinates").alias("p"))
    lat, lon = F.col("p")[0], F.col("p")[1]
    box = point.agg(
        F.coalesce(F.min(lat), F.lit(0.0)).alias("min_lat"),
        F.coalesce(F.min(lon), F.lit(0.0)).alias("min_lon"),
        F.coalesce(F.max(lat), F.lit(0.0)).alias("max_lat"),
        F.coalesce(F.max(lon), F.lit(0.0)).alias("max_lon"),
    )
    if bounds is None:
        return box
    named = F.struct("min_lat", "min_lon", "max_lat", "max_lon")
    return (
        box.select(named.alias("box"), F.lit(1).alias("_from"))
        .unionByName(bounds.select(named.alias("box"), F.lit(0).alias("_from")))
        .agg(F.min_by("box", "_from").alias("box"))
        .select("box.*")
    )


def envelope(df: DataFrame, path: str = "_file", by: Sequence[str] = ()) -> DataFrame:
    """Column list, row count and number of contributing files; ``path`` holds each row's file."""
    files = df.groupBy(*by, path).agg(F.count(F.lit(1)).alias("_n"))
    names = F.array(*[F.lit(c) for c in df.columns if c != path]).cast("array<string>")
    return files.groupBy(*by).agg(
        F.count(path).alias("object_count"), F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count")
    ).withColumn("columns", names)
