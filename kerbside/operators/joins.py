"""Joins between traffic, weather, roads and the road graph.

No side is hinted for broadcast: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts or hashes, splitting skewed
partitions at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import roads, times
from kerbside.operators.windows import carry_forward, keep_first
from kerbside.schemas import WEATHER_VALUES


def latest_weather(weather: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """One weather row per road and time, the newest processed winning, so that a repeated
    reading cannot multiply traffic rows."""
    order = [F.col(c).desc_nulls_last() for c in ("processDatetime", *tie, *WEATHER_VALUES) if c in weather.columns]
    return keep_first(weather, ["road_name", "datetime"], order)


def with_weather(traffic: DataFrame, weather: DataFrame, grain: str = "interval") -> DataFrame:
    """Left join on road and floored time; traffic without weather stays.

    ``grain`` "interval" floors to 3 minutes, "hour" to the hour; a reading between two marks
    meets no traffic. ``traffic`` carries ``rec_ts``.
    """
    floored = times.floor_hour(F.col("rec_ts")) if grain == "hour" else times.floor_minutes(F.col("rec_ts"))
    readings = latest_weather(weather).select(
        "road_name", times.parse_minute_text(F.col("datetime")).alias("weather_ts"), *WEATHER_VALUES
    )
    keyed = traffic.withColumn("weather_ts", floored)
    return keyed.join(readings, ["road_name", "weather_ts"], "left").drop("weather_ts")


def with_weather_as_of(
    traffic: DataFrame, weather: DataFrame, max_age_minutes: int = 60, unit: str = "HOUR"
) -> DataFrame:
    """Latest reading at or before the interval end, no older than ``max_age_minutes``.

    Both sides are stacked and the readings carried forward: linear work, no pairing of
    traffic with every reading of its hour.
    """
    columns = traffic.columns
    readings = latest_weather(weather).select(
        "road_name",
        times.parse_minute_text(F.col("datetime")).alias("rec_ts"),
        F.lit(0).alias("_side"),
        F.struct(times.parse_minute_text(F.col("datetime")).alias("seen_ts"), *WEATHER_VALUES).alias("_reading"),
    )
    stacked = traffic.withColumn("_side", F.lit(1)).unionByName(readings, allowMissingColumns=True)
    filled = carry_forward(stacked, ["road_name"], "rec_ts", "_reading", unit, tie=["_side"])
    age = F.unix_seconds("rec_ts") - F.unix_seconds("_reading.seen_ts")
    fresh = F.when(age <= max_age_minutes * 60, F.col("_reading"))
    return filled.filter(F.col("_side") == 1).select(
        *columns, *[fresh.getField(name).alias(name) for name in WEATHER_VALUES]
    )


def touched(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys, list(on), "left_semi")


def untouched(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``; a null key never matches."""
    return df.join(keys, list(on), "left_anti")


def with_hour_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach hourly figures, dropping stale ones the rows may still carry."""
    fresh = [c for c in stats.columns if c not in keys]
    return df.drop(*fresh).join(stats, list(keys), "left")


def with_road_names(edges: DataFrame, ways: DataFrame, edge_column: str = "id") -> DataFrame:
    """``road_name`` of the way behind each edge; null when the way has no name."""
    names = ways.select(F.col("way_id").alias("_way"), F.col("name").alias("road_name"))
    keyed = edges.withColumn("_way", roads.way_of_edge(F.col(edge_column)))
    return keyed.join(names, "_way", "left").drop("_way")


def edge_ids_per_way(edges: DataFrame, edge_column: str = "id") -> DataFrame:
    """Sorted distinct edge ids of every way; a way's edges are the parts it was cut into."""
    parts = edges.select(roads.way_of_edge(F.col(edge_column)).alias("way_id"), F.col(edge_column).alias("_edge"))
    grouped = parts.filter("way_id IS NOT NULL").groupBy("way_id")
    return grouped.agg(F.array_sort(F.collect_set("_edge")).alias("edge_ids"))


def with_edge_ids(ways: DataFrame, edges: DataFrame, edge_column: str = "id") -> DataFrame:
    """Ways with their edge ids; a way no edge refers to gets an empty list."""
    none = F.array().cast("array<string>")
    joined = ways.join(edge_ids_per_way(edges, edge_column), "way_id", "left")
    return joined.withColumn("edge_ids", F.coalesce("edge_ids", none))


def _points_of_ways(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each way's points in rows, with the place of those that resolve to a node.

    ``ways.refs`` holds the node ids; a way's other columns travel with its first point as ``_way``, so the ways are
    read once and not joined back.
    """
    places = nodes.select(F.col("node_id").alias("_ref"), "lat", "lon")
    rest = [c for c in ways.columns if c != "way_id"]
    listed = ways.select("way_id", F.struct(*rest).alias("_way"), F.posexplode_outer("refs").alias("_pos", "_ref"))
    first = F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col("_way"))
    return listed.select("way_id", "_pos", "_ref", first.alias("_way")).join(places, "_ref", "left")


def with_point_counts(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """``points`` = how many coordinates ``polylines`` would give each way: they are counted, not collected."""
    counted = _points_of_ways(ways, nodes).groupBy("way_id").agg(
        F.first("_way", ignorenulls=True).alias("_way"), F.count("lat").alias("points"))
    return counted.select("way_id", "_way.*", "points")


def polylines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """``coordinates`` = [lat, lon] of each way's points in the order it lists them.

    Points that resolve to no node are left out.
    """
    found = _points_of_ways(ways, nodes)
    point = F.when(F.col("lat").isNotNull(), F.struct("_pos", "lat", "lon"))
    lines = found.groupBy("way_id").agg(
        F.first("_way", ignorenulls=True).alias("_way"),
        F.transform(F.array_sort(F.collect_list(point)), lambda p: F.array(p["lat"], p["lon"])).alias("coordinates"),
    )
    return lines.select("way_id", "_way.*", "coordinates")


def by_first_matching_key(
    features: DataFrame, feature_id: str, keys: str, lookup: DataFrame, figures: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Features with figures of their best key: ``keys`` lists the keys best first.

    ``lookup`` has one row per ``key``. ``figures`` maps a column that tells whether a key has
    a figure (not null) to the columns taken with it; each figure is matched by itself, all in
    one join. Features without any match keep nulls. A feature's other columns travel with its first key.
    """
    taken = [c for columns in figures.values() for c in columns]
    rest = [c for c in features.columns if c not in (feature_id, keys)]
    candidates = features.select(feature_id, F.struct(*rest).alias("_feature"), F.posexplode_outer(keys).alias("_rank", "key"))
    first = F.when(F.coalesce("_rank", F.lit(0)) == 0, F.col("_feature"))
    candidates = candidates.select(feature_id, "_rank", "key", first.alias("_feature"))
    found = candidates.join(lookup.select("key", *{*figures, *taken}), "key", "left")
    # Most keys have no figure; only the first one is kept without any, as it brings the feature.
    figured = reduce(or_, [F.col(present).isNotNull() for present in figures])
    found = found.filter(figured | (F.coalesce("_rank", F.lit(0)) == 0))
    best = [
        F.min_by(F.struct(*columns), F.when(F.col(present).isNotNull(), F.col("_rank"))).alias(f"_best{i}")
        for i, (present, columns) in enumerate(figures.items())
    ]
    unpacked = [F.col(f"_best{i}.{c}").alias(c) for i, columns in enumerate(figures.values()) for c in columns]
    grouped = found.groupBy(feature_id).agg(F.first("_feature", ignorenulls=True).alias("_feature"), *best)
    return grouped.select(feature_id, "_feature.*", *unpacked)


def interval_grid(dimension: DataFrame, first_end: int = times.INTERVAL_MINUTES) -> DataFrame:
    """Every row of ``dimension`` once per interval end of the day (``end_minute``)."""
    return dimension.withColumn("end_minute", F.explode(times.day_schedule(F.lit(first_end))))


def neighbour_mean_of_rows(state: DataFrame, edges: DataFrame, road: str, density: str) -> DataFrame:
    """Mean density over all rows of a road's neighbours, per hop (1 and 2); 0 without any.

    Rows are summed per road before they meet the edges, so a hub multiplies one summary row.
    """
    sums = state.groupBy(F.col(road).alias("dst")).agg(F.sum(density).alias("_sum"), F.count(density).alias("_n"))
    return _mean_per_hop(sums, edges, road)


def neighbour_mean_of_roads(state: DataFrame, edges: DataFrame, road: str, density: str) -> DataFrame:
    """Mean over a road's neighbours of the one value each has, per hop; 0 without any."""
    single = state.select(F.col(road).alias("dst"), F.col(density).alias("_sum"), F.lit(1).alias("_n"))
    return _mean_per_hop(single, edges, road)


def _mean_per_hop(sums: DataFrame, edges: DataFrame, road: str) -> DataFrame:
    means = []
    for hop in (1, 2):
        at = F.col("hop") == hop
        mean = F.try_divide(F.sum(F.when(at, F.col("_sum"))), F.sum(F.when(at, F.col("_n"))))
        means.append(F.coalesce(mean, F.lit(0.0)).alias(f"neighbor_density_hop{hop}"))
    return edges.join(sums, "dst").groupBy(F.col("src").alias(road)).agg(*means)


def with_neighbour_means(df: DataFrame, means: DataFrame, road: str) -> DataFrame:
    """Attach the hop means; a road without neighbours gets zeros."""
    hops = ["neighbor_density_hop1", "neighbor_density_hop2"]
    return df.join(means, road, "left").withColumns({h: F.coalesce(h, F.lit(0.0)) for h in hops})
