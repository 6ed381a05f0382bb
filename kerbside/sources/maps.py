"""Road dimensions: lookup CSV, way lookup JSON, map XML and network XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.joins import polylines, with_edge_ids, with_point_counts
from kerbside.operators.filters import drawable_ways, real_edges
from kerbside.schemas import BOUNDS_XML, NET_EDGE_XML, NODE_XML, ROAD_LOOKUP, WAY_LOOKUP, WAY_XML


def read_roads(spark: SparkSession, path: str) -> DataFrame:
    """Road lookup: one row per name, the first in the files; coordinates as doubles.

    ``min_by`` over file, block and line order combines on the map side.
    """
    lines = spark.read.schema(ROAD_LOOKUP).option("header", "true").csv(path)
    position = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    placed = lines.select("*", position.alias("_at"))
    first = placed.groupBy("name").agg(F.min_by(F.struct("way_id", "lat", "lon"), "_at").alias("r"))
    return first.select(
        F.col("r.way_id").alias("way_id"), "name",
        F.col("r.lat").try_cast("double").alias("lat"), F.col("r.lon").try_cast("double").alias("lon"),
    )


def read_way_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Way lookup: a JSON array of ways with a class and a centre point."""
    return spark.read.schema(WAY_LOOKUP).option("multiLine", "true").json(path)


def _xml(spark: SparkSession, path: str, tag: str, schema) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def _tag(key: str) -> Column:
    """Value of the way's last tag of that key."""
    hits = F.filter(F.coalesce(F.col("tag"), F.array()), lambda t: t["_k"] == key)
    return F.try_element_at(F.transform(hits, lambda t: t["_v"]), F.lit(-1))


def read_ways(spark: SparkSession, path: str) -> DataFrame:
    """Ways of a map file: id, name, road class and the ids of their points in order."""
    return _xml(spark, path, "way", WAY_XML).select(
        F.col("_id").alias("way_id"),
        _tag("name").alias("name"),
        _tag("highway").alias("highway"),
        F.transform(F.coalesce(F.col("nd"), F.array()), lambda n: n["_ref"]).alias("refs"),
    )


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    nodes = _xml(spark, path, "node", NODE_XML).select(
        F.col("_id").alias("node_id"),
        F.col("_lat").try_cast("double").alias("lat"),
        F.col("_lon").try_cast("double").alias("lon"),
    )
    return nodes.dropna()


def read_bounds(spark: SparkSession, path: str) -> DataFrame:
    """The map file's own bounding box: one row, or none."""
    return _xml(spark, path, "bounds", BOUNDS_XML).select(*[
        F.col(f"_{short}").cast("double").alias(name)
        for short, name in [("minlat", "min_lat"), ("minlon", "min_lon"), ("maxlat", "max_lat"), ("maxlon", "max_lon")]
    ])


def read_net_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edge ids of a network file without internal ones."""
    edges = _xml(spark, path, "edge", NET_EDGE_XML).select(F.coalesce("_id", F.lit("")).alias("id"))
    return real_edges(edges)


def _named_with_edges(ways: DataFrame, edges: DataFrame) -> DataFrame:
    """Ways that fail on name, class or edges leave before their points are looked up."""
    named = ways.filter("name IS NOT NULL AND name <> '' AND highway IS NOT NULL AND highway <> ''")
    return with_edge_ids(named, edges).filter(F.size("edge_ids") >= 1)


def map_features(ways: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Drawable ways with their edge ids and coordinates."""
    lines = polylines(_named_with_edges(ways, edges), nodes)
    return drawable_ways(lines).select("way_id", "edge_ids", "name", "highway", "coordinates")


def features_without_lines(ways: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``map_features`` without the coordinates, for figures on the map that draw no line."""
    counted = with_point_counts(_named_with_edges(ways, edges), nodes)
    return drawable_ways(counted).select("way_id", "edge_ids", "name", "highway")
