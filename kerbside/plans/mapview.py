"""Density on the road map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import labels, roads
from kerbside.operators.aggregates import density_by_key, density_figures_by_key
from kerbside.operators.joins import by_first_matching_key


def with_feature_keys(features: DataFrame) -> DataFrame:
    """``keys`` of each map feature, best first: way id, its edges' keys, then its name's."""
    edge_lists = F.flatten(F.transform("edge_ids", roads.edge_keys))
    name = F.col("name")
    named = F.when(name.isNotNull(), F.concat(F.array(name), roads.name_keys(name)))
    keys = F.concat(F.array(F.col("way_id").cast("string")), edge_lists, F.coalesce(named, F.array().cast("array<string>")))
    return features.withColumn("keys", F.array_distinct(keys))


def density_map(features: DataFrame, records: DataFrame, selected: int | None) -> DataFrame:
    """Each feature with its density at the selected minute, the day's range and its class."""
    keyed = with_feature_keys(features).select("way_id", "name", "highway", "keys")
    found = by_first_matching_key(
        keyed, "way_id", "keys", density_figures_by_key(records, selected),
        {"rows": ["density", "rows"], "min": ["min", "max"]},
    )
    return found.select(
        "way_id", "name", "highway", "density",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.col("min").alias("day_min_density"),
        F.col("max").alias("day_max_density"),
        labels.density_class(F.col("density"), F.col("highway")).alias("density_class"),
        F.col("density").isNotNull().alias("matched"),
    )


def matched_features(features: DataFrame, records: DataFrame, selected: int | None) -> DataFrame:
    """``matched`` of each feature as ``density_map`` has it, from the records of the selected minute alone."""
    keyed = with_feature_keys(features).select("way_id", "keys")
    found = by_first_matching_key(keyed, "way_id", "keys", density_by_key(records, selected), {"density": ["density"]})
    return found.select("way_id", F.col("density").isNotNull().alias("matched"))


def map_summary(mapped: DataFrame, by_key: DataFrame) -> DataFrame:
    """Matched features and the greatest selected density (0 without any), as one row.

    ``mapped`` needs no column but ``matched``.
    """
    greatest = by_key.agg(F.coalesce(F.max("density"), F.lit(0.0)).alias("d")).scalar()
    return mapped.agg(F.count_if("matched").alias("matched_features")).withColumn("max_density", greatest)
