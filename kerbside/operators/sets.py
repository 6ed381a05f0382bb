"""Set comparison and merging of layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import values
from kerbside.operators.windows import keep_first


def merge_latest(new: DataFrame, old: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """New and old rows under one schema, one row per key: the new one, then by ``order``."""
    both = new.withColumn("_age", F.lit(0)).unionByName(old.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, keys, [F.col("_age"), *order]).drop("_age")


def road_membership(df: DataFrame, start: str, end: str) -> DataFrame:
    """Roads of two dates in one pass: ``side`` is only_in_start, only_in_end or shared."""
    column = values.first_column(df, values.ROAD_CANDIDATES)
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    named = df.filter(F.col("date").isin(first, last)).select(values.text_of(df, column).alias("road_name"), "date")
    seen = named.filter("road_name IS NOT NULL").groupBy("road_name").agg(
        F.bool_or(F.col("date") == first).alias("_start"), F.bool_or(F.col("date") == last).alias("_end")
    )
    side = F.when(F.col("_start") & F.col("_end"), "shared").when(F.col("_start"), "only_in_start").otherwise("only_in_end")
    return seen.select("road_name", side.alias("side")).orderBy("road_name")


def road_comparison(df: DataFrame, start: str, end: str) -> DataFrame:
    """Counts of the two dates' road sets and of their three parts."""
    if start > end:
        raise ValueError("start date must not be after end date")
    sides = road_membership(df, start, end)

    def tally(name: str) -> Column:
        return F.count_if(F.col("side") == name)

    return sides.agg(
        (tally("only_in_start") + tally("shared")).alias("start_unique_roads"),
        (tally("only_in_end") + tally("shared")).alias("end_unique_roads"),
        tally("only_in_start").alias("only_in_start"),
        tally("only_in_end").alias("only_in_end"),
        tally("shared").alias("shared"),
    )
