"""One day through all layers in batch, and the layers' tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from kerbside.operators.filters import has_hourly_rows, on_date
from kerbside.plans.bronze import newest_traffic, to_bronze_traffic, with_bronze_hour
from kerbside.plans.gold import build_gold, with_hour
from kerbside.plans.silver import build_silver
from kerbside.schemas import (
    BRONZE_TRAFFIC, BRONZE_TRAFFIC_KEYS, BRONZE_WEATHER, BRONZE_WEATHER_KEYS, GOLD, GOLD_KEYS, LANDING_TRAFFIC, SILVER, SILVER_KEYS,
)
from kerbside.sources.landing import read_landing
from kerbside.sources.tables import Layer, append_batch, exists, read_layer, replace_date

# Batch number of backfilled rows; micro-batches count from 0.
BACKFILL_BATCH = -1


@dataclass(frozen=True)
class Lake:
    """The four layer tables under one root.

    Bronze only grows, by numbered batches; its readers keep the newest row per key. Traffic,
    silver and gold are partitioned by date and hour, the grain at which silver and gold are
    recomputed: a trigger reads and rewrites the hours it touches and not whole days.
    """

    root: str

    @property
    def traffic(self) -> Layer:
        return Layer(f"{self.root}/bronze/traffic", BRONZE_TRAFFIC_KEYS, ("date", "hour", "_batch"), BRONZE_TRAFFIC)

    @property
    def weather(self) -> Layer:
        return Layer(f"{self.root}/bronze/weather", BRONZE_WEATHER_KEYS, ("date", "_batch"), BRONZE_WEATHER)

    @property
    def silver(self) -> Layer:
        return Layer(f"{self.root}/silver", SILVER_KEYS, ("date", "hour"), SILVER)

    @property
    def gold(self) -> Layer:
        return Layer(f"{self.root}/gold", GOLD_KEYS, ("date", "hour"), GOLD)


def backfill_day(
    spark: SparkSession,
    lake: Lake,
    landing_path: str,
    day: str,
    hourly_weather: DataFrame,
    clock: Column | None = None,
    layout: str = "{day}",
) -> None:
    """Load one day's landing files and rebuild its silver and gold partitions.

    ``hourly_weather`` (bronze weather rows) is loaded only when the day has no on-the-hour
    weather yet. Running a day again leaves the tables as they are.
    """
    landing = read_landing(spark, landing_path, LANDING_TRAFFIC, day, layout)
    if landing.isEmpty():
        raise ValueError(f"no landing rows for {day}")
    append_batch(with_bronze_hour(to_bronze_traffic(landing, clock)), BACKFILL_BATCH, lake.traffic)

    known = exists(spark, lake.weather) and has_hourly_rows(read_layer(spark, lake.weather), day).first()[0]
    if not known:
        append_batch(on_date(hourly_weather, day), BACKFILL_BATCH, lake.weather)

    traffic = newest_traffic(on_date(read_layer(spark, lake.traffic), day))
    weather = on_date(read_layer(spark, lake.weather), day)
    replace_date(build_silver(traffic, weather, "hour"), lake.silver, day)
    replace_date(with_hour(build_gold(on_date(read_layer(spark, lake.silver), day))), lake.gold, day)
