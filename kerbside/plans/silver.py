"""Bronze to silver: one row per road and interval with the weather at the time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import times
from kerbside.operators.aggregates import lanes_to_roads
from kerbside.operators.filters import named_roads
from kerbside.operators.joins import with_weather, with_weather_as_of
from kerbside.schemas import SILVER_COLUMNS


def lane_rollup(bronze: DataFrame) -> DataFrame:
    """Roads' lanes combined, before weather; adds ``recordDatetime`` and ``hour``."""
    rows = lanes_to_roads(named_roads(bronze), ["road_name", "date", "rec_ts"])
    return rows.withColumns({
        "recordDatetime": times.minute_text(F.col("rec_ts")),
        "hour": times.hour_of_day(F.col("rec_ts"), F.col("date")),
    })


def build_silver(bronze: DataFrame, weather: DataFrame, grain: str = "interval") -> DataFrame:
    """Silver rows with their ``rec_ts`` and ``hour``.

    Lanes are combined first and weather joined to the few resulting rows: weather is one row
    per road and time, so the order does not change the result but shrinks the join, and on
    the interval grain the join reuses the group-by's partitioning.

    ``grain``: "interval" (3-minute floor), "hour" (hourly floor), or "as_of" (latest reading
    of the last 60 minutes).
    """
    rows = lane_rollup(bronze)
    joined = with_weather_as_of(rows, weather) if grain == "as_of" else with_weather(rows, weather, grain)
    return joined.select(*SILVER_COLUMNS, "rec_ts", "hour")


def published(silver: DataFrame) -> DataFrame:
    """The silver contract's columns only."""
    return silver.select(*SILVER_COLUMNS)
