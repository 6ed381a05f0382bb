"""Weather service payloads to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import labels, times, values


def explode_hourly(df: DataFrame) -> DataFrame:
    """Archive payloads: parallel hourly arrays to one row per hour. Other columns stay."""
    hourly = F.col("hourly")
    zipped = F.arrays_zip(
        hourly["time"].alias("datetime"),
        hourly["temperature_2m"].alias("temperature"),
        hourly["precipitation"].alias("precipitation"),
        hourly["weathercode"].alias("weathercode"),
        hourly["windspeed_10m"].alias("windspeed"),
        hourly["relativehumidity_2m"].alias("humidity"),
    )
    kept = [c for c in df.columns if c != "hourly"]
    rows = df.select(*kept, F.inline(zipped))
    return rows.withColumn("weather", labels.weather_label(F.col("weathercode")))


def current_reading(df: DataFrame) -> DataFrame:
    """Current-weather payloads, with humidity and rain of the matching hour.

    Without a matching hour humidity stays null and rain is 0.0. A payload without current
    weather gives no row; one without a weather code counts as clear sky (code 0).
    """
    now, hourly = F.col("current_weather"), F.col("hourly")
    place = F.array_position(hourly["time"], now["time"])
    code = F.coalesce(now["weathercode"], F.lit(0))

    def at_hour(name: str) -> Column:
        return F.when(place > 0, F.try_element_at(hourly[name], place.cast("int")))

    kept = [c for c in df.columns if c not in ("current_weather", "hourly")]
    return df.filter(now.isNotNull()).select(
        *kept,
        now["time"].alias("datetime"),
        now["temperature"].alias("temperature"),
        now["windspeed"].alias("windspeed"),
        code.alias("weathercode"),
        labels.weather_label(code).alias("weather"),
        at_hour("relativehumidity_2m").alias("humidity"),
        values.rain_or_zero(at_hour("precipitation")).alias("precipitation"),
    )


def archive_to_bronze(hours: DataFrame, clock: Column | None = None) -> DataFrame:
    """Archive hours with ``road_id``, ``road_name`` and ``date`` to bronze weather rows."""
    return hours.select(
        "road_id", "road_name", "datetime", "temperature", "windspeed",
        F.col("humidity").cast("int").alias("humidity"),
        values.rain_or_zero(F.col("precipitation")).alias("precipitation"),
        values.weather_or_unknown(F.col("weather")).alias("weather"),
        times.processed_at(clock).alias("processDatetime"),
        F.col("date").cast("date").alias("date"),
    )
