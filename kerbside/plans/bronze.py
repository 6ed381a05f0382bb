"""Landing rows to typed bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import times
from kerbside.operators.windows import keep_first
from kerbside.schemas import BRONZE_TRAFFIC_KEYS, TRAFFIC_MEASURES


def to_bronze_traffic(landing: DataFrame, clock: Column | None = None) -> DataFrame:
    """Measures as doubles (text that is no number gives null), event time from date and end.

    ``rec_ts`` is the event time as a timestamp, kept beside its published text. ``date``
    stays the interval's own day, also for the one that ends at 24:00.
    """
    rec_ts = times.interval_time(F.col("date"), F.col("end"))
    measures = [
        F.col(name).try_cast("double").alias("timeloss" if name == "timeLoss" else name) for name in TRAFFIC_MEASURES
    ]
    return landing.select(
        "id",
        "road_name",
        times.minute_text(rec_ts).alias("recordDatetime"),
        *measures,
        times.processed_at(clock).alias("processDatetime"),
        F.col("date").try_cast("date").alias("date"),
        F.date_trunc("MINUTE", rec_ts).alias("rec_ts"),
    )


def to_bronze_weather(landing: DataFrame, clock: Column | None = None) -> DataFrame:
    return landing.select(
        "road_id",
        "road_name",
        times.minute_text(times.interval_time(F.col("date"), F.col("end"))).alias("datetime"),
        "temperature",
        "windspeed",
        "humidity",
        "precipitation",
        "weather",
        times.processed_at(clock).alias("processDatetime"),
        F.col("date").try_cast("date").alias("date"),
    )


def with_bronze_hour(bronze: DataFrame) -> DataFrame:
    """Bronze traffic rows with the ``hour`` their table is partitioned by."""
    return bronze.withColumn("hour", times.hour_of_day(F.col("rec_ts"), F.col("date")))


def newest_traffic(bronze: DataFrame) -> DataFrame:
    """One row per edge and interval, the newest processed winning over retried copies. Rows
    without an edge or a time all stay: nothing says that they are the same reading."""
    tie = [c for c in ("_batch", "road_name", "speed", "flow", "entered", "left") if c in bronze.columns]
    order = [F.col(c).desc_nulls_last() for c in ("processDatetime", *tie)]
    return keep_first(bronze, BRONZE_TRAFFIC_KEYS, order, whole_keys=True)
