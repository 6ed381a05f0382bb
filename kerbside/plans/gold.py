"""Silver to gold: hourly peak and minimum flow, congestion, published names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import times, values
from kerbside.operators.aggregates import affected, hourly_flow_stats
from kerbside.operators.filters import on_dates_of, on_partitions_of
from kerbside.operators.joins import touched, with_hour_stats
from kerbside.operators.sets import merge_latest
from kerbside.operators.windows import hourly_extremes
from kerbside.schemas import GOLD_COLUMNS, GOLD_KEYS, HOUR_KEYS
from kerbside.session import pin


def to_contract(rows: DataFrame) -> DataFrame:
    """Published gold columns of silver rows that carry peakFlow and minFlow."""
    return (
        rows.withColumnRenamed("road_name", "roadName")
        .withColumns({
            "totalVehicle": values.whole_vehicles(F.col("total_entered")),
            "congestionHour": values.congestion_flag(F.col("avg_speed")),
            "actualFlow": F.col("avg_flow"),
        })
        .select(*GOLD_COLUMNS)
    )


def with_hour(gold: DataFrame) -> DataFrame:
    """Published gold rows with the ``hour`` their table is partitioned by."""
    ts = times.parse_minute_text(F.col("recordDatetime"))
    return gold.withColumn("hour", times.hour_of_day(ts, F.col("date")))


def build_gold(silver: DataFrame) -> DataFrame:
    """One pass: the hour's extremes come from a window over its at most 60 minute rows."""
    return to_contract(hourly_extremes(silver, HOUR_KEYS))


def build_gold_by_join(silver: DataFrame) -> DataFrame:
    """Same rows through a grouped summary joined back."""
    return to_contract(with_hour_stats(silver, hourly_flow_stats(silver, HOUR_KEYS), HOUR_KEYS))


def refresh_gold(changed: DataFrame, silver: DataFrame) -> DataFrame:
    """Gold rows to upsert after silver rows changed: every row of each touched road-hour,
    since a new interval can move the peak of rows published before."""
    hours = affected(changed, HOUR_KEYS)
    return build_gold(touched(on_dates_of(silver, hours), hours, HOUR_KEYS))


def refresh_gold_from_published(new_rows: DataFrame, gold: DataFrame) -> DataFrame:
    """The same refresh built from the published table: new silver rows replace published rows of their key, and
    the extremes of the touched hours come from the merged rows in one pass. ``gold`` carries ``hour``."""
    fresh = pin(with_hour(to_contract(new_rows.withColumns({c: F.lit(None).cast("double") for c in ("peakFlow", "minFlow")}))))
    gold_hours = ["roadName", "date", "hour"]
    hours = affected(fresh, gold_hours)
    published = touched(on_partitions_of(gold, hours, ["date", "hour"]), hours, gold_hours)
    merged = merge_latest(fresh, published, GOLD_KEYS)
    return hourly_extremes(merged, gold_hours, "actualFlow").select(*GOLD_COLUMNS)
