"""Daily traffic and weather figures on the 3-minute grid.

Functions take gold- or silver-like frames: columns are found by their accepted names. ``by``
names what a figure is computed per (a day, or a road and a day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import labels, times, values
from kerbside.operators.aggregates import dominant

DAY = ("date",)


def readings(df: DataFrame, keep: Sequence[str] = DAY) -> DataFrame:
    """Resolved measures of each row: bucket, flow, speed, temperature, wind, precipitation,
    weather; plus ``seen``, by which ties between labels are decided."""
    ts = F.col("rec_ts") if "rec_ts" in df.columns else times.parse_local(F.col("recordDatetime"))
    has_hour = "rec_ts" not in df.columns and dict(df.dtypes).get("hour", "string") != "string"
    road = values.first_text(df, values.ROAD_DISPLAY_CANDIDATES)
    return df.select(
        *keep,
        times.bucket_of(ts, F.col("hour") if has_hour else None).alias("bucket"),
        values.first_number(df, values.FLOW_CANDIDATES).alias("flow"),
        values.first_number(df, values.SPEED_CANDIDATES).alias("speed"),
        values.first_number(df, values.TEMPERATURE_CANDIDATES).alias("temperature"),
        values.first_number(df, values.WIND_CANDIDATES).alias("wind_speed"),
        values.first_number(df, values.PRECIPITATION_CANDIDATES).alias("precipitation"),
        values.first_text(df, values.WEATHER_CANDIDATES).alias("weather"),
        F.struct(ts.alias("ts"), road.alias("road")).alias("seen"),
    )


def _dense(series: DataFrame, by: Sequence[str], slot: str = "bucket", slots: int = times.BUCKETS_PER_DAY) -> DataFrame:
    """Every slot of every group, with nulls where the series has none.

    A group's slots become one day vector, an array with an entry for each, which is unfolded again: the
    series is evaluated once and nothing is joined. A group with only unplaced rows has all its slots too.
    """
    rest = [c for c in series.columns if c not in (*by, slot)]
    placed = F.when(F.col(slot).isNotNull(), F.struct(F.col(slot).cast("int").alias("k"), F.struct(*rest).alias("v")))
    found = F.map_from_entries(F.collect_list(placed))
    numbers = F.sequence(F.lit(0), F.lit(slots - 1))
    vector = F.transform(numbers, lambda k: F.struct(k.alias(slot), F.try_element_at(F.col("_found"), k).alias("v")))
    days = series.groupBy(*by).agg(found.alias("_found"))
    unfolded = days.select(*by, F.inline(vector))
    return unfolded.select(*by, slot, *[F.col("v").getField(c).alias(c) for c in rest])


def _bucket_flow(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.filter("bucket IS NOT NULL").groupBy(*by, "bucket").agg(F.sum("flow").alias("flow"))


def flow_series(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Total flow per bucket; null where no row has a flow."""
    return _dense(_bucket_flow(rows, by), by)


def daily_flow_range(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Greatest and smallest bucket total; 0 without any flow."""
    zero = F.lit(0.0)
    return _bucket_flow(rows, by).groupBy(*by).agg(
        F.coalesce(F.max("flow"), zero).alias("max_flow"), F.coalesce(F.min("flow"), zero).alias("min_flow")
    )


def overall_speed(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Flow-weighted speed over rows with flow; the plain mean when no row has any."""
    return rows.groupBy(*by).agg(_overall_speed().alias("avg_speed"))


def _overall_speed() -> Column:
    flowing = (F.col("flow") > 0) & F.col("speed").isNotNull()
    weighted = F.try_divide(
        F.sum(F.when(flowing, F.col("speed") * F.col("flow"))), F.sum(F.when(flowing, F.col("flow")))
    )
    return F.coalesce(weighted, F.avg("speed"))


def speed_series(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Speed per bucket, weighted by flow, a row without flow weighing 1."""
    weight = F.when(F.col("flow") > 0, F.col("flow")).otherwise(1.0)
    known = rows.filter("speed IS NOT NULL")
    speeds = known.groupBy(*by, "bucket").agg(
        F.try_divide(F.sum(F.col("speed") * weight), F.sum(weight)).alias("avg_speed")
    )
    return _dense(speeds, by)


def dominant_weather(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Most frequent label, lower case; a tie goes to the one seen first."""
    return dominant(rows, by, F.lower("weather"), [F.col("seen")], "dominant_weather")


def _sums_by_label(rows: DataFrame, by: Sequence[str], label: Column, measures: Sequence[str]) -> DataFrame:
    """Rows, first sight, sums and counts of each label of a group: what means and the most frequent
    label are both made of, so that one pass over the rows gives them."""
    sums = [x for m in measures for x in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    return rows.groupBy(*by, label.alias("_label")).agg(F.count(F.lit(1)).alias("_n"), F.min("seen").alias("_first"), *sums)


def _most_frequent() -> Column:
    """Of ``_sums_by_label``: the label of most rows, ties to the first seen, then to the alphabet."""
    rank = F.struct((-F.col("_n")).alias("n"), "_first", "_label")
    return F.min(F.when(F.col("_label").isNotNull(), rank)).getField("_label")


def _mean(measure: str, of: Column | None = None) -> Column:
    total, n = F.col(f"{measure}_sum"), F.col(f"{measure}_n")
    if of is not None:
        total, n = F.when(of, total), F.when(of, n)
    return F.try_divide(F.sum(total), F.sum(n))


def _rain_columns() -> list[Column]:
    wet, rainy = labels.is_rainy(_most_frequent()), labels.is_rainy(F.col("_label"))
    return [
        _most_frequent().alias("dominant_weather"),
        F.when(wet, _mean("temperature", rainy)).alias("avg_temperature"),
        F.when(wet, _mean("precipitation", rainy)).alias("avg_precipitation"),
    ]


def rain_means(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Mean temperature and precipitation over rainy rows, on days mostly of rain; else null."""
    sums = _sums_by_label(rows, by, F.lower("weather"), ["temperature", "precipitation"])
    return sums.groupBy(*by).agg(*_rain_columns())


def daily_summary(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Flow range, speed, dominant weather and rain means per group.

    The rows are grouped by bucket and by label in one pass (grouping sets); a group's figures come from
    both kinds of sums. A group without a bucket has no row.
    """
    flowing = (F.col("flow") > 0) & F.col("speed").isNotNull()
    parts = rows.select(
        *by, "bucket", F.lower("weather").alias("_label"), "seen", "flow", "temperature", "precipitation", "speed",
        F.when(flowing, F.col("speed") * F.col("flow")).alias("_moved"), F.when(flowing, F.col("flow")).alias("_moving"),
    )
    sums = [x for m in ("temperature", "precipitation", "speed") for x in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))]
    sets = [[F.col(c) for c in (*by, part)] for part in ("bucket", "_label")]
    sums = parts.groupingSets(sets, *by, "bucket", "_label").agg(
        F.grouping("bucket").alias("_by_label"), F.sum("flow").alias("flow"), F.count(F.lit(1)).alias("_n"), F.min("seen").alias("_first"),
        F.sum("_moved").alias("_moved"), F.sum("_moving").alias("_moving"), *sums,
    )
    per_bucket = (F.col("_by_label") == 0) & F.col("bucket").isNotNull()
    per_label = F.col("_by_label") == 1
    # Sums by bucket take no part in figures by label.
    hidden = {c: F.when(per_label, F.col(c)) for c in sums.columns if c.endswith(("_sum", "_n")) or c in ("_label", "_moved", "_moving")}
    buckets = F.when(per_bucket, F.col("flow"))
    sums = sums.withColumns({**hidden, "_bucket_flow": buckets, "_placed": per_bucket})
    speed = F.coalesce(F.try_divide(F.sum("_moved"), F.sum("_moving")), _mean("speed"))
    return sums.groupBy(*by).agg(
        F.coalesce(F.max("_bucket_flow"), F.lit(0.0)).alias("max_flow"), F.coalesce(F.min("_bucket_flow"), F.lit(0.0)).alias("min_flow"),
        speed.alias("avg_speed"), *_rain_columns(), F.bool_or("_placed").alias("_any"),
    ).filter("_any").drop("_any")


def weather_series(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Per bucket: mean temperature, wind and precipitation, and the dominant label."""
    measures = ["temperature", "wind_speed", "precipitation"]
    sums = _sums_by_label(rows, [*by, "bucket"], F.col("weather"), measures)
    series = sums.groupBy(*by, "bucket").agg(*[_mean(m).alias(m) for m in measures], _most_frequent().alias("weather"))
    return _dense(series, by)


def hourly_weather(rows: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """All 24 hours of every group: dominant label, lower case, and mean temperature, null where
    an hour has no rows."""
    timed = rows.filter("bucket IS NOT NULL")
    hours = timed.withColumn("hour", F.least(F.lit(23), F.floor(F.col("bucket") / 20)).cast("int"))
    sums = _sums_by_label(hours, [*by, "hour"], F.lower("weather"), ["temperature"])
    series = sums.groupBy(*by, "hour").agg(_mean("temperature").alias("temperature"), _most_frequent().alias("weather"))
    return _dense(series, by, "hour", 24)


def current_weather(series: DataFrame, limit: Column, by: Sequence[str] = DAY) -> DataFrame:
    """Latest bucket up to ``limit`` that has a temperature or a label."""
    usable = series.filter((F.col("bucket") <= limit) & (F.col("temperature").isNotNull() | F.col("weather").isNotNull()))
    point = F.max_by(F.struct("bucket", "temperature", "weather", "wind_speed", "precipitation"), "bucket")
    return usable.groupBy(*by).agg(point.alias("_p")).select(*by, "_p.*")
