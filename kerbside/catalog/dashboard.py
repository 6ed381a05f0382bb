"""Daily figures on the 3-minute grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.plans import dashboard as plan

# Resolved measures of gold rows, as `plan.readings` takes them.
ROWS = base.gold_sql() + """,
rows_ AS (
  SELECT date, (hour(rec_ts) * 60 + minute(rec_ts)) // 3 AS bucket, actualFlow AS flow, avg_speed AS speed, temperature,
         windspeed AS wind_speed, precipitation, weather, rec_ts, roadName AS road
  FROM gold),
grid AS (SELECT date, bucket FROM (SELECT DISTINCT date FROM rows_), range(480) t(bucket))"""


def dominant_sql(by: str, label: str, name: str) -> str:
    return f""",
{name} AS (
  SELECT {by}, label FROM (
    SELECT {by}, {label} AS label, count(*) AS n, min((rec_ts, road)) AS seen FROM rows_ WHERE weather IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY n DESC, seen, label) = 1)"""


def _rows(spark, sf_dir):
    return plan.readings(base.gold(spark, sf_dir))


@register("a07_flow_series", with_sql(ROWS, """
SELECT CAST(g.date AS VARCHAR) AS date, CAST(g.bucket AS INTEGER) AS bucket, s.flow
FROM grid g LEFT JOIN (SELECT date, bucket, sum(flow) AS flow FROM rows_ GROUP BY ALL) s USING (date, bucket)"""))
def flow_series(spark, sf_dir):
    return flat(plan.flow_series(_rows(spark, sf_dir)))


@register("a08_daily_flow_range", with_sql(ROWS, """
SELECT CAST(date AS VARCHAR) AS date, max(flow) AS max_flow, min(flow) AS min_flow
FROM (SELECT date, bucket, sum(flow) AS flow FROM rows_ GROUP BY ALL) GROUP BY date"""))
def flow_range(spark, sf_dir):
    return flat(plan.daily_flow_range(_rows(spark, sf_dir)))


_WHOLE_SPEED = """
, whole AS (SELECT road_name, date, floor(value) AS speed, CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS flow,
                   (hour(slot) * 60 + minute(slot)) // 3 AS bucket, event_type FROM bronze)
"""


def _lane_rows(spark, sf_dir):
    """Lane readings themselves, whose whole numbers keep weighted sums exact."""
    lanes = base.bronze_traffic(spark, sf_dir).withColumn("rec_ts", F.col("rec_ts") - F.expr("INTERVAL 3 MINUTES"))
    return plan.readings(lanes.select("date", "rec_ts", "flow", "speed", "road_name"), ["date", "road_name"])


@register("a09_overall_speed", with_sql(base.BRONZE, _WHOLE_SPEED + """
SELECT CAST(date AS VARCHAR) AS date, road_name,
       coalesce(sum(CASE WHEN flow > 0 THEN speed * flow END) / nullif(sum(CASE WHEN flow > 0 THEN flow END), 0), avg(speed)) AS avg_speed
FROM whole GROUP BY ALL"""))
def overall_speed(spark, sf_dir):
    return flat(plan.overall_speed(_lane_rows(spark, sf_dir), ["date", "road_name"]))


@register("a10_speed_series", with_sql(base.BRONZE, _WHOLE_SPEED + """
, s AS (SELECT date, bucket, sum(speed * CASE WHEN flow > 0 THEN flow ELSE 1 END) / sum(CASE WHEN flow > 0 THEN flow ELSE 1 END) AS avg_speed
        FROM whole GROUP BY ALL)
SELECT CAST(d.date AS VARCHAR) AS date, CAST(b.bucket AS INTEGER) AS bucket, s.avg_speed
FROM (SELECT DISTINCT date FROM whole) d CROSS JOIN range(480) b(bucket) LEFT JOIN s ON s.date = d.date AND s.bucket = b.bucket"""))
def speed_series(spark, sf_dir):
    return flat(plan.speed_series(_lane_rows(spark, sf_dir)))


@register("a11_dominant_weather", with_sql(ROWS + dominant_sql("date", "lower(weather)", "top"), """
SELECT CAST(date AS VARCHAR) AS date, label AS dominant_weather FROM top"""))
def dominant_weather(spark, sf_dir):
    return flat(plan.dominant_weather(_rows(spark, sf_dir)))


@register("a12_rain_means", with_sql(ROWS + dominant_sql("date", "lower(weather)", "top"), """
SELECT CAST(date AS VARCHAR) AS date, top.label AS dominant_weather,
       CASE WHEN contains(top.label, 'rain') THEN avg(temperature) FILTER (WHERE contains(lower(weather), 'rain')) END AS avg_temperature,
       CASE WHEN contains(top.label, 'rain') THEN avg(precipitation) FILTER (WHERE contains(lower(weather), 'rain')) END AS avg_precipitation
FROM rows_ LEFT JOIN top USING (date) GROUP BY date, top.label"""))
def rain_means(spark, sf_dir):
    return flat(plan.rain_means(_rows(spark, sf_dir)))


@register("a13_weather_series", with_sql(ROWS + dominant_sql("date, bucket", "trim(weather)", "top"), """
, m AS (SELECT date, bucket, avg(temperature) AS temperature, avg(wind_speed) AS wind_speed, avg(precipitation) AS precipitation
        FROM rows_ GROUP BY ALL)
SELECT CAST(g.date AS VARCHAR) AS date, CAST(g.bucket AS INTEGER) AS bucket, m.temperature, m.wind_speed, m.precipitation, top.label AS weather
FROM grid g LEFT JOIN m USING (date, bucket) LEFT JOIN top USING (date, bucket)"""))
def weather_series(spark, sf_dir):
    return flat(plan.weather_series(_rows(spark, sf_dir)))


_HOURS = ROWS.replace("rows_ AS (", "rows_ AS (SELECT *, CAST(least(23, bucket // 20) AS INTEGER) AS h FROM (").replace("FROM gold),\ngrid", "FROM gold)),\ngrid")


@register("a14_hourly_weather", with_sql(_HOURS + dominant_sql("date, h", "lower(weather)", "top"), """
, d AS (SELECT DISTINCT date, unnest(range(24))::INTEGER AS h FROM rows_)
SELECT CAST(d.date AS VARCHAR) AS date, d.h AS hour, avg(r.temperature) AS temperature, any_value(top.label) AS weather
FROM d LEFT JOIN rows_ r ON r.date = d.date AND r.h = d.h LEFT JOIN top ON d.date = top.date AND d.h = top.h GROUP BY d.date, d.h"""))
def hourly_weather(spark, sf_dir):
    return flat(plan.hourly_weather(_rows(spark, sf_dir)))


@register("w04_current_weather", with_sql(ROWS + dominant_sql("date, bucket", "trim(weather)", "top"), """
, m AS (SELECT date, bucket, avg(temperature) AS temperature, avg(wind_speed) AS wind_speed, avg(precipitation) AS precipitation
        FROM rows_ GROUP BY ALL)
SELECT CAST(date AS VARCHAR) AS date, CAST(bucket AS INTEGER) AS bucket, temperature, top.label AS weather, wind_speed, precipitation
FROM m LEFT JOIN top USING (date, bucket) WHERE bucket <= 250 AND (temperature IS NOT NULL OR top.label IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY date ORDER BY bucket DESC) = 1"""))
def current_weather(spark, sf_dir):
    series = plan.weather_series(_rows(spark, sf_dir))
    return flat(plan.current_weather(series, F.lit(250)))


@register("a08_a12_daily_summary", with_sql(ROWS + dominant_sql("date", "lower(weather)", "top"), """
, flows AS (SELECT date, max(flow) AS max_flow, min(flow) AS min_flow
            FROM (SELECT date, bucket, sum(flow) AS flow FROM rows_ GROUP BY ALL) GROUP BY date)
SELECT CAST(date AS VARCHAR) AS date, any_value(max_flow) AS max_flow, any_value(min_flow) AS min_flow,
       round(coalesce(sum(CASE WHEN flow > 0 THEN speed * flow END) / nullif(sum(CASE WHEN flow > 0 AND speed IS NOT NULL THEN flow END), 0), avg(speed)), 6) AS avg_speed,
       any_value(top.label) AS dominant_weather,
       CASE WHEN contains(any_value(top.label), 'rain') THEN avg(temperature) FILTER (WHERE contains(lower(weather), 'rain')) END AS avg_temperature,
       CASE WHEN contains(any_value(top.label), 'rain') THEN avg(precipitation) FILTER (WHERE contains(lower(weather), 'rain')) END AS avg_precipitation
FROM rows_ JOIN flows USING (date) LEFT JOIN top USING (date) GROUP BY date"""))
def daily_summary(spark, sf_dir):
    return flat(plan.daily_summary(_rows(spark, sf_dir)).withColumn("avg_speed", F.round("avg_speed", 6)))
