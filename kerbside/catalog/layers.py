"""Bronze, silver and gold rows, and the incremental gold refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.operators.aggregates import affected, hourly_flow_stats, lanes_to_roads
from kerbside.operators.filters import named_roads, on_date
from kerbside.operators.joins import touched, untouched, with_hour_stats, with_weather
from kerbside.plans.bronze import to_bronze_traffic, to_bronze_weather
from kerbside.plans.gold import build_gold, build_gold_by_join, refresh_gold, refresh_gold_from_published, to_contract, with_hour
from kerbside.plans.silver import build_silver, lane_rollup, published
from kerbside.schemas import HOUR_KEYS


@register("flagship_road_intervals", with_sql(base.gold_sql("hour"), f"SELECT {base.GOLD_OUT} FROM gold"))
def flagship(spark, sf_dir):
    """Per road and interval: speed, flow, weather of the hour, hourly peak and minimum, congestion."""
    return flat(base.gold(spark, sf_dir, "hour"))


@register("p01_p03_bronze_traffic", with_sql(base.BRONZE, """
SELECT id, road_name, recordDatetime, laneDensity, occupancy, waitingTime, speed, sampledSeconds, traveltime,
       flow, entered, left_ AS "left", timeloss, '2024-02-01T00:00' AS processDatetime, CAST(date AS VARCHAR) AS date
FROM bronze"""))
def bronze_traffic(spark, sf_dir):
    return flat(to_bronze_traffic(base.landing_traffic(spark, sf_dir), base.fixed_clock()).drop("rec_ts"))


@register("p02_p04_bronze_weather", with_sql(base.EV, """
SELECT 'w' || user_id AS road_id, road_name, strftime(slot + INTERVAL 3 MINUTE, '%Y-%m-%dT%H:%M') AS datetime,
       CAST(k AS DOUBLE) AS temperature, CAST(user_id % 20 AS DOUBLE) AS windspeed, CAST(k AS INTEGER) AS humidity,
       floor(value) AS precipitation, weather_label AS weather, '2024-02-01T00:00' AS processDatetime,
       CAST(CAST(slot AS DATE) AS VARCHAR) AS date
FROM ev"""))
def bronze_weather(spark, sf_dir):
    return flat(to_bronze_weather(base.landing_weather(spark, sf_dir), base.fixed_clock()))


@register("p05_named_roads", with_sql(base.BRONZE, """
SELECT id, road_name, recordDatetime FROM bronze WHERE road_name IS NOT NULL"""))
def named(spark, sf_dir):
    return named_roads(base.bronze_traffic(spark, sf_dir)).select("id", "road_name", "recordDatetime")


@register("a01_lane_rollup", with_sql(base.silver_sql(), """
SELECT road_name, recordDatetime, avg_speed, avg_density, avg_occupancy, avg_waitingTime, avg_traveltime, avg_flow,
       total_entered, total_left, avg_timeloss, CAST(date AS VARCHAR) AS date, hour
FROM rolled"""))
def rollup(spark, sf_dir):
    return flat(lane_rollup(base.bronze_traffic(spark, sf_dir)).drop("rec_ts"))


@register("j01_silver_interval_weather", with_sql(base.silver_sql(), f"SELECT {base.SILVER_OUT} FROM silver"))
def silver_interval(spark, sf_dir):
    return flat(base.silver_rows(spark, sf_dir))


@register("j01_lanes_with_weather", with_sql(base.BRONZE + base.weather_sql(), """
SELECT b.id, b.road_name, b.recordDatetime, w.temperature, w.windspeed, w.precipitation, w.weather
FROM bronze b LEFT JOIN weather w ON b.road_name = w.road_name AND b.rec_ts = w.weather_ts"""))
def lanes_with_weather(spark, sf_dir):
    joined = with_weather(base.bronze_traffic(spark, sf_dir), base.bronze_weather(spark, sf_dir))
    return joined.select("id", "road_name", "recordDatetime", "temperature", "windspeed", "precipitation", "weather")


@register("j02_silver_hourly_weather", with_sql(base.silver_sql("hour"), f"SELECT {base.SILVER_OUT} FROM silver"))
def silver_hourly(spark, sf_dir):
    return flat(published(base.silver(spark, sf_dir, "hour")))


@register("j01_silver_weather_as_of", with_sql(base.silver_sql("hour").replace("silver AS (", "unused AS ("), """,
silver AS (
  SELECT r.*, CASE WHEN r.rec_ts - w.weather_ts <= INTERVAL 60 MINUTE THEN w.temperature END AS temperature,
         CASE WHEN r.rec_ts - w.weather_ts <= INTERVAL 60 MINUTE THEN w.windspeed END AS windspeed,
         CASE WHEN r.rec_ts - w.weather_ts <= INTERVAL 60 MINUTE THEN w.precipitation END AS precipitation,
         CASE WHEN r.rec_ts - w.weather_ts <= INTERVAL 60 MINUTE THEN w.weather END AS weather
  FROM rolled r ASOF LEFT JOIN weather w ON r.road_name = w.road_name AND r.rec_ts >= w.weather_ts)
SELECT """ + base.SILVER_OUT + " FROM silver"))
def silver_as_of(spark, sf_dir):
    rows = build_silver(base.bronze_traffic(spark, sf_dir), base.bronze_weather(spark, sf_dir, "hour"), "as_of")
    return flat(published(rows))


@register("a02_hourly_peak_min", with_sql(base.silver_sql(), """
SELECT road_name, CAST(date AS VARCHAR) AS date, hour, round(max(avg_flow), 2) AS peakFlow, round(min(avg_flow), 2) AS minFlow
FROM silver GROUP BY ALL"""))
def peak_min(spark, sf_dir):
    return flat(hourly_flow_stats(lane_rollup(base.bronze_traffic(spark, sf_dir)), HOUR_KEYS))


@register("w07_gold_window", with_sql(base.gold_sql(), f"SELECT {base.GOLD_OUT} FROM gold"))
def gold_window(spark, sf_dir):
    return flat(build_gold(base.silver(spark, sf_dir)))


@register("j04_gold_join", with_sql(base.gold_sql(), f"SELECT {base.GOLD_OUT} FROM gold"))
def gold_join(spark, sf_dir):
    return flat(build_gold_by_join(base.silver(spark, sf_dir)))


@register("p21_f14_f15_gold_contract", with_sql(base.silver_sql(), """
SELECT road_name AS roadName, recordDatetime, CAST(trunc(total_entered) AS BIGINT) AS totalVehicle,
       CASE WHEN avg_speed < 20.0 / 3.6 THEN 1 ELSE 0 END AS congestionHour, avg_flow AS actualFlow,
       avg_speed, CAST(date AS VARCHAR) AS date
FROM rolled"""))
def gold_contract(spark, sf_dir):
    rows = lane_rollup(base.bronze_traffic(spark, sf_dir))
    blank = {c: F.lit(None).cast("double") for c in ("peakFlow", "minFlow", "temperature", "windspeed", "precipitation")}
    contract = to_contract(rows.withColumns({**blank, "weather": F.lit(None).cast("string")}))
    return flat(contract.drop(*blank, "weather"))


_CHANGED = """,
changed AS (SELECT DISTINCT road_name, date, hour FROM bronze WHERE event_type = 'error' AND road_name IS NOT NULL)"""


def _changed(spark, sf_dir):
    """Rows of the intervals that error readings fall in: the incoming batch."""
    errors = base.landing_traffic(spark, sf_dir).filter(F.col("flow") == "n/a")
    return lane_rollup(to_bronze_traffic(errors, base.fixed_clock()))


@register("a06_affected_hours", with_sql(base.BRONZE + _CHANGED, """
SELECT road_name, CAST(date AS VARCHAR) AS date, CAST(hour AS INTEGER) AS hour FROM changed"""))
def affected_hours(spark, sf_dir):
    return flat(affected(_changed(spark, sf_dir), HOUR_KEYS))


@register("j03_p07_touched_rows", with_sql(base.silver_sql() + _CHANGED, f"""
SELECT {base.SILVER_OUT} FROM silver SEMI JOIN changed USING (road_name, date, hour)"""))
def touched_rows(spark, sf_dir):
    hours = affected(_changed(spark, sf_dir), HOUR_KEYS)
    return flat(published(touched(base.silver(spark, sf_dir), hours, HOUR_KEYS)))


@register("j05_untouched_rows", with_sql(base.silver_sql() + _CHANGED, f"""
SELECT {base.SILVER_OUT} FROM silver ANTI JOIN changed USING (road_name, date, hour)"""))
def untouched_rows(spark, sf_dir):
    hours = affected(_changed(spark, sf_dir), HOUR_KEYS)
    return flat(published(untouched(base.silver(spark, sf_dir), hours, HOUR_KEYS)))


@register("j06_refreshed_stats", with_sql(base.gold_sql(), f"SELECT {base.GOLD_OUT} FROM gold"))
def refreshed_stats(spark, sf_dir):
    """Stale zero extremes replaced by fresh ones."""
    rows = base.silver(spark, sf_dir)
    stale = rows.withColumns({"peakFlow": F.lit(0.0), "minFlow": F.lit(0.0)})
    return flat(to_contract(with_hour_stats(stale, hourly_flow_stats(rows, HOUR_KEYS), HOUR_KEYS)))


@register("t07_gold_refresh", with_sql(base.gold_sql() + _CHANGED, f"""
SELECT {base.GOLD_OUT} FROM gold g SEMI JOIN changed c ON g.roadName = c.road_name AND g.date = c.date AND g.hour = c.hour"""))
def gold_refresh(spark, sf_dir):
    return flat(refresh_gold(_changed(spark, sf_dir), base.silver(spark, sf_dir)))


@register("t07_u01_gold_refresh_from_published", with_sql(base.gold_sql() + _CHANGED, f"""
SELECT {base.GOLD_OUT} FROM gold g SEMI JOIN changed c ON g.roadName = c.road_name AND g.date = c.date AND g.hour = c.hour"""))
def gold_refresh_published(spark, sf_dir):
    """The published table starts with stale extremes everywhere; touched hours come out fresh."""
    rows = base.silver(spark, sf_dir)
    arrived = touched(rows, _changed(spark, sf_dir), ["road_name", "date", "recordDatetime"])
    stale = rows.withColumns({"peakFlow": F.lit(-1.0), "minFlow": F.lit(-1.0)})
    table = with_hour(to_contract(stale))
    return flat(refresh_gold_from_published(arrived, table))


@register("a01_generic_rollup_per_day", with_sql(base.BRONZE, """
SELECT road_name, CAST(date AS VARCHAR) AS date, sum(entered) AS total_entered, sum(left_) AS total_left
FROM bronze GROUP BY ALL"""))
def rollup_per_day(spark, sf_dir):
    rows = lanes_to_roads(base.bronze_traffic(spark, sf_dir), ["road_name", "date"])
    return flat(rows.select("road_name", "date", "total_entered", "total_left"))


@register("p06_one_date", with_sql(base.BRONZE, """
SELECT id, recordDatetime FROM bronze WHERE date = DATE '2024-01-15'"""))
def one_date(spark, sf_dir):
    return on_date(base.bronze_traffic(spark, sf_dir), "2024-01-15").select("id", "recordDatetime")
