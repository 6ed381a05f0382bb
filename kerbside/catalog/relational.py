"""Windows, grids and road-graph joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.functions import times
from kerbside.operators.aggregates import affected
from kerbside.operators.joins import (
    interval_grid,
    latest_weather,
    neighbour_mean_of_roads,
    neighbour_mean_of_rows,
    with_neighbour_means,
)
from kerbside.operators.windows import carry_forward, keep_first, lag_in_chunks, last_row, last_values
from kerbside.plans.features import fit_roads


@register("w01_lags", with_sql(base.silver_sql(), """
SELECT road_name, recordDatetime, """ + ", ".join(
    f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in ("avg_density", "avg_speed") for k in (1, 2, 3)
) + " FROM silver WINDOW w AS (PARTITION BY road_name ORDER BY rec_ts)"))
def lags(spark, sf_dir):
    rows = base.silver(spark, sf_dir).select("road_name", "recordDatetime", "rec_ts", "avg_density", "avg_speed")
    out = lag_in_chunks(rows, ["road_name"], "rec_ts", ["avg_density", "avg_speed"], 3, "HOUR")
    return out.drop("rec_ts", "avg_density", "avg_speed")


@register("w02_last_three", with_sql(base.silver_sql(), """
, r AS (SELECT road_name, avg_density, avg_speed, row_number() OVER (PARTITION BY road_name, hour ORDER BY rec_ts DESC) AS back, hour FROM silver),
g AS (SELECT road_name, hour, list(avg_density ORDER BY back DESC) AS d, list(avg_speed ORDER BY back DESC) AS s FROM r WHERE back <= 3 GROUP BY ALL)
SELECT road_name, hour, d[greatest(len(d) - 2, 1)] AS density_3, d[greatest(len(d) - 1, 1)] AS density_2, d[len(d)] AS density_1,
       s[greatest(len(s) - 2, 1)] AS speed_3 FROM g"""))
def last_three(spark, sf_dir):
    """Per road and hour of day, so that some histories are short and padded."""
    rows = base.silver(spark, sf_dir)
    last = last_values(rows, ["road_name", "hour"], "rec_ts", ["avg_density", "avg_speed"])
    return last.select(
        "road_name", "hour",
        F.col("avg_density_last")[0].alias("density_3"),
        F.col("avg_density_last")[1].alias("density_2"),
        F.col("avg_density_last")[2].alias("density_1"),
        F.col("avg_speed_last")[0].alias("speed_3"),
    )


_GRID = """,
days AS (SELECT DISTINCT road_name, CAST(slot AS DATE) AS date FROM ev WHERE road_name IS NOT NULL),
grid AS (SELECT road_name, date, CAST(m AS INTEGER) AS end_minute, date + to_minutes(m) AS ts FROM days, range(3, 1441, 3) t(m))"""


@register("j12_f29_interval_grid", with_sql(base.EV + _GRID, """
SELECT road_name, CAST(date AS VARCHAR) AS date, end_minute FROM grid"""))
def grid(spark, sf_dir):
    return flat(interval_grid(_road_days(spark, sf_dir)))


def _road_days(spark, sf_dir):
    ev = base.events(spark, sf_dir).filter("road_name IS NOT NULL")
    return affected(ev.select("road_name", F.to_date("slot").alias("date")), ["road_name", "date"])


@register("w05_carried_weather", with_sql(base.EV + base.weather_sql("hour") + _GRID, """
SELECT g.road_name, CAST(g.date AS VARCHAR) AS date, g.end_minute, w.temperature, w.weather
FROM grid g ASOF LEFT JOIN (SELECT * FROM weather WHERE road_name IS NOT NULL) w
  ON g.road_name = w.road_name AND g.ts >= w.weather_ts"""))
def carried(spark, sf_dir):
    """Every road and interval with the last hourly reading up to it."""
    slots = interval_grid(_road_days(spark, sf_dir))
    ts = F.timestamp_seconds(F.unix_seconds(F.col("date").cast("timestamp")) + F.col("end_minute") * 60)
    slots = slots.withColumn("ts", ts)
    hourly = latest_weather(base.bronze_weather(spark, sf_dir, "hour")).filter("road_name IS NOT NULL")
    readings = hourly.select(
        "road_name", times.parse_minute_text(F.col("datetime")).alias("ts"), F.struct("temperature", "weather").alias("reading")
    )
    stacked = slots.withColumn("side", F.lit(1)).unionByName(readings.withColumn("side", F.lit(0)), allowMissingColumns=True)
    filled = carry_forward(stacked, ["road_name"], "ts", "reading", "HOUR", tie=["side"]).filter("side = 1")
    return flat(filled.select("road_name", "date", "end_minute", "reading.temperature", "reading.weather"))


@register("w08_keep_first", with_sql(base.EV, """
SELECT user_id, event_type, min(event_id) AS event_id FROM ev GROUP BY ALL"""))
def first_per_user(spark, sf_dir):
    rows = keep_first(base.events(spark, sf_dir), ["user_id", "event_type"], [F.asc("event_id")])
    return rows.select("user_id", "event_type", "event_id")


_ROADS = """,
ids AS (SELECT road_name, CAST(row_number() OVER (ORDER BY road_name) - 1 AS INTEGER) AS road_id
        FROM (SELECT DISTINCT road_name FROM ev WHERE road_name IS NOT NULL)),
edges AS (SELECT i.road_id AS src, CAST((i.road_id + h) % (SELECT count(*) FROM ids) AS INTEGER) AS dst, CAST(h AS INTEGER) AS hop
          FROM ids i, range(1, 3) t(h))"""


@register("m01_road_classes", with_sql(base.EV + _ROADS, "SELECT road_name, road_id FROM ids"))
def road_classes(spark, sf_dir):
    return fit_roads(base.events(spark, sf_dir)).select("road_name", "road_id")


def _lane_density(spark, sf_dir, roads):
    return base.events(spark, sf_dir).join(roads, "road_name").select("road_id", "slot", F.col("k").cast("double").alias("density"))


@register("j13_neighbour_mean_of_rows", with_sql(base.EV + _ROADS, """
, r AS (SELECT road_id, k FROM ev JOIN ids USING (road_name))
SELECT i.road_id, coalesce(avg(r.k) FILTER (e.hop = 1), 0.0) AS neighbor_density_hop1, coalesce(avg(r.k) FILTER (e.hop = 2), 0.0) AS neighbor_density_hop2
FROM ids i LEFT JOIN edges e ON e.src = i.road_id LEFT JOIN r ON r.road_id = e.dst GROUP BY i.road_id"""))
def mean_of_rows(spark, sf_dir):
    roads = fit_roads(base.events(spark, sf_dir))
    edges = base.road_edges(spark, sf_dir, roads)
    means = neighbour_mean_of_rows(_lane_density(spark, sf_dir, roads), edges, "road_id", "density")
    return with_neighbour_means(roads.select("road_id"), means, "road_id")


@register("j14_neighbour_mean_of_roads", with_sql(base.EV + _ROADS, """
, r AS (SELECT road_id, arg_max(k, event_id) AS k FROM ev JOIN ids USING (road_name) GROUP BY road_id)
SELECT i.road_id, coalesce(avg(r.k) FILTER (e.hop = 1), 0.0) AS neighbor_density_hop1, coalesce(avg(r.k) FILTER (e.hop = 2), 0.0) AS neighbor_density_hop2
FROM ids i LEFT JOIN edges e ON e.src = i.road_id LEFT JOIN r ON r.road_id = e.dst GROUP BY i.road_id"""))
def mean_of_roads(spark, sf_dir):
    roads = fit_roads(base.events(spark, sf_dir))
    edges = base.road_edges(spark, sf_dir, roads)
    newest = last_row(base.events(spark, sf_dir).select("road_name", "event_id", "k"), ["road_name"], "event_id")
    state = newest.join(roads, "road_name").select("road_id", F.col("k").cast("double").alias("density"))
    means = neighbour_mean_of_roads(state, edges, "road_id", "density")
    return with_neighbour_means(roads.select("road_id"), means, "road_id")
