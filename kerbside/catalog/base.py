"""Registry, and the domain frames derived from the ``events`` table.

Every event is one lane reading: its user gives the road (4 roads, and some readings without
one), its time the 3-minute interval, ``props.k`` and ``value`` the measures. Measures are whole
numbers, so that sums and means are exact in any engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import times
from kerbside.plans.bronze import to_bronze_traffic, to_bronze_weather
from kerbside.plans.gold import build_gold
from kerbside.plans.silver import build_silver, published

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flat(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that results compare without regard to time types."""
    casts = {}
    for name, kind in df.dtypes:
        if kind == "date":
            casts[name] = F.date_format(F.col(name), "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            casts[name] = F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(casts) if casts else df


# --- fixed values: event types as weather ---
EVENT_WEATHER = {
    "view": (0, "Clear sky"),
    "click": (3, "Overcast"),
    "purchase": (61, "Slight rain"),
    "signup": (63, "Moderate rain"),
    "error": (95, "Thunderstorm"),
}
# --- end of fixed values ---


def _by_event_type(position: int) -> Column:
    entries = [x for name, pair in EVENT_WEATHER.items() for x in (F.lit(name), F.lit(pair[position]))]
    return F.try_element_at(F.create_map(*entries), F.col("event_type"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k``, ``road_name`` and the start of their 3-minute ``slot``."""
    raw = table(spark, sf_dir, "events")
    road = F.when(F.col("user_id") % 25 != 0, F.concat(F.lit("road_"), (F.col("user_id") % 4).cast("string")))
    return raw.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        road.alias("road_name"),
    ).withColumn("slot", times.floor_minutes(F.col("ts")))


def _interval(slot: Column) -> dict[str, Column]:
    """Landing's date, begin and end of a slot; the day's last interval ends at 24:00."""
    begin = F.date_format(slot, "HH:mm")
    end = F.date_format(slot + F.expr("INTERVAL 3 MINUTES"), "HH:mm")
    return {
        "date": F.date_format(slot, "yyyy-MM-dd"),
        "begin": begin,
        "end": F.when(begin == "23:57", "24:00").otherwise(end),
    }


def landing_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text lane readings; errors report a flow that is no number."""
    ev = events(spark, sf_dir)
    interval = _interval(F.col("slot"))
    sign = F.when(F.col("k") % 2 == 1, "-").otherwise("")
    whole = F.floor("value")
    measures = {
        "laneDensity": F.col("k"),
        "occupancy": F.col("k") + F.col("user_id") % 10,
        "waitingTime": F.col("user_id"),
        "speed": whole,
        "sampledSeconds": F.lit(180),
        "traveltime": F.col("k") * 2,
        "flow": F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("k").cast("string")),
        "entered": F.col("k"),
        "left": whole,
        "timeLoss": F.col("user_id") % 10,
    }
    return ev.select(
        F.concat(sign, F.col("user_id").cast("string"), F.lit("#"), F.col("event_id").cast("string")).alias("id"),
        "road_name",
        *[c.alias(n) for n, c in interval.items()],
        *[c.cast("string").alias(n) for n, c in measures.items()],
    )


def landing_weather(spark: SparkSession, sf_dir: str, grain: str = "interval") -> DataFrame:
    """A weather reading per event, timed at its interval's end or at its hour; several share a
    time, as repeated readings do."""
    ev = events(spark, sf_dir)
    interval = _interval(F.col("slot"))
    if grain == "hour":
        on_hour = F.date_format(times.floor_hour(F.col("slot")), "HH:mm")
        interval = {**interval, "begin": on_hour, "end": on_hour}
    return ev.select(
        F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("road_id"),
        "road_name",
        *[c.alias(n) for n, c in interval.items()],
        F.col("k").cast("double").alias("temperature"),
        (F.col("user_id") % 20).cast("double").alias("windspeed"),
        F.col("k").cast("int").alias("humidity"),
        F.floor("value").cast("double").alias("precipitation"),
        _by_event_type(0).cast("int").alias("weathercode"),
        _by_event_type(1).alias("weather"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_time"),
    )


FIXED_CLOCK = "2024-02-01T00:00"


def fixed_clock() -> Column:
    return F.lit(FIXED_CLOCK).cast("timestamp")


def bronze_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze_traffic(landing_traffic(spark, sf_dir), fixed_clock())


def bronze_weather(spark: SparkSession, sf_dir: str, grain: str = "interval") -> DataFrame:
    return to_bronze_weather(landing_weather(spark, sf_dir, grain), fixed_clock())


def silver(spark: SparkSession, sf_dir: str, grain: str = "interval") -> DataFrame:
    return build_silver(bronze_traffic(spark, sf_dir), bronze_weather(spark, sf_dir, grain), grain)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(silver(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, grain: str = "interval") -> DataFrame:
    return build_gold(silver(spark, sf_dir, grain))


def road_edges(spark: SparkSession, sf_dir: str, road_ids: DataFrame) -> DataFrame:
    """Each road to the next at hop 1 and the one after at hop 2, round the ring of roads."""
    total = road_ids.agg(F.count(F.lit(1)).alias("n")).scalar()
    hops = F.explode(F.array(F.lit(1), F.lit(2)))
    return road_ids.select(F.col("road_id").alias("src"), hops.alias("hop")).select(
        "src", ((F.col("src") + F.col("hop")) % total).cast("int").alias("dst"), "hop"
    )


# --- the same frames as SQL -------------------------------------------------------------

EV = """
ev AS (
  SELECT event_id, user_id, event_type, value, ts, props,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN user_id % 25 <> 0 THEN 'road_' || (user_id % 4) END AS road_name,
         time_bucket(INTERVAL 3 MINUTE, ts) AS slot,
         CASE event_type WHEN 'view' THEN 'Clear sky' WHEN 'click' THEN 'Overcast'
              WHEN 'purchase' THEN 'Slight rain' WHEN 'signup' THEN 'Moderate rain'
              WHEN 'error' THEN 'Thunderstorm' END AS weather_label,
         CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 3 WHEN 'purchase' THEN 61
              WHEN 'signup' THEN 63 WHEN 'error' THEN 95 END AS weather_code
  FROM events)"""

BRONZE = EV + """,
bronze AS (
  SELECT CASE WHEN k % 2 = 1 THEN '-' ELSE '' END || user_id || '#' || event_id AS id,
         road_name, event_id, user_id, event_type, k, value, slot,
         slot + INTERVAL 3 MINUTE AS rec_ts,
         strftime(slot + INTERVAL 3 MINUTE, '%Y-%m-%dT%H:%M') AS recordDatetime,
         CAST(slot AS DATE) AS date,
         date_diff('hour', CAST(CAST(slot AS DATE) AS TIMESTAMP), slot + INTERVAL 3 MINUTE) AS hour,
         CAST(k AS DOUBLE) AS laneDensity, CAST(k + user_id % 10 AS DOUBLE) AS occupancy,
         CAST(user_id AS DOUBLE) AS waitingTime, floor(value) AS speed,
         CAST(180 AS DOUBLE) AS sampledSeconds, CAST(2 * k AS DOUBLE) AS traveltime,
         CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS flow,
         CAST(k AS DOUBLE) AS entered, floor(value) AS left_, CAST(user_id % 10 AS DOUBLE) AS timeloss
  FROM ev)"""


def weather_sql(grain: str = "interval") -> str:
    time = "slot + INTERVAL 3 MINUTE" if grain == "interval" else "date_trunc('hour', slot)"
    return f""",
weather AS (
  SELECT * FROM (
    SELECT road_name, {time} AS weather_ts,
           CAST(k AS DOUBLE) AS temperature, CAST(user_id % 20 AS DOUBLE) AS windspeed,
           floor(value) AS precipitation, weather_label AS weather
    FROM ev)
  QUALIFY row_number() OVER (PARTITION BY road_name, weather_ts
          ORDER BY temperature DESC, windspeed DESC, precipitation DESC, weather DESC) = 1)"""


def silver_sql(grain: str = "interval") -> str:
    floored = "s.rec_ts" if grain == "interval" else "date_trunc('hour', s.rec_ts)"
    return BRONZE + weather_sql(grain) + f""",
rolled AS (
  SELECT road_name, date, rec_ts, recordDatetime, CAST(hour AS INTEGER) AS hour,
         round(avg(speed), 2) AS avg_speed, round(avg(laneDensity), 2) AS avg_density,
         round(avg(occupancy), 2) AS avg_occupancy, round(avg(waitingTime), 2) AS avg_waitingTime,
         round(avg(traveltime), 2) AS avg_traveltime, coalesce(round(avg(flow), 2), 0.0) AS avg_flow,
         round(sum(entered), 2) AS total_entered, round(sum(left_), 2) AS total_left,
         round(avg(timeloss), 2) AS avg_timeloss
  FROM bronze WHERE road_name IS NOT NULL
  GROUP BY ALL),
silver AS (
  SELECT s.*, w.temperature, w.windspeed, w.precipitation, w.weather
  FROM rolled s LEFT JOIN weather w ON s.road_name = w.road_name AND {floored} = w.weather_ts)"""


def gold_sql(grain: str = "interval") -> str:
    return silver_sql(grain) + """,
gold AS (
  SELECT road_name AS roadName, recordDatetime, CAST(trunc(total_entered) AS BIGINT) AS totalVehicle,
         CASE WHEN avg_speed < 20.0 / 3.6 THEN 1 ELSE 0 END AS congestionHour,
         round(max(avg_flow) OVER (PARTITION BY road_name, date, hour), 2) AS peakFlow,
         round(min(avg_flow) OVER (PARTITION BY road_name, date, hour), 2) AS minFlow,
         avg_flow AS actualFlow, avg_speed, temperature, windspeed, precipitation, weather, date, hour, rec_ts
  FROM silver)"""


SILVER_OUT = """road_name, recordDatetime, avg_speed, avg_density, avg_occupancy, avg_waitingTime, avg_traveltime,
  avg_flow, total_entered, total_left, avg_timeloss, temperature, windspeed, precipitation, weather,
  CAST(date AS VARCHAR) AS date"""
GOLD_OUT = """roadName, recordDatetime, totalVehicle, congestionHour, peakFlow, minFlow, actualFlow, avg_speed,
  temperature, windspeed, precipitation, weather, CAST(date AS VARCHAR) AS date"""


def with_sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
