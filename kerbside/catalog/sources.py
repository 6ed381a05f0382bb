"""Source formats: the driver's tables written as JSON, XML, CSV and messages, and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base, maps
from kerbside.catalog.base import flat, register, with_sql
from kerbside.functions import times
from kerbside.operators.aggregates import bounding_box
from kerbside.operators.joins import with_road_names
from kerbside.schemas import (
    LANDING_TRAFFIC,
    LANDING_WEATHER,
    TRAFFIC_MEASURES,
    WEATHER_ARCHIVE,
    WEATHER_CURRENT,
)
from kerbside.session import scratch_path
from kerbside.sources import landing, maps as map_source, weather

_LANDING = base.BRONZE + """,
landing AS (
  SELECT id, road_name, CAST(date AS VARCHAR) AS date, strftime(slot, '%H:%M') AS "begin",
         CASE WHEN strftime(rec_ts, '%H:%M') = '00:00' THEN '24:00' ELSE strftime(rec_ts, '%H:%M') END AS "end",
         CAST(k AS VARCHAR) AS laneDensity, CAST(k + user_id % 10 AS VARCHAR) AS occupancy,
         CAST(user_id AS VARCHAR) AS waitingTime, CAST(CAST(speed AS BIGINT) AS VARCHAR) AS speed, '180' AS sampledSeconds,
         CAST(2 * k AS VARCHAR) AS traveltime, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(k AS VARCHAR) END AS flow,
         CAST(k AS VARCHAR) AS entered, CAST(CAST(speed AS BIGINT) AS VARCHAR) AS "left", CAST(user_id % 10 AS VARCHAR) AS timeLoss
  FROM bronze)"""


@register("s02_landing_files", with_sql(_LANDING, "SELECT * FROM landing"))
def landing_files(spark, sf_dir):
    folder = scratch_path(spark, "landing")
    landing.write_landing(base.landing_traffic(spark, sf_dir), folder, per_interval=False)
    return landing.read_landing(spark, folder, LANDING_TRAFFIC)


@register("s02_landing_of_a_date", with_sql(_LANDING, "SELECT * FROM landing WHERE date = (SELECT max(date) FROM landing)"))
def landing_of_date(spark, sf_dir):
    folder = scratch_path(spark, "landing")
    rows = base.landing_traffic(spark, sf_dir)
    landing.write_landing(rows, folder, per_interval=False)
    day = rows.agg(F.max("date")).first()[0]
    return landing.read_landing(spark, folder, LANDING_TRAFFIC, day, "day={day}")


@register("s13_landing_groups", with_sql(base.EV, """
SELECT CAST(CAST(slot AS DATE) AS VARCHAR) AS day, strftime(date_trunc('hour', slot), '%H%M') AS clock, count(*) AS rows,
       true AS same_end FROM ev GROUP BY ALL"""))
def landing_groups(spark, sf_dir):
    """Hourly weather rows, one folder per date and end; each folder holds its own rows only."""
    folder = scratch_path(spark, "groups")
    landing.write_landing(base.landing_weather(spark, sf_dir, "hour"), folder)
    rows = landing.read_landing(spark, folder, LANDING_WEATHER).select("date", "end", F.col("_metadata.file_path").alias("path"))
    day = F.regexp_extract("path", r"day=([0-9-]{10})/", 1)
    clock = F.regexp_extract("path", r"clock=(\d{4})/", 1)
    same = (F.col("date") == day) & (times.compact_clock(F.col("end")) == clock)
    return rows.groupBy(day.alias("day"), clock.alias("clock")).agg(
        F.count(F.lit(1)).alias("rows"), F.bool_and(same).alias("same_end")
    )


def _messages(spark, sf_dir):
    rows = base.landing_weather(spark, sf_dir)
    body = F.to_json(F.struct(*[c for c in rows.columns if c != "road_name"]))
    return rows.select(F.col("road_name").cast("binary").alias("key"), body.cast("binary").alias("value"))


@register("s11_topic_messages", with_sql(base.EV, """
SELECT 'w' || user_id AS road_id, road_name, CAST(CAST(slot AS DATE) AS VARCHAR) AS date, strftime(slot, '%H:%M') AS "begin",
       CASE WHEN strftime(slot + INTERVAL 3 MINUTE, '%H:%M') = '00:00' THEN '24:00' ELSE strftime(slot + INTERVAL 3 MINUTE, '%H:%M') END AS "end",
       CAST(k AS DOUBLE) AS temperature, CAST(user_id % 20 AS DOUBLE) AS windspeed, CAST(k AS INTEGER) AS humidity,
       floor(value) AS precipitation, CAST(weather_code AS INTEGER) AS weathercode, weather_label AS weather,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ingestion_time
FROM ev"""))
def topic_messages(spark, sf_dir):
    return landing.decode_topic(_messages(spark, sf_dir), LANDING_WEATHER, key_as_road=True)


def _write_intervals(spark, sf_dir) -> str:
    """Simulation XML, one folder per date, its name holding the date as dd-MM-yyyy. Junction
    lanes (views, again) are added under internal ids."""
    ev = base.events(spark, sf_dir)
    rows = base.landing_traffic(spark, sf_dir)
    internal = rows.withColumn("id", F.concat(F.lit(":"), F.col("id")))
    lanes = rows.unionByName(internal)
    minute = F.split_part("begin", F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part("begin", F.lit(":"), F.lit(2)).cast("int")
    seconds = (minute * 60).cast("double")
    edge = F.struct(F.col("id").alias("_id"), *[F.col(m).alias(f"_{m}") for m in TRAFFIC_MEASURES])
    folder = scratch_path(spark, "intervals")
    name = F.concat(F.lit("test_"), F.date_format(F.to_date("date"), "dd-MM-yyyy"), F.lit("_output"))
    lanes.select(
        seconds.cast("string").alias("_begin"), (seconds + 180).cast("string").alias("_end"), F.array(edge).alias("edge"), name.alias("run")
    ).write.partitionBy("run").format("xml").option("rootTag", "meandata").option("rowTag", "interval").save(folder)
    return folder


@register("s12_interval_xml", with_sql(_LANDING, "SELECT * EXCLUDE (road_name) FROM landing"))
def interval_xml(spark, sf_dir):
    return landing.read_interval_xml(spark, _write_intervals(spark, sf_dir))


@register("s12_j07_interval_xml_with_names", with_sql(_LANDING, """
SELECT l.id, l.date, l."end", c.c_name AS road_name
FROM landing l LEFT JOIN customer c ON c.c_custkey = CAST(split_part(ltrim(l.id, '-'), '#', 1) AS BIGINT)"""))
def interval_xml_named(spark, sf_dir):
    """Lanes named by their way; customers name the ways."""
    edges = landing.read_interval_xml(spark, _write_intervals(spark, sf_dir))
    ways = base.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("way_id"), F.col("c_name").alias("name"))
    return with_road_names(edges, ways).select("id", "date", "end", "road_name")


@register("s21_pending_files", with_sql(base.EV, """
SELECT DISTINCT CAST(CAST(slot AS DATE) AS VARCHAR) AS date FROM ev
WHERE CAST(slot AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-25' AND CAST(slot AS DATE) NOT IN
      (SELECT CAST(slot AS DATE) FROM ev GROUP BY ALL HAVING count(*) FILTER (event_type = 'error') >= 70)"""))
def pending_files(spark, sf_dir):
    """Days with many errors count as processed."""
    files = landing.list_files(spark, _write_intervals(spark, sf_dir), "*.xml")
    days = base.events(spark, sf_dir).groupBy(F.to_date("slot").alias("date"))
    processed = days.agg(F.count_if(F.col("event_type") == "error").alias("n")).filter("n >= 70")
    pending = landing.pending_files(files, processed, start="2024-01-08", end="2024-01-25")
    return flat(pending.select("date").distinct())


@register("s22_dates_of_file_names", with_sql(base.EV, """
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS date FROM ev"""))
def file_dates(spark, sf_dir):
    day = F.when(F.col("event_type") != "error", F.date_format("ts", "dd-MM-yyyy")).otherwise("99-99-2024")
    path = F.concat(F.lit("runs/test_"), day, F.lit("_output.xml"))
    return flat(base.events(spark, sf_dir).select("event_id", times.date_from_file_name(path).alias("date")))


@register("s14_hourly_arrays", with_sql(base.EV, """
SELECT event_id, strftime(date_trunc('hour', ts) + to_hours(h), '%Y-%m-%dT%H:%M') AS datetime, CAST(k + h AS DOUBLE) AS temperature,
       CASE WHEN h = 1 THEN NULL ELSE floor(value) END AS precipitation, CAST(CASE h WHEN 0 THEN weather_code WHEN 1 THEN 4 END AS INTEGER) AS weathercode,
       CAST(user_id AS DOUBLE) AS windspeed, CAST(k AS DOUBLE) AS humidity, CASE WHEN h = 0 THEN weather_label ELSE 'Unknown' END AS weather
FROM ev, range(3) t(h)"""))
def hourly_arrays(spark, sf_dir):
    """One archive payload of three hours per event, as JSON text."""
    return weather.explode_hourly(_archives(spark, sf_dir).select("event_id", "body.*"))


@register("s14_p02_archive_to_bronze", with_sql(base.EV, """
SELECT 'w' || user_id AS road_id, road_name, strftime(date_trunc('hour', ts) + to_hours(h), '%Y-%m-%dT%H:%M') AS datetime,
       CAST(k + h AS DOUBLE) AS temperature, CAST(user_id AS DOUBLE) AS windspeed, CAST(k AS INTEGER) AS humidity,
       CASE WHEN h = 1 THEN 0.0 ELSE floor(value) END AS precipitation, CASE WHEN h = 0 THEN weather_label ELSE 'Unknown' END AS weather,
       '2024-02-01T00:00' AS processDatetime, CAST(CAST(ts AS DATE) AS VARCHAR) AS date
FROM ev, range(3) t(h)"""))
def archived_bronze(spark, sf_dir):
    """Archive hours of every event's road as bronze weather rows."""
    hours = weather.explode_hourly(_archives(spark, sf_dir).select("road_id", "road_name", "date", "body.*"))
    return flat(weather.archive_to_bronze(hours, base.fixed_clock()))


def _archives(spark, sf_dir):
    hours = [times.minute_text(times.floor_hour(F.col("ts")) + F.expr(f"INTERVAL {h} HOURS")) for h in range(3)]
    k = F.col("k").cast("double")
    rain = F.floor("value").cast("double")
    none = F.lit(None)
    hourly = F.struct(
        F.array(*hours).alias("time"),
        F.array(k, k + 1, k + 2).alias("temperature_2m"),
        F.array(rain, none.cast("double"), rain).alias("precipitation"),
        F.array(base._by_event_type(0), F.lit(4), none.cast("int")).alias("weathercode"),
        F.array_repeat(F.col("user_id").cast("double"), 3).alias("windspeed_10m"),
        F.array_repeat(k, 3).alias("relativehumidity_2m"),
    )
    text = F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"})
    return base.events(spark, sf_dir).select(
        "event_id", "road_name", F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("road_id"), F.to_date("ts").alias("date"),
        F.from_json(text, WEATHER_ARCHIVE).alias("body"))


@register("s15_current_weather", with_sql(base.EV, """
SELECT event_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS datetime, CAST(k AS DOUBLE) AS temperature,
       CAST(user_id AS DOUBLE) AS windspeed, CAST(CASE WHEN event_type = 'click' THEN 0 ELSE weather_code END AS INTEGER) AS weathercode,
       CASE WHEN event_type = 'click' THEN 'Clear sky' ELSE weather_label END AS weather,
       CASE WHEN event_type <> 'signup' THEN CAST(k AS DOUBLE) END AS humidity,
       CASE WHEN event_type IN ('view', 'click') THEN floor(value) ELSE 0.0 END AS precipitation
FROM ev WHERE event_type <> 'error'"""))
def current_weather(spark, sf_dir):
    """Errors have no current weather, clicks no code, signups no matching hour, purchases no rain."""
    kind = F.col("event_type")
    now = times.minute_text(times.floor_hour(F.col("ts")))
    later = times.minute_text(times.floor_hour(F.col("ts")) + F.expr("INTERVAL 1 HOURS"))
    k, rain = F.col("k").cast("double"), F.floor("value").cast("double")
    current = F.struct(
        now.alias("time"), k.alias("temperature"), F.col("user_id").cast("double").alias("windspeed"),
        F.when(kind != "click", base._by_event_type(0)).alias("weathercode"),
    )
    hourly = F.struct(
        F.array(later, F.when(kind != "signup", now).otherwise("never")).alias("time"),
        F.array(F.lit(-1.0), k).alias("relativehumidity_2m"),
        F.array(F.lit(-1.0), F.when(kind != "purchase", rain)).alias("precipitation"),
    )
    body = F.struct(F.when(kind != "error", current).alias("current_weather"), hourly.alias("hourly"))
    payloads = base.events(spark, sf_dir).select("event_id", F.from_json(F.to_json(body), WEATHER_CURRENT).alias("body"))
    return weather.current_reading(payloads.select("event_id", "body.*"))


@register("s16_road_lookup", """
SELECT CAST(min(c_custkey) AS VARCHAR) AS way_id, c_mktsegment || ' ' || c_nationkey AS name,
       arg_min(c_acctbal, c_custkey) AS lat, CAST(NULL AS DOUBLE) AS lon
FROM customer GROUP BY name""")
def road_lookup(spark, sf_dir):
    """Customers by segment and nation share names; files are written in key order."""
    folder = scratch_path(spark, "roads")
    base.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("way_id"),
        F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("name"),
        F.col("c_acctbal").cast("string").alias("lat"),
        F.lit("unknown").alias("lon"),
        "c_custkey",
    ).orderBy("c_custkey").drop("c_custkey").write.option("header", "true").csv(folder)
    return map_source.read_roads(spark, folder)


@register("s16_way_lookup", """
SELECT CAST(c_custkey AS VARCHAR) AS osm_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) END AS highway,
       CAST(c_acctbal AS DOUBLE) AS lat, CAST(c_nationkey AS DOUBLE) AS lon
FROM customer""")
def way_lookup(spark, sf_dir):
    """Customers as ways of a lookup: files that are one JSON array each, spread over many lines."""
    folder = scratch_path(spark, "ways")
    c = base.table(spark, sf_dir, "customer")
    entry = F.struct(
        F.col("c_custkey").cast("string").alias("osm_id"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).alias("highway"),
        F.col("c_acctbal").cast("double").alias("lat"), F.col("c_nationkey").cast("double").alias("lon"),
    )
    lists = c.groupBy((F.col("c_custkey") % 8).alias("file")).agg(F.collect_list(entry).alias("ways"))
    text = F.to_json("ways", {"pretty": "true"})
    lists.repartition(8, "file").select("file", text.alias("value")).write.partitionBy("file").text(folder)
    return map_source.read_way_lookup(spark, folder).drop("file")


def _write_map(spark, sf_dir, *wanted: str) -> str:
    """The wanted of ways, nodes and bounds as map XML and the network's edges ("net") as network XML, compressed."""
    folder = scratch_path(spark, "map")

    def tag(key: str, value) -> F.Column:
        return F.struct(F.lit(key).alias("_k"), value.alias("_v"))

    def save(df, name: str, row_tag: str, root: str) -> None:
        if name in wanted:
            df.write.format("xml").option("rootTag", root).option("rowTag", row_tag).option("compression", "gzip").save(f"{folder}/{name}")

    tags = F.filter(F.array(tag("highway", F.col("highway")), tag("name", F.col("name"))), lambda t: t["_v"].isNotNull())
    refs = F.transform("refs", lambda r: F.struct(r.alias("_ref")))
    ways = maps.ways(spark, sf_dir)
    save(ways.select(F.col("way_id").alias("_id"), refs.alias("nd"), tags.alias("tag")), "ways", "way", "osm")
    nodes = maps.nodes(spark, sf_dir)
    save(nodes.select(*[F.col(c).cast("string").alias(f"_{a}") for c, a in (("node_id", "id"), ("lat", "lat"), ("lon", "lon"))]), "nodes", "node", "osm")
    box = nodes.agg(*[f(c).alias(f"_{n}{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("lat", "lon")])
    save(box, "bounds", "bounds", "osm")
    edges = maps.edges(spark, sf_dir).select("id")
    internal = edges.select(F.concat(F.lit(":"), "id").alias("id"))
    save(edges.unionByName(internal).select(F.col("id").alias("_id")), "net", "edge", "net")
    return folder


@register("s17_map_ways", with_sql(maps.WAYS, """
SELECT w.way_id, w.name, w.highway, coalesce((SELECT string_agg(l_partkey, '|' ORDER BY pos) FROM p WHERE p.way_id = w.way_id), '') AS refs FROM w"""))
def map_ways(spark, sf_dir):
    ways = map_source.read_ways(spark, f"{_write_map(spark, sf_dir, 'ways')}/ways")
    return ways.select("way_id", "name", "highway", F.array_join("refs", "|").alias("refs"))


@register("s17_map_nodes", "SELECT CAST(p_partkey AS VARCHAR) AS node_id, 21.0 + p_partkey / 10000.0 AS lat, 105.8 + p_size / 1000.0 AS lon FROM part")
def map_nodes(spark, sf_dir):
    return map_source.read_nodes(spark, f"{_write_map(spark, sf_dir, 'nodes')}/nodes")


@register("s18_network_edges", with_sql(maps.WAYS, "SELECT id FROM e"))
def network_edges(spark, sf_dir):
    return map_source.read_net_edges(spark, f"{_write_map(spark, sf_dir, 'net')}/net")


@register("s17_s18_map_features", with_sql(maps.WAYS, """
SELECT f.way_id, f.name, f.highway, (SELECT count(DISTINCT id) FROM e WHERE e.l_orderkey = f.o_orderkey) AS edges, p.pos, p.lat, p.lon
FROM f JOIN (SELECT way_id, CAST(pos AS INTEGER) AS pos, lat, lon FROM p) p USING (way_id)"""))
def features_from_files(spark, sf_dir):
    folder = _write_map(spark, sf_dir, "ways", "nodes", "net")
    found = map_source.map_features(
        map_source.read_ways(spark, f"{folder}/ways"),
        map_source.read_nodes(spark, f"{folder}/nodes"),
        map_source.read_net_edges(spark, f"{folder}/net"),
    )
    points = found.select("way_id", "name", "highway", F.size("edge_ids").cast("bigint").alias("edges"), F.posexplode("coordinates").alias("pos", "at"))
    return points.select("way_id", "name", "highway", "edges", "pos", F.col("at")[0].alias("lat"), F.col("at")[1].alias("lon"))


@register("a21_bounds_of_file", "SELECT min(21.0 + p_partkey / 10000.0) AS min_lat, min(105.8 + p_size / 1000.0) AS min_lon, max(21.0 + p_partkey / 10000.0) AS max_lat, max(105.8 + p_size / 1000.0) AS max_lon FROM part")
def bounds_of_file(spark, sf_dir):
    """The file's own bounds win over the box of the features."""
    folder = _write_map(spark, sf_dir, "bounds")
    return bounding_box(maps.features(spark, sf_dir), map_source.read_bounds(spark, f"{folder}/bounds"))
