"""Serving queries over published silver and gold rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.functions import times, values
from kerbside.operators import filters
from kerbside.operators.aggregates import counters, dataset_stats, latest_record_time, road_count, road_list
from kerbside.operators.paging import (
    any_order, first_predictions, number_order, page_rows, preview, with_row_number, with_sort_keys,
)
from kerbside.operators.sets import merge_latest, road_comparison, road_membership
from kerbside.operators.windows import keep_first, last_row
from kerbside.plans.dashboard import readings

SILVER, GOLD = base.silver_sql(), base.gold_sql()


@register("a03_dataset_stats", with_sql(SILVER, """
SELECT count(*) AS rows, count(*) FILTER (WHERE road_name IS NOT NULL) AS rows_with_road_name,
       count(DISTINCT road_name) AS unique_roads, count(DISTINCT weather) AS unique_weather,
       min(recordDatetime) AS min_record_datetime, max(recordDatetime) AS max_record_datetime
FROM silver"""))
def stats(spark, sf_dir):
    return dataset_stats(base.silver_rows(spark, sf_dir))


@register("a03_bronze_stats", with_sql(base.BRONZE, """
SELECT count(*) AS rows, count(road_name) AS rows_with_road_name, count(DISTINCT road_name) AS unique_roads,
       count(DISTINCT event_type) AS unique_weather, min(recordDatetime) AS min_record_datetime,
       max(recordDatetime) AS max_record_datetime
FROM bronze"""))
def bronze_stats(spark, sf_dir):
    lanes = base.landing_weather(spark, sf_dir)
    stamped = lanes.withColumn("recordDatetime", times.minute_text(times.interval_time(F.col("date"), F.col("end"))))
    return dataset_stats(stamped)


@register("a04_road_count", with_sql(base.EV, "SELECT count(DISTINCT road_name) AS unique_roads FROM ev"))
def roads_counted(spark, sf_dir):
    return road_count(base.events(spark, sf_dir))


@register("a05_road_list", with_sql(base.EV, """
SELECT DISTINCT trim(CASE WHEN event_type = 'view' THEN '  ' ELSE '  ' || road_name || ' ' END) AS road_name
FROM ev WHERE event_type <> 'view' AND road_name IS NOT NULL"""))
def roads_listed(spark, sf_dir):
    padded = F.when(F.col("event_type") == "view", F.lit("  ")).otherwise(F.concat(F.lit("  "), "road_name", F.lit(" ")))
    return road_list(base.events(spark, sf_dir).withColumn("road_name", padded))


@register("a15_counters", with_sql(SILVER, """
SELECT CAST(date AS VARCHAR) AS date, count(*) AS records, count(DISTINCT road_name) AS roads,
       count(DISTINCT (hour(rec_ts) * 60 + minute(rec_ts)) // 3) AS buckets
FROM silver GROUP BY date"""))
def day_counters(spark, sf_dir):
    rows = base.silver_rows(spark, sf_dir)
    bucketed = readings(rows, ["date", "road_name"])
    return flat(counters(bucketed, ["date"]))


@register("a16_latest_record", with_sql(SILVER, "SELECT strftime(max(rec_ts), '%Y-%m-%d %H:%M:%S') AS latest FROM silver"))
def latest(spark, sf_dir):
    return flat(latest_record_time(base.silver_rows(spark, sf_dir)))


@register("a22_latest_wins", with_sql(base.EV, """
SELECT road_name, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, event_id, value FROM ev
QUALIFY row_number() OVER (PARTITION BY road_name, slot ORDER BY ts DESC, event_id DESC) = 1"""))
def latest_wins(spark, sf_dir):
    rows = keep_first(base.events(spark, sf_dir), ["road_name", "slot"], [F.desc("ts"), F.desc("event_id")])
    return flat(rows.select("road_name", "slot", "event_id", "value"))


@register("p08_hourly_weather_present", with_sql(base.EV, """
SELECT count(*) > 0 AS has_hourly FROM ev WHERE CAST(slot AS DATE) = DATE '2024-01-15' AND minute(slot + INTERVAL 3 MINUTE) = 0"""))
def hourly_present(spark, sf_dir):
    return filters.has_hourly_rows(base.bronze_weather(spark, sf_dir), "2024-01-15")


@register("p09_road_filter", with_sql(SILVER, f"SELECT {base.SILVER_OUT} FROM silver WHERE road_name = 'road_2'"))
def one_road(spark, sf_dir):
    return flat(filters.for_road(base.silver_rows(spark, sf_dir), "  road_2 "))


@register("p10_latest_date", with_sql(GOLD, f"SELECT {base.GOLD_OUT} FROM gold WHERE date = (SELECT max(date) FROM gold)"))
def newest_day(spark, sf_dir):
    return flat(filters.latest_date(base.gold(spark, sf_dir)))


@register("p11_u03_date_range", with_sql(GOLD, f"""
SELECT {base.GOLD_OUT} FROM gold WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""))
def date_range(spark, sf_dir):
    return flat(filters.between_dates(base.gold(spark, sf_dir), "2024-01-10", "2024-01-20"))


@register("p12_row_search", with_sql(GOLD, f"""
SELECT {base.GOLD_OUT} FROM gold
WHERE contains(lower(roadName), 'ad_3') AND substr(recordDatetime, 12, 5) BETWEEN '07:00' AND '09:30'"""))
def row_search(spark, sf_dir):
    return flat(filters.search_rows(base.gold(spark, sf_dir), "AD_3", "07:00", "09:30"))


@register("p13_up_to_now", with_sql(SILVER, """
SELECT road_name, recordDatetime FROM silver
WHERE date < DATE '2024-01-20' OR (date = DATE '2024-01-20' AND (hour(rec_ts) * 60 + minute(rec_ts)) // 3 <= 250)"""))
def so_far(spark, sf_dir):
    rows = base.silver(spark, sf_dir).withColumn("bucket", times.bucket_of(F.col("rec_ts")))
    as_of = F.lit("2024-01-20 12:31:30").cast("timestamp")
    return filters.up_to_now(rows, as_of).select("road_name", "recordDatetime")


@register("p14_first_usable_column", with_sql(base.EV, """
SELECT event_id, CASE WHEN event_type = 'view' THEN k ELSE value END AS flow,
       coalesce(CASE WHEN event_type <> 'click' THEN weather_label END, 'second') AS weather
FROM ev"""))
def first_usable(spark, sf_dir):
    ev = base.events(spark, sf_dir)
    frame = ev.select(
        "event_id",
        F.when(F.col("event_type") == "view", F.col("k").cast("string")).otherwise(" not known").alias("actualFlow"),
        F.col("value").alias("avg_flow"),
        F.when(F.col("event_type") == "click", F.lit("  ")).otherwise(base._by_event_type(1)).alias("weather"),
        F.lit("second").alias("condition"),
    )
    return frame.select(
        "event_id",
        values.first_number(frame, values.FLOW_CANDIDATES).alias("flow"),
        values.first_text(frame, values.WEATHER_CANDIDATES).alias("weather"),
    )


@register("p16_real_edges", with_sql(base.EV, "SELECT event_id, user_id FROM ev WHERE event_type NOT IN ('view', 'click')"))
def edges_kept(spark, sf_dir):
    """Views stand for junction-internal edges, clicks for edges without a way."""
    edge = F.when(F.col("event_type") == "view", F.concat(F.lit(":j"), F.col("user_id").cast("string")))
    edge = edge.when(F.col("event_type") == "click", F.lit("-#4")).otherwise(F.col("user_id").cast("string"))
    return filters.real_edges(base.events(spark, sf_dir).withColumn("id", edge)).select("event_id", "user_id")


@register("p17_known_roads", with_sql(SILVER, """
SELECT road_name, recordDatetime FROM silver
WHERE road_name IN (SELECT road_name FROM ev GROUP BY road_name HAVING count(*) >= (SELECT count(*) / 5 FROM ev))"""))
def known_roads(spark, sf_dir):
    """Roads that hold at least a fifth of all readings."""
    ev = base.events(spark, sf_dir)
    total = ev.agg((F.count(F.lit(1)) / 5).alias("n")).scalar()
    busy = ev.groupBy("road_name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= total)
    return filters.known_to(base.silver(spark, sf_dir), busy, "road_name").select("road_name", "recordDatetime")


@register("p18_history_to_anchor", with_sql(SILVER, """
SELECT road_name, recordDatetime FROM silver WHERE rec_ts <= TIMESTAMP '2024-01-15 12:00:00'"""))
def history(spark, sf_dir):
    anchor = F.lit("2024-01-15 12:00:00").cast("timestamp")
    return filters.up_to_anchor(base.silver(spark, sf_dir), anchor).select("road_name", "recordDatetime")


@register("l01_preview", with_sql(base.EV, "SELECT count(*) AS n, true AS all_from_table FROM (SELECT 1 FROM ev LIMIT 50)"))
def previewed(spark, sf_dir):
    """Which rows a preview shows is open, so this states their number and that the table has them."""
    ev = base.events(spark, sf_dir)
    shown = preview(ev.select("event_id"), 50)
    found = shown.join(ev.select("event_id", F.lit(True).alias("hit")), "event_id", "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce("hit", F.lit(False))).alias("all_from_table"))


@register("l02_first_by_road_and_time", with_sql(SILVER, """
SELECT road_name, recordDatetime, avg_density, (SELECT count(*) FROM silver) AS row_count
FROM silver ORDER BY road_name, recordDatetime LIMIT 500"""))
def first_rows(spark, sf_dir):
    rows = base.silver(spark, sf_dir).select("road_name", "recordDatetime", "avg_density")
    return first_predictions(rows, 500)


@register("l03_sort_any_column", with_sql(base.EV, """
, mixed AS (SELECT event_id, CASE event_type WHEN 'view' THEN CAST(k AS VARCHAR) WHEN 'click' THEN strftime(slot, '%Y-%m-%dT%H:%M')
                   WHEN 'purchase' THEN upper(weather_label) WHEN 'signup' THEN weather_label END AS content,
                   CASE event_type WHEN 'view' THEN k END AS n, CASE event_type WHEN 'click' THEN slot END AS t FROM ev)
SELECT event_id, row_number() OVER (ORDER BY n NULLS LAST, t NULLS LAST, lower(content) NULLS LAST, event_id) AS place FROM mixed"""))
def sorted_any(spark, sf_dir):
    """Numbers, times and texts in one column; the place of every row in the order."""
    kind, label = F.col("event_type"), base._by_event_type(1)
    content = (
        F.when(kind == "view", F.col("k").cast("string"))
        .when(kind == "click", times.minute_text(F.col("slot")))
        .when(kind == "purchase", F.upper(label))
        .when(kind == "signup", label)
    )
    rows = base.events(spark, sf_dir).select("event_id", content.alias("content"))
    keyed = with_sort_keys(rows, "content").drop("content")
    return with_row_number(keyed, [*any_order(), F.asc("event_id")], "place").select("event_id", "place")


@register("l04_nulls_last", with_sql(base.BRONZE, """
SELECT id, row_number() OVER (ORDER BY flow DESC NULLS LAST, id) AS place FROM bronze"""))
def nulls_last(spark, sf_dir):
    rows = base.bronze_traffic(spark, sf_dir).select("id", "flow")
    return with_row_number(rows, [number_order("flow", True), F.asc("id")], "place").select("id", "place")


@register("l05_page", with_sql(GOLD, f"""
SELECT {base.GOLD_OUT} FROM gold ORDER BY avg_speed DESC, roadName, recordDatetime LIMIT 200 OFFSET 600"""))
def one_page(spark, sf_dir):
    order = [F.desc("avg_speed"), F.asc("roadName"), F.asc("recordDatetime")]
    return flat(page_rows(base.gold(spark, sf_dir), order, 4))


@register("l05_last_page", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
OFFSET (SELECT (count(*) - 1) // 200 * 200 FROM lineitem)""")
def last_page(spark, sf_dir):
    """A page number past the end shows the last page."""
    items = base.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    order = [F.asc(c) for c in [*keys, "l_extendedprice"]]
    return page_rows(items.select(*keys, "l_extendedprice"), order, 10**9).select(*keys)


@register("u01_merge_latest", with_sql(SILVER, """
SELECT road_name, recordDatetime, CASE WHEN weather LIKE '%rain%' THEN avg_flow + 1 ELSE avg_flow END AS avg_flow,
       CASE WHEN weather LIKE '%rain%' THEN 'checked' END AS note
FROM silver"""))
def merged(spark, sf_dir):
    """Rainy rows come again with a new flow and a new column; the new ones win."""
    old = base.silver(spark, sf_dir)
    new = old.filter(F.col("weather").contains("rain")).select(
        "road_name", "recordDatetime", (F.col("avg_flow") + 1).alias("avg_flow"), F.lit("checked").alias("note")
    )
    kept = old.select("road_name", "recordDatetime", "avg_flow")
    return merge_latest(new, kept, ["road_name", "recordDatetime"])


_SIDES = """
, names AS (SELECT user_id || '' AS road_name, CAST(slot AS DATE) AS date FROM ev),
sides AS (SELECT road_name, bool_or(date = DATE '2024-01-05') AS s, bool_or(date = DATE '2024-01-25') AS e
          FROM names WHERE date IN (DATE '2024-01-05', DATE '2024-01-25') GROUP BY road_name)
"""


def _users_as_roads(spark, sf_dir):
    return base.events(spark, sf_dir).select(F.col("user_id").cast("string").alias("road_name"), F.to_date("slot").alias("date"))


@register("u02_road_sets", with_sql(base.EV, _SIDES + """
SELECT road_name, CASE WHEN s AND e THEN 'shared' WHEN s THEN 'only_in_start' ELSE 'only_in_end' END AS side FROM sides"""))
def road_sets(spark, sf_dir):
    return road_membership(_users_as_roads(spark, sf_dir), "2024-01-05", "2024-01-25")


@register("u02_road_comparison", with_sql(base.EV, _SIDES + """
SELECT count(*) FILTER (s) AS start_unique_roads, count(*) FILTER (e) AS end_unique_roads,
       count(*) FILTER (s AND NOT e) AS only_in_start, count(*) FILTER (e AND NOT s) AS only_in_end,
       count(*) FILTER (s AND e) AS shared FROM sides"""))
def roads_compared(spark, sf_dir):
    return road_comparison(_users_as_roads(spark, sf_dir), "2024-01-05", "2024-01-25")


@register("w03_last_row_per_road", with_sql(SILVER, f"""
SELECT {base.SILVER_OUT} FROM silver QUALIFY row_number() OVER (PARTITION BY road_name ORDER BY rec_ts DESC) = 1"""))
def newest_rows(spark, sf_dir):
    rows = base.silver(spark, sf_dir)
    newest = last_row(rows, ["road_name"], "rec_ts")
    return flat(newest.select(*base.silver_rows(spark, sf_dir).columns))
