"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import EV, flat, register, with_sql
from kerbside.functions import labels, roads, times, values


def _pick(index: Column, options: list[str | None]) -> Column:
    """Option number ``index`` (from 0) of a fixed list."""
    return F.try_element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def _sql_pick(index: str, options: list[str | None]) -> str:
    items = ", ".join("NULL" if o is None else "'" + o.replace("'", "''") + "'" for o in options)
    return f"list_extract([{items}], CAST({index} AS BIGINT) + 1)"


@register("f01_f04_f30_time_floors", with_sql(EV, """
SELECT event_id, strftime(slot, '%Y-%m-%dT%H:%M') AS slot, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS hour_floor,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, strftime(ts, '%Y-%m-%dT%H:%M') AS iso
FROM ev"""))
def time_floors(spark, sf_dir):
    ev = base.events(spark, sf_dir)
    ts = F.col("ts")
    return flat(ev.select(
        "event_id",
        times.minute_text(times.floor_minutes(ts)).alias("slot"),
        times.minute_text(times.floor_hour(ts)).alias("hour_floor"),
        F.hour(ts).alias("hour"),
        F.to_date(ts).alias("date"),
        times.minute_text(ts).alias("iso"),
    ))


@register("f05_f07_clock_texts", with_sql(EV, """
SELECT event_id,
       lpad(CAST(k * 873 // 60 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k * 873 // 60 % 60 AS VARCHAR), 2, '0') AS from_seconds,
       CASE WHEN k * 15 >= 1440 THEN '24:00'
            ELSE lpad(CAST(k * 15 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k * 15 % 60 AS VARCHAR), 2, '0') END AS from_minutes,
       strftime(slot, '%H%M') AS compact
FROM ev"""))
def clock_texts(spark, sf_dir):
    return base.events(spark, sf_dir).select(
        "event_id",
        times.seconds_to_clock((F.col("k") * 873).cast("string")).alias("from_seconds"),
        times.minutes_to_clock(F.col("k") * 15).alias("from_minutes"),
        times.compact_clock(F.date_format("slot", "HH:mm")).alias("compact"),
    )


@register("f06_f07_buckets", with_sql(EV, """
SELECT event_id, CAST((hour(ts) * 60 + minute(ts)) // 3 AS INTEGER) AS bucket,
       strftime(slot, '%H:%M') AS label,
       CAST(CASE WHEN user_id % 25 = 0 THEN (hour(ts) * 60 + minute(ts)) // 3
                 ELSE least(greatest(k - 30, 0), 23) * 20 END AS INTEGER) AS bucket_by_hour
FROM ev"""))
def buckets(spark, sf_dir):
    hour = F.when(F.col("user_id") % 25 != 0, F.col("k") - 30)
    return base.events(spark, sf_dir).select(
        "event_id",
        times.bucket_of(F.col("ts")).alias("bucket"),
        times.bucket_to_clock(times.bucket_of(F.col("ts"))).alias("label"),
        times.bucket_of(F.col("ts"), hour).alias("bucket_by_hour"),
    )


@register("f08_f10_minutes", with_sql(EV, """
SELECT event_id,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS from_iso,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS from_clock,
       CAST(least(greatest(floor(value * 4 + 0.5), 0), 1439) AS INTEGER) AS from_number,
       CAST(NULL AS INTEGER) AS from_words,
       CAST(floor((hour(ts) * 60 + minute(ts)) / 3.0 + 0.5) * 3 AS INTEGER) AS nearest_three,
       CAST(least(greatest(floor((hour(ts) * 60 + minute(ts)) / 5.0 + 0.5) * 5, 0), 1435) AS INTEGER) AS snapped
FROM ev"""))
def minutes(spark, sf_dir):
    minute = F.hour("ts") * 60 + F.minute("ts")
    return base.events(spark, sf_dir).select(
        "event_id",
        times.minute_from_text(times.minute_text(F.col("ts"))).alias("from_iso"),
        times.minute_from_text(F.date_format("ts", "'  'HH:mm:ss")).alias("from_clock"),
        times.minute_from_number(F.col("value") * 4).alias("from_number"),
        times.minute_from_text(F.col("event_type")).alias("from_words"),
        times.nearest_step(minute).alias("nearest_three"),
        times.snap_to_five(minute).alias("snapped"),
    )


# --- fixed values: the label tables again, written out as SQL and not made from the tables that the queries test ---
_WMO_SQL = """CASE k WHEN 0 THEN 'Clear sky' WHEN 1 THEN 'Mainly clear' WHEN 2 THEN 'Partly cloudy' WHEN 3 THEN 'Overcast'
  WHEN 45 THEN 'Fog' WHEN 48 THEN 'Icy fog' WHEN 51 THEN 'Light drizzle' WHEN 53 THEN 'Moderate drizzle' WHEN 55 THEN 'Dense drizzle'
  WHEN 61 THEN 'Slight rain' WHEN 63 THEN 'Moderate rain' WHEN 65 THEN 'Heavy rain' WHEN 71 THEN 'Slight snow' WHEN 73 THEN 'Moderate snow'
  WHEN 75 THEN 'Heavy snow' WHEN 80 THEN 'Slight showers' WHEN 81 THEN 'Moderate showers' WHEN 82 THEN 'Heavy showers'
  WHEN 95 THEN 'Thunderstorm' WHEN 96 THEN 'Thunderstorm w/ hail' WHEN 99 THEN 'Thunderstorm w/ heavy hail' ELSE 'Unknown' END"""
_VN_SQL = """WHEN 'clear sky' THEN 'Trời quang' WHEN 'few clouds' THEN 'Ít mây' WHEN 'scattered clouds' THEN 'Mây rải rác'
  WHEN 'broken clouds' THEN 'Nhiều mây' WHEN 'overcast clouds' THEN 'Trời u ám' WHEN 'light rain' THEN 'Mưa nhẹ' WHEN 'moderate rain' THEN 'Mưa vừa'
  WHEN 'heavy intensity rain' THEN 'Mưa to' WHEN 'thunderstorm' THEN 'Dông' WHEN 'mist' THEN 'Sương mù' WHEN 'fog' THEN 'Sương dày'"""
_CATEGORY_SQL = """CASE WHEN lower(label) SIMILAR TO '.*(thunder|storm|sấm).*' THEN 'storm' WHEN lower(label) SIMILAR TO '.*(rain|mưa|drizzle).*' THEN 'rain'
  WHEN lower(label) SIMILAR TO '.*(snow|tuyết).*' THEN 'snow' WHEN lower(label) SIMILAR TO '.*(fog|mist|sương).*' THEN 'fog'
  WHEN lower(label) SIMILAR TO '.*(cloud|mây|overcast|u ám).*' THEN 'cloud' WHEN lower(label) SIMILAR TO '.*(partly|few|ít mây).*' THEN 'partly'
  WHEN lower(label) SIMILAR TO '.*(clear|sunny|nắng|quang).*' THEN 'clear' ELSE 'other' END"""
_LIMITS_SQL = """CASE WHEN highway = 'trunk' THEN [1.5, 3, 5] WHEN highway = 'primary' THEN [3, 7, 11]
  WHEN highway IN ('secondary', 'tertiary') THEN [6, 12, 20] WHEN highway IN ('residential', 'service') THEN [3, 6, 10] ELSE [4, 8, 12] END"""
# --- end of fixed values ---


@register("f11_f13_weather_labels", with_sql(EV, f"""
, labelled AS (SELECT event_id, {_WMO_SQL} AS label FROM ev)
SELECT event_id, label, {_CATEGORY_SQL} AS category,
       CASE lower(label) {_VN_SQL} ELSE label END AS vietnamese,
       contains(lower(label), 'rain') AS rainy
FROM labelled"""))
def weather_labels(spark, sf_dir):
    labelled = base.events(spark, sf_dir).select("event_id", labels.weather_label(F.col("k")).alias("label"))
    label = F.col("label")
    return labelled.select(
        "event_id", "label",
        labels.weather_category(label).alias("category"),
        labels.weather_in_vietnamese(label).alias("vietnamese"),
        labels.is_rainy(label).alias("rainy"),
    )


# --- fixed values: phrases that reach every category and translation ---
_PHRASES = [
    "Clear sky", "few clouds", "SCATTERED CLOUDS", "broken clouds", "overcast clouds", "light rain", "moderate rain",
    "heavy intensity rain", "thunderstorm", "mist", "fog", "Nắng", "tuyết rơi", "Partly sunny", "dust", None,
]
# --- end of fixed values ---


@register("f12_f13_weather_phrases", with_sql(EV, f"""
, labelled AS (SELECT event_id, {_sql_pick('k % 16', _PHRASES)} AS label FROM ev)
SELECT event_id, {_CATEGORY_SQL} AS category,
       coalesce(CASE lower(label) {_VN_SQL} ELSE label END, '') AS vietnamese
FROM labelled"""))
def weather_phrases(spark, sf_dir):
    label = _pick(F.col("k") % 16, _PHRASES)
    return base.events(spark, sf_dir).select(
        "event_id",
        labels.weather_category(label).alias("category"),
        labels.weather_in_vietnamese(label).alias("vietnamese"),
    )


_HIGHWAYS = ["trunk", "primary", "secondary", "tertiary", "residential", "service", "footway", None]

@register("f16_density_classes", with_sql(EV, f"""
, roads AS (SELECT event_id, {_sql_pick('user_id % 8', _HIGHWAYS)} AS highway,
                   CASE WHEN event_type <> 'error' THEN k / 4.0 END AS density FROM ev),
limits AS (SELECT *, {_LIMITS_SQL} AS t FROM roads)
SELECT event_id, CASE WHEN density IS NULL THEN 'no data' WHEN density < t[1] THEN 'free'
       WHEN density < t[2] THEN 'busy' WHEN density < t[3] THEN 'heavy' ELSE 'jammed' END AS density_class
FROM limits"""))
def density_classes(spark, sf_dir):
    density = F.when(F.col("event_type") != "error", F.col("k") / 4)
    return base.events(spark, sf_dir).select(
        "event_id", labels.density_class(density, _pick(F.col("user_id") % 8, _HIGHWAYS)).alias("density_class")
    )


# --- fixed values: street words before a road's name ---
_STREETS = ["Đường Láng", "Phố Huế", "ngõ  Tạm  Thương", "Hẻm Số Sáu", "NGÁCH Trần Hưng Đạo", "Cầu Giấy", "Đường", "Nguyễn Văn Huyên"]
# --- end of fixed values ---
_NORMAL_SQL = """trim(regexp_replace(regexp_replace(regexp_replace(
       lower(replace(replace(strip_accents({0}), 'đ', 'd'), 'Đ', 'D')),
       '^\\s*\\d+[a-z]?(?:[/-]\\d+[a-z]?)?\\s+', '', 'i'), '^(duong|pho|ngo|ngach|hem)\\s+', '', 'i'), '\\s+', ' ', 'g'))"""


@register("f17_normal_road_names", with_sql(EV, f"""
, named AS (SELECT event_id, CASE k % 4 WHEN 0 THEN k || ' ' WHEN 1 THEN k || 'B/' || user_id || 'c  ' WHEN 2 THEN k || '-7 ' ELSE '' END
            || {_sql_pick('user_id % 8', _STREETS)} AS name FROM ev)
SELECT event_id, {_NORMAL_SQL.format('name')} AS normal FROM named"""))
def normal_road_names(spark, sf_dir):
    k, user = F.col("k").cast("string"), F.col("user_id").cast("string")
    house = (
        F.when(F.col("k") % 4 == 0, F.concat(k, F.lit(" ")))
        .when(F.col("k") % 4 == 1, F.concat(k, F.lit("B/"), user, F.lit("c  ")))
        .when(F.col("k") % 4 == 2, F.concat(k, F.lit("-7 ")))
        .otherwise("")
    )
    name = F.concat(house, _pick(F.col("user_id") % 8, _STREETS))
    return base.events(spark, sf_dir).select("event_id", roads.normal_road_name(name).alias("normal"))


@register("f17_normal_texts", f"SELECT conv_id, turn, md5({_NORMAL_SQL.format('text')}) AS normal_md5 FROM conversations")
def normal_texts(spark, sf_dir):
    texts = base.table(spark, sf_dir, "conversations")
    return texts.select("conv_id", "turn", F.md5(roads.normal_road_name(F.col("text"))).alias("normal_md5"))


@register("f18_f19_edge_keys", with_sql(base.BRONZE, """
, wayed AS (SELECT *, split_part(ltrim(id, '-'), '#', 1) AS way FROM bronze)
SELECT event_id, array_to_string([x FOR x IN
         [id, CASE WHEN id LIKE '-%' THEN substr(id, 2) END, way, CASE WHEN id LIKE '-%' THEN NULL ELSE NULL END] IF x IS NOT NULL], '|') AS keys,
       CASE WHEN event_type = 'view' THEN NULL ELSE way END AS way_id
FROM wayed"""))
def edge_keys(spark, sf_dir):
    """View events stand for junction-internal edges."""
    lanes = base.landing_traffic(spark, sf_dir)
    event = F.substring_index("id", "#", -1).cast("bigint").alias("event_id")
    ev = base.events(spark, sf_dir).select("event_id", "event_type")
    keyed = lanes.select(event, "id").join(ev, "event_id")
    inner = F.when(F.col("event_type") == "view", F.concat(F.lit(":"), F.col("id"))).otherwise(F.col("id"))
    return keyed.select(
        "event_id", F.array_join(roads.edge_keys(F.col("id")), "|").alias("keys"), roads.way_of_edge(inner).alias("way_id")
    )


# --- fixed values: texts that are and are not numbers ---
_NUMBERS = ["", "  ", " 12 ", "abc", "NaN", "Infinity", "-1.5e3", "7.", ".5", "1,000", None, "1d"]
# --- end of fixed values ---


@register("f20_number_texts", with_sql(EV, f"""
, texts AS (SELECT event_id, CASE WHEN k % 13 = 12 THEN CAST(k AS VARCHAR) || '.25'
                                  ELSE {_sql_pick('k % 13', _NUMBERS + [None])} END AS t FROM ev)
SELECT event_id, CASE WHEN trim(t) IN ('12', '-1.5e3', '7.', '.5') OR t LIKE '%.25' THEN CAST(trim(t) AS DOUBLE) END AS number
FROM texts"""))
def number_texts(spark, sf_dir):
    text = F.when(F.col("k") % 13 == 12, F.concat(F.col("k").cast("string"), F.lit(".25"))).otherwise(
        _pick(F.col("k") % 13, _NUMBERS + [None])
    )
    return base.events(spark, sf_dir).select("event_id", values.number_from_text(text).alias("number"))


@register("f21_distances", """
SELECT c_custkey,
       round(sqrt(pow((21.03 - lat) * 111000, 2) + pow((105.85 - lon) * 111000 * cos(radians(lat)), 2)), 3) AS metres
FROM (SELECT c_custkey, 21.0 + (c_custkey % 1000) / 10000.0 AS lat, 105.8 + (c_custkey % 777) / 10000.0 AS lon FROM customer)""")
def distances(spark, sf_dir):
    from kerbside.catalog.maps import points

    metres = roads.metres_between(F.col("lat"), F.col("lon"), F.lit(21.03), F.lit(105.85))
    return points(spark, sf_dir).select(F.col("point_id").alias("c_custkey"), F.round(metres, 3).alias("metres"))


@register("f14_speed_units", with_sql(EV, """
SELECT event_id, CASE WHEN value < 20.0 / 3.6 THEN 1 ELSE 0 END AS congested, value * 3.6 AS speed_kmh FROM ev"""))
def speed_units(spark, sf_dir):
    return base.events(spark, sf_dir).select(
        "event_id",
        values.congestion_flag(F.col("value")).alias("congested"),
        values.speed_kmh(F.col("value")).alias("speed_kmh"),
    )


@register("f22_mean_or_zero", with_sql(EV, """
SELECT road_name, CAST(slot AS VARCHAR) AS slot, coalesce(round(avg(CASE WHEN event_type <> 'error' THEN k END), 2), 0.0) AS avg_flow
FROM ev GROUP BY road_name, slot"""))
def mean_or_zero(spark, sf_dir):
    flow = F.when(F.col("event_type") != "error", F.col("k"))
    return flat(base.events(spark, sf_dir).groupBy("road_name", "slot").agg(values.mean_or_zero(flow).alias("avg_flow")))


@register("f23_f25_defaults_and_clips", with_sql(EV, """
, x AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN CAST('inf' AS DOUBLE)
                WHEN event_type = 'click' THEN CAST('nan' AS DOUBLE) ELSE (value - 100) * 20 END AS v,
               CASE WHEN event_type <> 'error' THEN value END AS p, CASE WHEN event_type <> 'error' THEN weather_label END AS w FROM ev)
SELECT event_id, coalesce(p, 0.0) AS precipitation, coalesce(w, 'Unknown') AS weather,
       CASE WHEN v IS NULL OR isnan(v) OR isinf(v) THEN 0.0 ELSE least(greatest(v, -1000.0), 1000.0) END AS model_input,
       CASE WHEN v IS NULL OR isnan(v) THEN 0.0 ELSE least(greatest(v, -1.0), 2.0) END AS scaled
FROM x"""))
def defaults(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    odd = (
        F.when(kind == "error", F.lit(None).cast("double"))
        .when(kind == "view", F.lit(float("inf")))
        .when(kind == "click", F.lit(float("nan")))
        .otherwise((value - 100) * 20)
    )
    known = kind != "error"
    label = base._by_event_type(1)
    return base.events(spark, sf_dir).select(
        "event_id",
        values.rain_or_zero(F.when(known, value)).alias("precipitation"),
        values.weather_or_unknown(F.when(known, label)).alias("weather"),
        values.model_input(odd).alias("model_input"),
        values.scaled_density(odd).alias("scaled"),
    )


@register("f24_calendar", with_sql(EV, """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
       CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend
FROM ev"""))
def calendar(spark, sf_dir):
    return base.events(spark, sf_dir).select(
        "event_id", *[c.alias(n) for n, c in times.calendar_features(F.col("ts")).items()]
    )


@register("f26_horizons", with_sql(EV, """
, h AS (SELECT event_id, slot, k + 1 AS step, slot + to_minutes(CAST(user_id + 1 AS BIGINT)) AS target, CAST(user_id + 1 AS INTEGER) AS horizon FROM ev),
s AS (SELECT *, CAST(ceil(horizon / step) AS INTEGER) AS steps FROM h)
SELECT event_id, horizon, steps, strftime(target, '%Y-%m-%dT%H:%M') AS last_step,
       CASE WHEN steps > 1 THEN strftime(slot + to_minutes(step), '%Y-%m-%dT%H:%M') ELSE strftime(target, '%Y-%m-%dT%H:%M') END AS first_step
FROM s"""))
def horizons(spark, sf_dir):
    target = F.timestamp_seconds(F.unix_seconds("slot") + (F.col("user_id") + 1) * 60)
    rows = base.events(spark, sf_dir).withColumns({"target": target, "step": F.col("k") + 1})
    rows = rows.withColumn("horizon", times.horizon_minutes(F.col("slot"), F.col("target")))
    rows = rows.withColumn("steps", times.step_count(F.col("horizon"), F.col("step")))

    def at(step: Column) -> Column:
        return times.minute_text(times.step_time(F.col("slot"), F.col("target"), step, F.col("steps"), F.col("step")))

    return rows.select("event_id", "horizon", "steps", at(F.col("steps")).alias("last_step"), at(F.lit(1)).alias("first_step"))


@register("f28_local_times", with_sql(EV, """
SELECT event_id, CASE WHEN k % 3 < 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS local FROM ev"""))
def local_times(spark, sf_dir):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("k") % 3 == 0, F.concat(iso, F.lit("+05:30"))).when(F.col("k") % 3 == 1, iso).otherwise("soon")
    return flat(base.events(spark, sf_dir).select("event_id", times.parse_local(text).alias("local")))


@register("f29_day_schedules", with_sql(EV, """
SELECT event_id, CAST(((hour(ts) * 60 + minute(ts)) // 3 + 1) * 3 AS INTEGER) AS first_end,
       CAST((1440 - ((hour(ts) * 60 + minute(ts)) // 3 + 1) * 3) // 3 + 1 AS INTEGER) AS intervals
FROM ev"""))
def day_schedules(spark, sf_dir):
    first = times.next_interval_end(F.hour("ts") * 60 + F.minute("ts"))
    return base.events(spark, sf_dir).select(
        "event_id", first.alias("first_end"), F.size(times.day_schedule(first)).alias("intervals")
    )
