"""Streams over landed files, run until all files are read; each returns the table it leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.plans.backfill import Lake
from kerbside.plans.bronze import newest_traffic, to_bronze_traffic
from kerbside.plans.silver import published
from kerbside.schemas import GOLD_COLUMNS, LANDING_TRAFFIC
from kerbside.session import scratch_path
from kerbside.sources.landing import decode_topic, land_topic_stream, read_landing, read_landing_stream, write_landing
from kerbside.sources.tables import read_layer
from kerbside.streaming import layers
from kerbside.streaming.late import LatePolicy, interval_totals, late_path, without_repeats

_BRONZE_OUT = """SELECT id, road_name, recordDatetime, laneDensity, occupancy, waitingTime, speed, sampledSeconds, traveltime,
  flow, entered, left_ AS "left", timeloss, CAST(date AS VARCHAR) AS date FROM bronze"""


def _bronze_columns(df):
    return flat(df.drop("rec_ts", "processDatetime", "hour", "_batch"))


def _drain(stream, folder: str, mode: str = "append"):
    """Run a stream to a Parquet folder until its files are read; returns the rows."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", f"{folder}.checkpoint")
        .outputMode(mode).trigger(**layers.AVAILABLE_NOW).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


def _landed(spark, sf_dir) -> str:
    folder = scratch_path(spark, "landing")
    write_landing(base.landing_traffic(spark, sf_dir), folder, per_interval=False)
    return folder


@register("s01_t06_landing_stream", with_sql(base.BRONZE, _BRONZE_OUT))
def landing_stream(spark, sf_dir):
    """Several micro-batches of a few files each."""
    stream = read_landing_stream(spark, _landed(spark, sf_dir), LANDING_TRAFFIC, max_files=10)
    return _bronze_columns(_drain(to_bronze_traffic(stream), scratch_path(spark, "bronze")))


@register("s21_t05_incremental_pickup", with_sql(base.BRONZE, _BRONZE_OUT))
def incremental(spark, sf_dir):
    """Stopped and started again on its checkpoint after more files landed: each read once."""
    rows = base.landing_traffic(spark, sf_dir)
    folder, out = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    is_error = F.col("flow") == "n/a"
    for part in (rows.filter(is_error), rows.filter(~is_error)):
        write_landing(part, folder, per_interval=False)
        result = _drain(to_bronze_traffic(read_landing_stream(spark, folder, LANDING_TRAFFIC)), out)
    return _bronze_columns(result)


@register("s11_topic_stream", with_sql(base.BRONZE, """
SELECT id, road_name, CAST(date AS VARCHAR) AS date, CAST(k AS VARCHAR) AS entered FROM bronze"""))
def topic_stream(spark, sf_dir):
    """Messages stream in from files of keys and values and land as JSON."""
    rows = base.landing_traffic(spark, sf_dir)
    messages, out = scratch_path(spark, "topic"), scratch_path(spark, "landed")
    body = F.to_json(F.struct(*[c for c in rows.columns if c != "road_name"]))
    rows.select(F.col("road_name").cast("binary").alias("key"), body.cast("binary").alias("value")).write.parquet(messages)
    stream = spark.readStream.schema("key binary, value binary").parquet(messages)
    decoded = decode_topic(stream, LANDING_TRAFFIC, key_as_road=True)
    land_topic_stream(decoded, out, f"{out}.checkpoint", layers.AVAILABLE_NOW).awaitTermination()
    landed = spark.read.schema(LANDING_TRAFFIC).json(out)
    return landed.select("id", "road_name", F.date_format(F.col("date").cast("date"), "yyyy-MM-dd").alias("date"), "entered")


def _streams(spark, sf_dir, **options) -> layers.Streams:
    return layers.Streams(
        lake=Lake(scratch_path(spark, "lake")),
        traffic_landing=scratch_path(spark, "traffic"),
        weather_landing=scratch_path(spark, "weather"),
        checkpoints=scratch_path(spark, "checkpoints"),
        clock=base.fixed_clock(),
        **options,
    )


def _two_parts(spark, sf_dir):
    """Landing in two parts: errors and the rain's weather come second, late and splitting
    keys, together with copies of purchases from the first part."""
    traffic, weather = base.landing_traffic(spark, sf_dir), base.landing_weather(spark, sf_dir)
    is_error, is_rain = F.col("flow") == "n/a", F.col("weather").contains("rain")
    bought = base.events(spark, sf_dir).filter("event_type = 'purchase'").select(F.col("event_id").cast("string").alias("_e"))
    copies = traffic.withColumn("_e", F.substring_index("id", "#", -1)).join(bought, "_e", "left_semi").drop("_e")
    return (
        (traffic.filter(~is_error), weather.filter(~is_rain)),
        (traffic.filter(is_error).unionByName(copies), weather.filter(is_rain)),
    )


def _land(streams: layers.Streams, part) -> None:
    write_landing(part[0], streams.traffic_landing, per_interval=False)
    write_landing(part[1], streams.weather_landing, per_interval=False)


@register("t03_t09_silver_stream", with_sql(base.silver_sql(), f"SELECT {base.SILVER_OUT} FROM silver"))
def silver_stream(spark, sf_dir):
    """Each part is carried to silver before the next one lands."""
    streams = _streams(spark, sf_dir)
    for part in _two_parts(spark, sf_dir):
        _land(streams, part)
        for start in (layers.start_bronze_traffic, layers.start_bronze_weather, layers.start_silver):
            start(spark, streams, layers.AVAILABLE_NOW).awaitTermination()
    return flat(published(read_layer(spark, streams.lake.silver)))


@register("t07_t08_gold_stream", with_sql(base.gold_sql(), f"SELECT {base.GOLD_OUT} FROM gold"))
def gold_stream(spark, sf_dir):
    """Both parts landed, carried through all layers."""
    streams = _streams(spark, sf_dir)
    for part in _two_parts(spark, sf_dir):
        _land(streams, part)
    layers.run_available(spark, streams)
    return flat(read_layer(spark, streams.lake.gold, GOLD_COLUMNS))


@register("t11_newest_per_key", with_sql(base.BRONZE, _BRONZE_OUT))
def newest_per_key(spark, sf_dir):
    """Every file landed twice; readers of bronze see each reading once."""
    streams = _streams(spark, sf_dir)
    for _ in range(2):
        write_landing(base.landing_traffic(spark, sf_dir), streams.traffic_landing, per_interval=False)
        layers.start_bronze_traffic(spark, streams, layers.AVAILABLE_NOW).awaitTermination()
    return _bronze_columns(newest_traffic(read_layer(spark, streams.lake.traffic)))


@register("t11_without_repeats_strict", with_sql(base.BRONZE, _BRONZE_OUT))
def strict_without_repeats(spark, sf_dir):
    folder = scratch_path(spark, "landing")
    for _ in range(2):
        write_landing(base.landing_traffic(spark, sf_dir), folder, per_interval=False)
    stream = to_bronze_traffic(read_landing_stream(spark, folder, LANDING_TRAFFIC))
    return _bronze_columns(_drain(without_repeats(stream).drop("interval_start"), scratch_path(spark, "bronze")))


@register("t01_t02_interval_totals_strict", with_sql(base.BRONZE, """
SELECT road_name, strftime(rec_ts, '%Y-%m-%d %H:%M:%S') AS rec_ts, count(*) AS lanes, sum(entered) AS total_entered, sum(left_) AS total_left
FROM bronze WHERE rec_ts <= (SELECT max(slot) FROM bronze) - INTERVAL 5 MINUTE GROUP BY ALL"""))
def strict_totals(spark, sf_dir):
    """Windows the watermark has passed; those of the last five minutes stay open."""
    stream = to_bronze_traffic(read_landing_stream(spark, _landed(spark, sf_dir), LANDING_TRAFFIC))
    return flat(_drain(interval_totals(stream), scratch_path(spark, "totals")))


@register("t10_late_rows_strict", with_sql(base.BRONZE, """
SELECT id, date < DATE '2024-01-15' AS late FROM bronze"""))
def late_rows(spark, sf_dir):
    """Rows of the first half-month arrive after the second: all go to the side table."""
    streams = _streams(spark, sf_dir, late=LatePolicy(5))
    rows = base.landing_traffic(spark, sf_dir)
    for part in (rows.filter("date >= '2024-01-15'"), rows.filter("date < '2024-01-15'")):
        write_landing(part, streams.traffic_landing, per_interval=False)
        layers.start_bronze_traffic(spark, streams, layers.AVAILABLE_NOW).awaitTermination()
    traffic = streams.lake.traffic
    kept = read_layer(spark, traffic).select("id", F.lit(False).alias("late"))
    return kept.unionByName(spark.read.parquet(late_path(traffic)).select("id", F.lit(True).alias("late")))


@register("s03_layer_change_stream", with_sql(base.BRONZE, """
SELECT DISTINCT road_name, CAST(date AS VARCHAR) AS date, CAST(hour AS INTEGER) AS hour FROM bronze WHERE road_name IS NOT NULL"""))
def change_stream(spark, sf_dir):
    """The road-hours that the next layer is told of."""
    from kerbside.sources.tables import read_layer_stream

    streams = _streams(spark, sf_dir)
    write_landing(base.landing_traffic(spark, sf_dir), streams.traffic_landing, per_interval=False)
    layers.start_bronze_traffic(spark, streams, layers.AVAILABLE_NOW).awaitTermination()
    stream = read_layer_stream(spark, streams.lake.traffic, layers.CHANGED_HOURS)
    return flat(_drain(stream, scratch_path(spark, "changes")).distinct())


@register("s02_batch_equals_stream_landing", with_sql(base.BRONZE, "SELECT count(*) AS rows, count(DISTINCT id) AS ids FROM bronze"))
def counted(spark, sf_dir):
    folder = _landed(spark, sf_dir)
    rows = to_bronze_traffic(read_landing(spark, folder, LANDING_TRAFFIC)).select("id")
    per_id = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    return per_id.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("ids"))
