"""Layer tables: written to the shared scratch folder from the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.operators.aggregates import envelope
from kerbside.plans.backfill import Lake, backfill_day
from kerbside.plans.silver import published
from kerbside.schemas import GOLD_COLUMNS, SILVER_KEYS
from kerbside.session import scratch_path
from kerbside.sources import tables
from kerbside.sources.landing import write_landing
from kerbside.sources.tables import Layer


def _event_layer(spark, name: str) -> Layer:
    return Layer(scratch_path(spark, name), ["event_id"])


def _by_date(rows):
    """Each date's rows in one task, so that a write makes one file a date; dates are dealt over tasks."""
    return rows.repartition("date")


def _event_rows(spark, sf_dir):
    ev = base.events(spark, sf_dir)
    return ev.select("event_id", "event_type", "value", F.to_date("slot").alias("date"))


_E = base.EV + ", e AS (SELECT event_id, event_type, value, CAST(CAST(slot AS DATE) AS VARCHAR) AS date FROM ev)"


@register("s04_layer_columns", with_sql(base.silver_sql(), """
SELECT road_name, recordDatetime, avg_flow, CAST(date AS VARCHAR) AS date FROM silver"""))
def layer_columns(spark, sf_dir):
    layer = Layer(scratch_path(spark, "silver"), SILVER_KEYS)
    tables.create(base.silver_rows(spark, sf_dir), layer)
    return flat(tables.read_layer(spark, layer, ["road_name", "recordDatetime", "avg_flow", "date"]))


@register("s05_union_by_name", with_sql(_E, """
SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value,
       CASE WHEN event_type = 'error' THEN date END AS seen_on FROM e"""))
def union_by_name(spark, sf_dir):
    rows = _event_rows(spark, sf_dir)
    first, second = scratch_path(spark, "union"), scratch_path(spark, "union")
    is_error = F.col("event_type") == "error"
    rows.filter(~is_error).select("event_id", "event_type", "value").write.parquet(first)
    rows.filter(is_error).select("event_type", "event_id", F.col("date").alias("seen_on")).write.parquet(second)
    return flat(tables.scan_union(spark, [first, second]))


@register("s05_union_of_mixed_types", with_sql(_E, """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS value FROM e"""))
def union_of_mixed(spark, sf_dir):
    rows = _event_rows(spark, sf_dir)
    first, second = scratch_path(spark, "mixed"), scratch_path(spark, "mixed")
    is_error = F.col("event_type") == "error"
    rows.filter(~is_error).select("event_id", F.col("event_id").alias("value")).write.parquet(first)
    rows.filter(is_error).select("event_id", F.lit("n/a").alias("value")).write.parquet(second)
    return tables.scan_union_mixed(spark, [first, second])


@register("s06_append", with_sql(_E, "SELECT event_id, event_type, value, date FROM e UNION ALL SELECT event_id, event_type, value, date FROM e WHERE event_type = 'error'"))
def appended(spark, sf_dir):
    layer = _event_layer(spark, "append")
    rows = _event_rows(spark, sf_dir)
    tables.append(rows, layer)
    tables.append(rows.filter("event_type = 'error'"), layer)
    return flat(tables.read_layer(spark, layer))


@register("s07_create_once", with_sql(_E, "SELECT event_id, event_type, value, date, true AS refused FROM e"))
def created(spark, sf_dir):
    """A second create is refused and leaves the table as it was."""
    from pyspark.errors import AnalysisException

    layer = _event_layer(spark, "create")
    rows = _event_rows(spark, sf_dir)
    tables.create(rows, layer)
    refused = False
    try:
        tables.create(rows.limit(0), layer)
    except AnalysisException:
        refused = True
    return flat(tables.read_layer(spark, layer).withColumn("refused", F.lit(refused)))


@register("s08_replace_date", with_sql(_E, """
SELECT event_id, event_type, CASE WHEN date = '2024-01-15' THEN -value ELSE value END AS value, date FROM e
WHERE date <> '2024-01-15' OR event_type <> 'error'"""))
def replaced(spark, sf_dir):
    layer = _event_layer(spark, "replace")
    rows = _event_rows(spark, sf_dir)
    tables.create(rows, layer)
    day = rows.filter("date = DATE'2024-01-15' AND event_type <> 'error'").withColumn("value", -F.col("value"))
    tables.replace_date(day, layer, "2024-01-15")
    return flat(tables.read_layer(spark, layer))


@register("s09_upsert", with_sql(_E, """
SELECT event_id, event_type, CASE WHEN event_type IN ('error', 'purchase') THEN value + 1000 ELSE value END AS value, date FROM e"""))
def upserted(spark, sf_dir):
    """Errors are new, purchases change."""
    layer = _event_layer(spark, "upsert")
    rows = _event_rows(spark, sf_dir)
    tables.upsert(rows.filter("event_type <> 'error'"), layer)
    tables.upsert(rows.filter("event_type IN ('error', 'purchase')").withColumn("value", F.col("value") + 1000), layer)
    return flat(tables.read_layer(spark, layer))


@register("s09_upsert_repeated_source", with_sql(_E, """
, s AS (SELECT event_type, date, arg_max(value, event_id) AS value FROM e GROUP BY ALL)
SELECT event_type, date, value FROM s"""))
def upserted_newest(spark, sf_dir):
    """Many source rows per key: the newest wins."""
    layer = Layer(scratch_path(spark, "newest"), ["date", "event_type"])
    tables.upsert(_event_rows(spark, sf_dir), layer, order=[F.desc("event_id")])
    return flat(tables.read_layer(spark, layer, ["event_type", "date", "value"]))


@register("s09_upsert_null_keys", with_sql(_E, """
SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id, event_type, value, date FROM e"""))
def upserted_null_keys(spark, sf_dir):
    """Events that lost their id are all kept, each written once."""
    layer = _event_layer(spark, "nulls")
    rows = _event_rows(spark, sf_dir).withColumn("event_id", F.when(F.col("event_type") != "error", F.col("event_id")))
    tables.upsert(rows.filter("event_type <> 'error'"), layer, order=[F.desc("value")])
    changed = rows.filter("event_type IN ('error', 'purchase')")
    tables.upsert(changed, layer, order=[F.desc("value")])
    return flat(tables.read_layer(spark, layer))


@register("s10_added_column", with_sql(_E, """
SELECT event_id, event_type, value, date, CASE WHEN event_type = 'error' THEN 'checked' END AS note FROM e"""))
def column_added(spark, sf_dir):
    layer = _event_layer(spark, "evolve")
    rows = _event_rows(spark, sf_dir)
    tables.upsert(rows, layer)
    tables.upsert(rows.filter("event_type = 'error'").withColumn("note", F.lit("checked")), layer)
    return flat(tables.read_layer(spark, layer))


@register("s19_layer_dates", with_sql(_E, "SELECT DISTINCT date FROM e"))
def dates(spark, sf_dir):
    layer = _event_layer(spark, "dates")
    tables.create(_event_rows(spark, sf_dir), layer)
    return flat(tables.layer_dates(spark, layer))


@register("s20_a23_files_per_date", with_sql(_E, """
SELECT date, count(*) AS row_count, 1 AS object_count, 'event_id|event_type|value|date' AS columns FROM e GROUP BY date"""))
def files(spark, sf_dir):
    """Each date is written by one task, so that it is one file."""
    layer = _event_layer(spark, "files")
    _by_date(_event_rows(spark, sf_dir)).write.partitionBy("date").parquet(layer.path)
    counted = envelope(tables.with_file(tables.read_layer(spark, layer)), by=["date"])
    return flat(counted.select("date", "row_count", F.col("object_count").cast("int").alias("object_count"), F.array_join("columns", "|").alias("columns")))


@register("a23_latest_envelope", with_sql(_E, """
SELECT date AS target_date, 'event_id|event_type|value|date' AS columns, count(*) AS row_count, 1 AS object_count
FROM e WHERE date = (SELECT max(date) FROM e) GROUP BY date"""))
def latest_envelope(spark, sf_dir):
    """What a layer's newest date holds."""
    layer = _event_layer(spark, "latest")
    _by_date(_event_rows(spark, sf_dir)).write.partitionBy("date").parquet(layer.path)
    found = tables.latest_envelope(spark, layer)
    return flat(found.select("target_date", F.array_join("columns", "|").alias("columns"), "row_count", F.col("object_count").cast("int").alias("object_count")))


@register("s20_files_listed", with_sql(_E, "SELECT date, count(DISTINCT event_type) AS files FROM e GROUP BY date"))
def files_listed(spark, sf_dir):
    """One write per kind of event, so each kind of a date is one current file."""
    layer = _event_layer(spark, "listed")
    for kind in base.EVENT_WEATHER:
        tables.append(_by_date(_event_rows(spark, sf_dir).filter(F.col("event_type") == kind)), layer)
    listed = tables.files_per_date(spark, layer)
    in_folder = F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})/", 1)
    return flat(listed.groupBy("date").agg(
        F.bool_and(in_folder == F.col("date").cast("string")).alias("ok"), F.count("*").alias("files")).filter("ok").select("date", "files"))


@register("s06_compacted", with_sql(_E, "SELECT event_id, event_type, value, date FROM e"))
def compacted(spark, sf_dir):
    layer = _event_layer(spark, "compact")
    rows = _event_rows(spark, sf_dir)
    for kind in base.EVENT_WEATHER:
        tables.append(rows.filter(F.col("event_type") == kind), layer)
    tables.compact(spark, layer, ["2024-01-10", "2024-01-15"])
    return flat(tables.read_layer(spark, layer))


_DAY = base.gold_sql("hour").replace("FROM events)", "FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events))")


@register("backfilled_day", with_sql(_DAY, f"SELECT {base.GOLD_OUT} FROM gold"))
def backfilled(spark, sf_dir):
    """The newest day's landing files through all layers in batch, run twice."""
    landing = base.landing_traffic(spark, sf_dir)
    folder = scratch_path(spark, "landing")
    write_landing(landing, folder, per_interval=False)
    day = landing.agg(F.max("date")).first()[0]
    lake = Lake(scratch_path(spark, "lake"))
    weather = base.bronze_weather(spark, sf_dir, "hour")
    for _ in range(2):
        backfill_day(spark, lake, folder, day, weather, base.fixed_clock(), "day={day}")
    return flat(tables.read_layer(spark, lake.gold, GOLD_COLUMNS))


@register("backfilled_silver_contract", with_sql(_DAY, f"SELECT {base.SILVER_OUT} FROM silver"))
def backfilled_silver(spark, sf_dir):
    landing = base.landing_traffic(spark, sf_dir)
    folder = scratch_path(spark, "landing")
    write_landing(landing, folder, per_interval=False)
    day = landing.agg(F.max("date")).first()[0]
    lake = Lake(scratch_path(spark, "lake"))
    backfill_day(spark, lake, folder, day, base.bronze_weather(spark, sf_dir, "hour"), base.fixed_clock(), "day={day}")
    return flat(published(tables.read_layer(spark, lake.silver)))
