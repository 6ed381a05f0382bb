"""Landing zone: JSON files per interval, topic messages and simulation XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import roads, times
from kerbside.schemas import INTERVAL_XML, TRAFFIC_MEASURES

# --- fixed values ---
MAX_FILES_PER_TRIGGER = 200
LANDING_FILES = "*.json"
SIMULATION_SUFFIX = "*_output.xml"
# --- end of fixed values ---


def read_landing_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int = MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Stream of the landing files of all dates, at any depth, a capped number per batch."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", LANDING_FILES)
        .option("maxFilesPerTrigger", str(max_files))
        .json(path)
    )


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, day: str | None = None, layout: str = "{day}"
) -> DataFrame:
    """Landing files of all dates, or of the one whose folder ``layout`` names."""
    folder = path if day is None else f"{path}/{layout.format(day=day)}"
    options = {"recursiveFileLookup": "true", "pathGlobFilter": LANDING_FILES}
    return spark.read.schema(schema).options(**options).json(folder)


def write_landing(df: DataFrame, path: str, per_interval: bool = True) -> None:
    """One JSON group per date and interval end, ``<path>/day=<date>/clock=<hhmm>/``, or per
    date only. Date and end also stay inside the records."""
    keys = {"day": F.col("date"), "clock": times.compact_clock(F.col("end"))}
    if not per_interval:
        del keys["clock"]
    keyed = df.withColumns(keys).hint("rebalance", *[F.col(k) for k in keys])
    keyed.write.mode("append").partitionBy(*keys).json(path)


def decode_topic(messages: DataFrame, schema: T.StructType, key_as_road: bool = False) -> DataFrame:
    """Rows of JSON topic messages; works on any frame with binary ``key`` and ``value``.

    With ``key_as_road`` the message key replaces the payload's road name.
    """
    body = F.from_json(F.col("value").cast("string"), schema)
    rows = messages.select(F.col("key").cast("string").alias("_key"), body.alias("_body"))
    out = rows.select("_key", "_body.*")
    if key_as_road:
        out = out.withColumn("road_name", F.col("_key"))
    return out.drop("_key")


def read_topic_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Topic messages as a stream; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
        .select("key", "value")
    )


def land_topic_stream(rows: DataFrame, path: str, checkpoint: str, trigger: dict):
    """Write decoded messages as landing JSON; offsets advance after the files are durable."""
    return (
        rows.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .trigger(**trigger)
        .start()
    )


def read_interval_xml(spark: SparkSession, path: str) -> DataFrame:
    """Simulation output as one row per interval and edge, dated by the file name.

    Junction-internal edges are dropped; begin and end become HH:mm.
    """
    intervals = spark.read.format("xml").option("rowTag", "interval").schema(INTERVAL_XML).load(path)
    dated = intervals.withColumn("date", times.date_from_file_name(F.col("_metadata.file_path")))
    edges = dated.select("date", "_begin", "_end", F.explode("edge").alias("e"))
    return edges.filter(~roads.is_internal_edge(F.coalesce(F.col("e._id"), F.lit("")))).select(
        F.col("e._id").alias("id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        times.seconds_to_clock(F.col("_begin")).alias("begin"),
        times.seconds_to_clock(F.col("_end")).alias("end"),
        *[F.col(f"e._{m}").alias(m) for m in TRAFFIC_MEASURES],
    )


def pending_files(files: DataFrame, processed: DataFrame, overwrite: bool = False,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """Files (``path``) still to be read, oldest date first: inside the optional inclusive
    bounds, and with a date not in ``processed.date`` unless ``overwrite``."""
    dated = files.withColumn("date", times.date_from_file_name(F.col("path")))
    if start is not None:
        dated = dated.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        dated = dated.filter(F.col("date") <= F.lit(end).cast("date"))
    if not overwrite:
        dated = dated.join(processed.select("date").distinct(), "date", "left_anti")
    return dated.orderBy("date", "path")


def list_files(spark: SparkSession, path: str, pattern: str = SIMULATION_SUFFIX) -> DataFrame:
    """Paths under a folder, listed by Spark without reading the contents."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return listing.load(path).select("path")
