"""What to do with rows that arrive late, and the strict event-time forms.

Default: a late row is accepted and its hour recomputed. ``LatePolicy`` is the strict choice:
a row older than the stream's watermark, the greatest event time of earlier batches less the delay, goes to a side
table and leaves the layers as they are. The watermark is Spark's own: it is kept with each batch in the
stream's checkpoint, so a batch that is retried splits its rows as before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions import times
from kerbside.sources.tables import Layer

# --- fixed values: the delay, and where a checkpoint keeps a batch's watermark ---
WATERMARK_DELAY = "5 minutes"
WATERMARK_FIELD = "$.batchWatermarkMs"
# --- end of fixed values ---

EVENT_TIME = "_event_ts"


@dataclass(frozen=True)
class LatePolicy:
    delay_minutes: int = 5


def late_path(layer: Layer) -> str:
    return f"{layer.path}.late"


def event_time(rows: DataFrame) -> Column:
    """When a bronze row's interval or reading is of, traffic or weather."""
    return F.col("rec_ts") if "rec_ts" in rows.columns else times.parse_minute_text(F.col("datetime"))


def with_watermark(rows: DataFrame, policy: LatePolicy) -> DataFrame:
    """A bronze stream whose checkpoint follows its event time; no row is dropped."""
    return rows.withColumn(EVENT_TIME, event_time(rows)).withWatermark(EVENT_TIME, f"{policy.delay_minutes} minutes")


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """The watermark under which a batch was planned; the epoch before there is one."""
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id}")
    found = F.get_json_object("value", WATERMARK_FIELD).try_cast("bigint")
    at = lines.agg(F.max(found)).first()[0]
    return F.timestamp_millis(F.lit(at or 0).cast("bigint"))


def split_late(rows: DataFrame, batch_id: int, layer: Layer, watermark: Column) -> DataFrame:
    """Move a batch's late rows to the side table; returns the others. Rows without a time are not late."""
    is_late = F.coalesce(F.col(EVENT_TIME) < watermark, F.lit(False))
    late = rows.filter(is_late).drop(EVENT_TIME).withColumn("_batch", F.lit(batch_id).cast("bigint"))
    writer = late.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date", "_batch").parquet(late_path(layer))
    return rows.filter(~is_late).drop(EVENT_TIME)


def with_event_time(rows: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Watermark on the start of the interval, so that tumbling windows line up with it."""
    return rows.withColumn("interval_start", F.col("rec_ts") - F.expr("INTERVAL 3 MINUTES")).withWatermark(
        "interval_start", delay
    )


def interval_totals(rows: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Strict tumbling 3-minute totals per road; a window is final once the watermark passes."""
    timed = with_event_time(rows, delay)
    window = F.window("interval_start", "3 minutes")
    totals = timed.groupBy(window.alias("w"), "road_name").agg(
        F.count(F.lit(1)).alias("lanes"), F.sum("entered").alias("total_entered"), F.sum("left").alias("total_left")
    )
    return totals.select("road_name", F.col("w.end").alias("rec_ts"), "lanes", "total_entered", "total_left")


def without_repeats(rows: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Strict duplicate suppression within the watermark."""
    return with_event_time(rows, delay).dropDuplicatesWithinWatermark(["id", "recordDatetime"])
