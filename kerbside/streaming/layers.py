"""Landing → bronze → silver → gold as streams that give the batch result.

Each stream recomputes what its input touches instead of adding to what is stored: a batch is
turned into changed (road, date, hour) keys, the next layer rebuilds those hours from the
layer below and upserts them. However rows are split over batches, repeated or late, the
tables end as one batch run over all rows would leave them.

Order of writes: data first, changed keys second, checkpoint last. A failure in between only
repeats work, since every write is by partition or by key.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kerbside.functions import times
from kerbside.operators.filters import on_partitions_of
from kerbside.operators.joins import touched
from kerbside.plans.backfill import Lake
from kerbside.plans.bronze import newest_traffic, to_bronze_traffic, to_bronze_weather, with_bronze_hour
from kerbside.plans.gold import build_gold, with_hour
from kerbside.plans.silver import build_silver
from kerbside.schemas import BRONZE_TRAFFIC_KEYS, HOUR_KEYS, LANDING_TRAFFIC, LANDING_WEATHER
from kerbside.session import pin, written
from kerbside.sources.landing import MAX_FILES_PER_TRIGGER, read_landing_stream
from kerbside.sources.tables import Layer, append_batch, exists, publish_changes, read_layer, read_layer_stream, upsert
from kerbside.streaming.late import LatePolicy, split_late, watermark_of, with_watermark

# --- fixed values ---
BRONZE_TRIGGER = {"processingTime": "60 seconds"}
SILVER_TRIGGER = {"processingTime": "60 seconds"}
GOLD_TRIGGER = {"processingTime": "3 minutes"}
# --- end of fixed values ---
AVAILABLE_NOW = {"availableNow": True}

CHANGED_HOURS = T.StructType([
    T.StructField("road_name", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])


@dataclass(frozen=True)
class Streams:
    """Where the streams read, write and keep their progress, and how they treat weather and
    late rows. ``clock`` fixes the processing stamp."""

    lake: Lake
    traffic_landing: str
    weather_landing: str
    checkpoints: str
    grain: str = "interval"
    max_files: int = MAX_FILES_PER_TRIGGER
    late: LatePolicy | None = None
    clock: Column | None = None


def _hours_of_traffic(rows: DataFrame) -> DataFrame:
    named = rows.filter(F.col("road_name").isNotNull() & F.col("rec_ts").isNotNull())
    return named.select("road_name", "date", "hour")


def _hours_of_weather(rows: DataFrame, grain: str) -> DataFrame:
    """Hours whose traffic a reading may describe.

    Midnight is hour 0 of its day and hour 24 of the day before; as-of readings also reach
    into the next hour.
    """
    ts = times.parse_minute_text(F.col("datetime"))
    reach = 1 if grain == "as_of" else 0
    moments = F.explode(F.array(*[ts + F.expr(f"INTERVAL {h} HOURS") for h in range(reach + 1)]))
    at = rows.filter(F.col("road_name").isNotNull()).select("road_name", moments.alias("ts")).filter("ts IS NOT NULL")
    day, hour = F.to_date("ts"), F.hour("ts")
    here = F.struct(day.alias("date"), hour.alias("hour"))
    before = F.struct(F.date_sub(day, 1).alias("date"), F.lit(24).alias("hour"))
    places = F.when(hour == 0, F.array(here, before)).otherwise(F.array(here))
    return at.select("road_name", F.explode(places).alias("p")).select("road_name", "p.date", "p.hour")


def _hours_superseded(spark: SparkSession, layer: Layer, rows: DataFrame, batch_id: int) -> DataFrame:
    """Hours of stored readings that the batch's rows replace: a reading may have moved to another road."""
    named = rows.filter(F.col("id").isNotNull() & F.col("rec_ts").isNotNull())
    # A reading keeps its time, so its earlier copies lie in the same hours.
    stored = on_partitions_of(read_layer(spark, layer), named, ["date", "hour"]).filter(F.col("_batch") != batch_id)
    return _hours_of_traffic(stored.join(named.select(*BRONZE_TRAFFIC_KEYS), BRONZE_TRAFFIC_KEYS, "left_semi"))


def _prepare(spark: SparkSession, layer: Layer) -> None:
    """An empty first file, so that the next layer's stream can start before any change."""
    spark.createDataFrame([], CHANGED_HOURS).write.mode("append").parquet(layer.changes)


def _bronze(name: str, schema: T.StructType, to_rows: Callable, hours: Callable):
    """Starter of one bronze stream."""

    def start(spark: SparkSession, streams: Streams, trigger: dict) -> StreamingQuery:
        layer: Layer = getattr(streams.lake, name)
        source = getattr(streams, f"{name}_landing")
        checkpoint = f"{streams.checkpoints}/bronze_{name}"
        _prepare(spark, layer)

        def write(batch: DataFrame, batch_id: int) -> None:
            if batch.isEmpty():
                return
            rows = batch
            if streams.late is not None:
                rows = split_late(rows, batch_id, layer, watermark_of(spark, checkpoint, batch_id))
            timed = "rec_ts" in rows.columns
            append_batch(with_bronze_hour(rows) if timed else rows, batch_id, layer)
            if not exists(spark, layer):  # all rows were late
                return
            # From here on the batch is read back as stored, not parsed again.
            written_ = read_layer(spark, layer).filter(F.col("_batch") == batch_id)
            changed = hours(written_, streams)
            # In a table of this batch alone nothing can be replaced, and its rows need not be looked up.
            if timed and not read_layer(spark, layer).filter(F.col("_batch") != batch_id).isEmpty():
                changed = changed.unionByName(_hours_superseded(spark, layer, written_, batch_id))
            publish_changes(changed, layer)

        rows = to_rows(read_landing_stream(spark, source, schema, streams.max_files), streams.clock)
        if streams.late is not None:
            rows = with_watermark(rows, streams.late)
        return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    return start


start_bronze_traffic = _bronze(
    "traffic", LANDING_TRAFFIC, to_bronze_traffic, lambda rows, streams: _hours_of_traffic(rows)
)
start_bronze_weather = _bronze(
    "weather", LANDING_WEATHER, to_bronze_weather, lambda rows, streams: _hours_of_weather(rows, streams.grain)
)


def _changes(spark: SparkSession, streams: Streams, layer: Layer) -> DataFrame:
    """A layer's changed hours; what a trigger has done with is archived, so listings stay short."""
    return read_layer_stream(spark, layer, CHANGED_HOURS, streams.max_files, f"{streams.checkpoints}/done{layer.path.replace(':', '')}")


def rebuild_silver(spark: SparkSession, streams: Streams, hours: DataFrame) -> DataFrame:
    """Silver rows of the given road-hours, from all bronze rows of those hours."""
    lake = streams.lake
    in_hours = on_partitions_of(read_layer(spark, lake.traffic), hours, ["date", "hour"])
    traffic = touched(newest_traffic(in_hours), hours, HOUR_KEYS)
    if exists(spark, lake.weather):
        # Weather of the days themselves and, for 24:00, of the next; as-of looks back before.
        near = hours.select(F.explode(F.array(*[F.date_add("date", k) for k in (-1, 0, 1)])).alias("date"))
        weather = touched(on_partitions_of(read_layer(spark, lake.weather), near, ["date"]), hours.select("road_name").distinct(), ["road_name"])
    else:
        blank = spark.createDataFrame([], LANDING_WEATHER)
        weather = to_bronze_weather(blank, streams.clock)
    return build_silver(traffic, weather, streams.grain)


def start_silver(spark: SparkSession, streams: Streams, trigger: dict) -> StreamingQuery:
    lake = streams.lake
    for layer in (lake.traffic, lake.weather, lake.silver):
        _prepare(spark, layer)

    def write(batch: DataFrame, batch_id: int) -> None:
        hours = written(batch.distinct(), "hours")
        if hours.isEmpty() or not exists(batch.sparkSession, lake.traffic):
            return
        spark = batch.sparkSession
        upsert(pin(rebuild_silver(spark, streams, hours)), lake.silver, groups=hours, pinned=True)
        publish_changes(hours, lake.silver)

    changes = _changes(spark, streams, lake.traffic).unionByName(_changes(spark, streams, lake.weather))
    checkpoint = f"{streams.checkpoints}/silver"
    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_gold(spark: SparkSession, streams: Streams, trigger: dict) -> StreamingQuery:
    lake = streams.lake
    _prepare(spark, lake.silver)

    def write(batch: DataFrame, batch_id: int) -> None:
        hours = written(batch.distinct(), "hours")
        if hours.isEmpty() or not exists(batch.sparkSession, lake.silver):
            return
        silver = on_partitions_of(read_layer(batch.sparkSession, lake.silver), hours, ["date", "hour"])
        rebuilt = pin(with_hour(build_gold(touched(silver, hours, HOUR_KEYS))))
        upsert(rebuilt, lake.gold, groups=hours.withColumnRenamed("road_name", "roadName"), pinned=True)

    changes = _changes(spark, streams, lake.silver)
    checkpoint = f"{streams.checkpoints}/gold"
    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


@dataclass(frozen=True)
class Batch:
    """One finished trigger of a stream."""

    query: str
    number: int
    rows: int
    milliseconds: int


class BatchLog(StreamingQueryListener):
    """Rows and time of each trigger, and the streams that ended with an error. ``most`` triggers are remembered."""

    def __init__(self, most: int = 10_000):
        self.batches: deque[Batch] = deque(maxlen=most)
        self.failed: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.failed.pop(str(event.id), None)

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        self.batches.append(Batch(str(seen.id), seen.batchId, seen.numInputRows, seen.batchDuration))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failed[str(event.id)] = event.exception

    def of(self, query: StreamingQuery) -> list[Batch]:
        return [b for b in self.batches if b.query == query.id]


STARTERS = {
    "bronze_traffic": (start_bronze_traffic, BRONZE_TRIGGER),
    "bronze_weather": (start_bronze_weather, BRONZE_TRIGGER),
    "silver": (start_silver, SILVER_TRIGGER),
    "gold": (start_gold, GOLD_TRIGGER),
}


def start_all(spark: SparkSession, streams: Streams, trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """The four streams in one session, each at its own pace or all at ``trigger``'s.

    ``spark.streams.awaitAnyTermination()`` then waits; a stream that is stopped or fails is started again by its
    starter in ``STARTERS`` and goes on at its checkpoint.
    """
    return {name: start(spark, streams, trigger or own) for name, (start, own) in STARTERS.items()}


def carry_through(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until everything landed so far has reached gold."""
    for name in STARTERS:
        queries[name].processAllAvailable()


def stop_all(queries: Mapping[str, StreamingQuery]) -> None:
    for query in queries.values():
        query.stop()


def run_available(spark: SparkSession, streams: Streams) -> None:
    """Carry all landed files through to gold and return."""
    bronze = [start(spark, streams, AVAILABLE_NOW) for start in (start_bronze_traffic, start_bronze_weather)]
    for query in bronze:
        query.awaitTermination()
    for start in (start_silver, start_gold):
        start(spark, streams, AVAILABLE_NOW).awaitTermination()
