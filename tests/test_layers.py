"""The layers on a small day: edge rows, idempotence, and batch = stream."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kerbside.plans import gold as gold_plan
from kerbside.plans.backfill import Lake, backfill_day
from kerbside.plans.bronze import newest_traffic, to_bronze_traffic, to_bronze_weather
from kerbside.plans.silver import build_silver, published
from kerbside.schemas import GOLD_COLUMNS, LANDING_TRAFFIC, LANDING_WEATHER, TRAFFIC_MEASURES
from kerbside.operators.filters import on_partitions_of
from kerbside.session import scratch_path, written
from kerbside.sources import tables
from kerbside.sources.landing import write_landing
from kerbside.sources.tables import Layer
from kerbside.streaming import layers
from kerbside.streaming.late import LatePolicy, late_path

CLOCK = "2024-02-01 00:00:00"


def clock():
    return F.lit(CLOCK).cast("timestamp")


def lane(edge, road, day, begin, end, **measures):
    values = {m: "1" for m in TRAFFIC_MEASURES} | measures
    return (edge, road, day, begin, end, *[values[m] for m in TRAFFIC_MEASURES])


def reading(road, day, end, temperature, weather="Fog"):
    return ("w", road, day, end, end, temperature, 1.0, 50, 0.0, 45, weather, CLOCK)


DAY = "2024-01-31"
LANES = [
    lane("1#0", "A", DAY, "10:00", "10:03", speed="4", flow="10", entered="5"),
    lane("1#1", "A", DAY, "10:00", "10:03", speed="6", flow="20", entered="7"),
    lane("1#0", "A", DAY, "10:30", "10:33", speed="30", flow="100", entered="9"),
    lane("1#0", "A", DAY, "23:57", "24:00", flow="7"),
    lane("1#0", "A", DAY, "00:00", "00:03", flow="50"),
    lane("2", None, DAY, "10:00", "10:03"),
    lane("3", "B", DAY, "10:00", "10:03", speed="abc", flow="abc"),
    lane("3", "B", DAY, "11:57", "12:00", speed=None, flow="3.5"),
    lane("4", "C", DAY, "11:57", "12:00", flow="1"),
]
READINGS = [
    reading("A", DAY, "10:03", 20.0), reading("A", DAY, "10:03", 20.0), reading("A", DAY, "10:00", 18.0),
    reading("B", DAY, "12:00", 9.0, "Overcast"), reading("A", DAY, "24:00", 3.0, "Clear sky"),
]


@pytest.fixture(scope="module")
def lanes(spark):
    return spark.createDataFrame(LANES, LANDING_TRAFFIC)


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(READINGS, LANDING_WEATHER)


def batch_silver(lanes, readings, grain="interval"):
    return build_silver(newest_traffic(to_bronze_traffic(lanes, clock())), to_bronze_weather(readings, clock()), grain)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_bronze_keeps_every_row(lanes):
    bronze = to_bronze_traffic(lanes, clock())
    got = {(r["id"], r["recordDatetime"]): r for r in bronze.collect()}
    assert len(got) == len(LANES)
    closing = got[("1#0", "2024-02-01T00:00")]
    assert closing["date"] == date(2024, 1, 31) and closing["processDatetime"] == "2024-02-01T00:00"
    assert got[("3", "2024-01-31T10:03")]["speed"] is None


def test_silver_edge_rows(lanes, readings):
    got = {(r["road_name"], r["recordDatetime"]): r for r in batch_silver(lanes, readings).collect()}
    assert len(got) == 7
    two = got[("A", "2024-01-31T10:03")]
    assert (two["avg_speed"], two["avg_flow"], two["total_entered"], two["temperature"]) == (5.0, 15.0, 12.0, 20.0)
    assert got[("B", "2024-01-31T10:03")]["avg_flow"] == 0.0
    assert got[("B", "2024-01-31T10:03")]["weather"] is None
    assert got[("A", "2024-02-01T00:00")]["temperature"] == 3.0
    assert got[("A", "2024-02-01T00:00")]["hour"] == 24


def test_weather_grains(lanes, readings):
    hourly = {(r["road_name"], r["recordDatetime"]): r["temperature"] for r in batch_silver(lanes, readings, "hour").collect()}
    assert hourly[("A", "2024-01-31T10:03")] == hourly[("A", "2024-01-31T10:33")] == 18.0
    as_of = {(r["road_name"], r["recordDatetime"]): r["temperature"] for r in batch_silver(lanes, readings, "as_of").collect()}
    assert as_of[("A", "2024-01-31T10:33")] == 20.0
    assert as_of[("A", "2024-01-31T00:03")] is None and as_of[("C", "2024-01-31T12:00")] is None


def test_gold_extremes(lanes, readings):
    silver = batch_silver(lanes, readings)
    gold = {(r["roadName"], r["recordDatetime"]): r for r in gold_plan.build_gold(silver).collect()}
    early, late = gold[("A", "2024-01-31T10:03")], gold[("A", "2024-01-31T10:33")]
    assert (early["peakFlow"], early["minFlow"], late["peakFlow"], late["minFlow"]) == (100.0, 15.0, 100.0, 15.0)
    assert (early["congestionHour"], late["congestionHour"]) == (1, 0)
    assert gold[("A", "2024-02-01T00:00")]["peakFlow"] == 7.0 and gold[("A", "2024-01-31T00:03")]["peakFlow"] == 50.0
    assert gold[("B", "2024-01-31T12:00")]["congestionHour"] == 0
    assert rows(gold_plan.build_gold_by_join(silver)) == rows(gold_plan.build_gold(silver))


def make_streams(spark, **options):
    return layers.Streams(
        Lake(scratch_path(spark, "lake")), scratch_path(spark, "t"), scratch_path(spark, "w"), scratch_path(spark, "c"),
        clock=clock(), **options,
    )


def part_of(spark, rows_, schema):
    return spark.createDataFrame(rows_, schema)


@pytest.mark.parametrize("seed, grain", [(1, "interval"), (2, "hour")])
def test_any_split_and_order_gives_the_batch_result(spark, lanes, readings, seed, grain):
    rng = random.Random(seed)
    mixed = [("t", x) for x in LANES + LANES[:3]] + [("w", x) for x in READINGS]
    rng.shuffle(mixed)
    streams = make_streams(spark, grain=grain)
    third = len(mixed) // 3 + 1
    for start in range(0, len(mixed), third):
        part = mixed[start:start + third]
        for kind, schema, path in (("t", LANDING_TRAFFIC, streams.traffic_landing), ("w", LANDING_WEATHER, streams.weather_landing)):
            write_landing(part_of(spark, [x for k, x in part if k == kind], schema), path, per_interval=False)
        layers.run_available(spark, streams)
    want = batch_silver(lanes, readings, grain)
    assert rows(published(tables.read_layer(spark, streams.lake.silver))) == rows(published(want))
    assert rows(tables.read_layer(spark, streams.lake.gold, GOLD_COLUMNS)) == rows(gold_plan.build_gold(want))


def test_backfill_is_repeatable_and_loads_weather_once(spark, lanes, readings):
    folder, lake = scratch_path(spark, "landing"), Lake(scratch_path(spark, "lake"))
    write_landing(lanes, folder, per_interval=False)
    weather = to_bronze_weather(readings, clock())
    backfill_day(spark, lake, folder, DAY, weather, clock(), "day={day}")
    first = rows(tables.read_layer(spark, lake.gold, GOLD_COLUMNS))
    backfill_day(spark, lake, folder, DAY, weather.limit(0), clock(), "day={day}")
    assert rows(tables.read_layer(spark, lake.gold, GOLD_COLUMNS)) == first
    assert first == rows(gold_plan.build_gold(batch_silver(lanes, readings, "hour")))
    with pytest.raises(Exception):
        backfill_day(spark, lake, folder, "2024-03-01", weather, clock(), "day={day}")


def small(spark, values):
    return spark.createDataFrame(values, "k int, v string, d string").select("k", "v", F.col("d").cast("date").alias("date"))


def test_upsert_rules(spark):
    layer = Layer(scratch_path(spark, "u"), ["k", "date"])
    tables.upsert(small(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (None, "n", "2024-01-01")]), layer)
    tables.upsert(small(spark, [(1, "A", "2024-01-01"), (3, "c", "2024-01-03"), (None, "m", "2024-01-01")]), layer)
    got = sorted((r["k"] or 0, r["v"]) for r in tables.read_layer(spark, layer).collect())
    assert got == [(0, "m"), (0, "n"), (1, "A"), (2, "b"), (3, "c")]
    before = rows(tables.read_layer(spark, layer))
    with pytest.raises(ValueError, match="repeats a key"):
        tables.upsert(small(spark, [(1, "x", "2024-01-01"), (1, "y", "2024-01-01")]), layer)
    tables.upsert(small(spark, []), layer)
    assert rows(tables.read_layer(spark, layer)) == before


def test_replace_date_guards(spark):
    layer = Layer(scratch_path(spark, "r"), ["k"])
    tables.create(small(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]), layer)
    before = rows(tables.read_layer(spark, layer))
    with pytest.raises(Exception, match="outside"):
        tables.replace_date(small(spark, [(3, "c", "2024-01-01"), (4, "d", "2024-01-02")]), layer, "2024-01-01")
    with pytest.raises(ValueError):
        tables.replace_date(small(spark, []), layer, "2024-01-01")
    assert rows(tables.read_layer(spark, layer)) == before
    tables.replace_date(small(spark, [(9, "z", "2024-01-01")]), layer, "2024-01-01")
    assert [r[:2] for r in rows(tables.read_layer(spark, layer, ["k", "v"]))] == [(2, "b"), (9, "z")]


def test_batch_retry_replaces_its_own_rows(spark):
    layer = Layer(scratch_path(spark, "b"), ["k"], ("date", "_batch"))
    for number, values in ((0, [(1, "a", "2024-01-01")]), (1, [(2, "b", "2024-01-01")]), (1, [(2, "b", "2024-01-01")])):
        tables.append_batch(small(spark, values), number, layer)
    assert tables.read_layer(spark, layer).count() == 2


def test_rows_without_an_edge_all_count(spark, readings):
    """Lanes without an id, or without a time, are not one reading: stream and batch keep them all."""
    lanes = part_of(spark, [
        lane(None, "A", DAY, "10:00", "10:03", entered="5"), lane(None, "A", DAY, "10:00", "10:03", entered="7"),
        lane("1#0", "A", DAY, "10:00", "10:03", entered="1"),
    ], LANDING_TRAFFIC)
    streams = make_streams(spark)
    write_landing(lanes, streams.traffic_landing, per_interval=False)
    write_landing(readings.limit(0), streams.weather_landing, per_interval=False)
    layers.run_available(spark, streams)
    got = tables.read_layer(spark, streams.lake.silver)
    assert [r["total_entered"] for r in got.collect()] == [13.0]
    assert rows(published(got)) == rows(published(batch_silver(lanes, readings.limit(0))))


def test_a_reading_that_moves_to_another_road_leaves_the_first(spark, readings):
    first = [lane("1#0", "A", DAY, "10:00", "10:03", entered="5"), lane("2#0", "A", DAY, "10:03", "10:06", entered="6")]
    moved = [lane("1#0", "B", DAY, "10:00", "10:03", entered="8")]
    streams = make_streams(spark)
    write_landing(readings.limit(0), streams.weather_landing, per_interval=False)
    for k, part in enumerate((first, moved)):
        later = layers.Streams(**{**streams.__dict__, "clock": F.lit(f"2024-02-0{k + 1} 00:00:00").cast("timestamp")})
        write_landing(part_of(spark, part, LANDING_TRAFFIC), streams.traffic_landing, per_interval=False)
        layers.run_available(spark, later)
    got = {(r["road_name"], r["recordDatetime"]): r["total_entered"] for r in tables.read_layer(spark, streams.lake.silver).collect()}
    assert got == {("A", "2024-01-31T10:06"): 6.0, ("B", "2024-01-31T10:03"): 8.0}
    gold = {(r["roadName"], r["recordDatetime"]) for r in tables.read_layer(spark, streams.lake.gold).collect()}
    assert gold == set(got)


def test_upsert_with_order_keeps_null_keys(spark):
    layer = Layer(scratch_path(spark, "n"), ["k", "date"])
    values = [(None, "a", "2024-01-01"), (None, "b", "2024-01-01"), (1, "c", "2024-01-01"), (1, "d", "2024-01-01")]
    tables.upsert(small(spark, values), layer, order=[F.desc("v")])
    assert sorted((r["k"] or 0, r["v"]) for r in tables.read_layer(spark, layer).collect()) == [(0, "a"), (0, "b"), (1, "d")]


def test_a_write_stopped_before_its_overwrite_changes_nothing(spark, monkeypatch):
    """Stopped after its rows are staged; the retry ends in the full table."""
    layer = Layer(scratch_path(spark, "s"), ["k", "date"])
    tables.create(small(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-01")]), layer)
    before = rows(tables.read_layer(spark, layer))
    change = small(spark, [(2, "B", "2024-01-01"), (3, "c", "2024-01-02")])
    with monkeypatch.context() as stopped:
        stopped.setattr(tables, "_by_partition", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            tables.upsert(change, layer)
        with pytest.raises(RuntimeError):
            tables.replace_date(small(spark, [(9, "z", "2024-01-01")]), layer, "2024-01-01")
    assert rows(tables.read_layer(spark, layer)) == before
    tables.upsert(change, layer)
    assert [r[:2] for r in rows(tables.read_layer(spark, layer, ["k", "v"]))] == [(1, "a"), (2, "B"), (3, "c")]


def test_null_partitions_keep_their_rows(spark):
    layer = Layer(scratch_path(spark, "z"), ["k", "date"])
    tables.upsert(small(spark, [(1, "a", None), (2, "b", None), (3, "c", "2024-01-01")]), layer)
    tables.upsert(small(spark, [(2, "B", None), (4, "d", "2024-01-01")]), layer)
    got = sorted((r["k"], r["v"]) for r in tables.read_layer(spark, layer).collect())
    # A null date equals nothing, so such rows are inserted beside what is there.
    assert got == [(1, "a"), (2, "B"), (2, "b"), (3, "c"), (4, "d")]


def test_create_refuses_a_table_that_exists(spark):
    layer = Layer(scratch_path(spark, "x"), ["k", "date"])
    assert not tables.exists(spark, layer)
    tables.create(small(spark, [(1, "a", "2024-01-01")]), layer)
    assert tables.exists(spark, layer)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.create(small(spark, [(2, "b", "2024-01-02")]), layer)


def test_partitions_are_pruned_by_the_changed_hours(spark):
    """The scan takes its dates and hours from a subquery over the keys, which never visit the driver."""
    layer = Layer(scratch_path(spark, "h"), ["k", "date"])
    tables.create(small(spark, [(k, "a", f"2024-01-0{1 + k}") for k in range(8)]), layer)
    hours = written(small(spark, [(0, "a", "2024-01-03")]).select("date"), "hours")
    found = on_partitions_of(tables.read_layer(spark, layer), hours, ["date"])
    assert [r["k"] for r in found.collect()] == [2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_rebuilt_groups_lose_what_they_no_longer_hold(spark):
    layer = Layer(scratch_path(spark, "g"), ["k", "date"])
    tables.create(small(spark, [(1, "a", "2024-01-01"), (2, "a", "2024-01-01"), (3, "b", "2024-01-01"), (4, "a", "2024-01-02")]), layer)
    groups = small(spark, [(0, "a", "2024-01-01"), (0, "a", "2024-01-02")]).select("v", "date")
    tables.upsert(small(spark, [(2, "a", "2024-01-01")]), layer, groups=groups)
    assert [r[:2] for r in rows(tables.read_layer(spark, layer, ["k", "v"]))] == [(2, "a"), (3, "b")]


def test_a_group_that_was_its_whole_partition(spark):
    """Rebuilt to nothing: its partition has no rows left, and other partitions stay."""
    layer = Layer(scratch_path(spark, "e"), ["k", "date"], ("date", "v"))
    tables.create(small(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "a", "2024-01-02")]), layer)
    groups = small(spark, [(0, "a", "2024-01-01")]).select("v", "date")
    tables.upsert(small(spark, [(9, "b", "2024-01-01")]), layer, groups=groups)
    assert sorted((r["k"], r["v"]) for r in tables.read_layer(spark, layer).collect()) == [(2, "b"), (3, "a"), (9, "b")]
    tables.replace_date(small(spark, [(5, "c", "2024-01-01")]), layer, "2024-01-01")
    assert sorted((r["k"], r["v"]) for r in tables.read_layer(spark, layer).collect()) == [(3, "a"), (5, "c")]
    assert [str(r["date"]) for r in tables.layer_dates(spark, layer).collect()] == ["2024-01-01", "2024-01-02"]


def test_four_streams_together_and_one_restarted(spark, lanes, readings):
    """All four run at once; silver is stopped while files arrive, goes on at its checkpoint, and the tables end as in batch."""
    streams = make_streams(spark)
    log = layers.BatchLog()
    spark.streams.addListener(log)
    for folder in (streams.traffic_landing, streams.weather_landing):
        spark.range(0).selectExpr("cast(id as string) AS value").write.text(folder)
    queries = layers.start_all(spark, streams, {"processingTime": "0 seconds"})
    try:
        write_landing(part_of(spark, LANES[:3], LANDING_TRAFFIC), streams.traffic_landing, per_interval=False)
        write_landing(part_of(spark, READINGS[:2], LANDING_WEATHER), streams.weather_landing, per_interval=False)
        layers.carry_through(queries)
        write_landing(part_of(spark, LANES[3:], LANDING_TRAFFIC), streams.traffic_landing, per_interval=False)
        queries["silver"].stop()
        assert not queries["silver"].isActive and queries["gold"].isActive
        write_landing(part_of(spark, READINGS[2:], LANDING_WEATHER), streams.weather_landing, per_interval=False)
        queries["bronze_traffic"].processAllAvailable()
        again = layers.STARTERS["silver"][0](spark, streams, {"processingTime": "0 seconds"})
        assert again.id == queries["silver"].id and again.runId != queries["silver"].runId
        queries["silver"] = again
        layers.carry_through(queries)
        want = batch_silver(lanes, readings)
        assert rows(published(tables.read_layer(spark, streams.lake.silver))) == rows(published(want))
        assert rows(tables.read_layer(spark, streams.lake.gold, GOLD_COLUMNS)) == rows(gold_plan.build_gold(want))
        assert not log.failed
    finally:
        layers.stop_all(queries)
        spark.streams.removeListener(log)
    assert not any(q.isActive for q in queries.values())
    # A batch that a trigger looks at twice is counted twice.
    seen = [b for b in log.of(queries["bronze_traffic"]) if b.rows]
    assert len(seen) >= 2 and sum(b.rows for b in seen) >= len(LANES) and all(b.milliseconds > 0 for b in seen)


def test_late_weather_goes_to_the_side_table(spark, readings):
    """Of two batches, the second one's old readings are late; running the stream again changes nothing."""
    streams = make_streams(spark, late=LatePolicy(5))
    late = [reading("A", DAY, "09:00", 1.0), reading("A", DAY, "11:57", 2.0)]
    for part in ([reading("A", DAY, "12:00", 5.0), reading("B", DAY, "10:00", 4.0)], late):
        write_landing(part_of(spark, part, LANDING_WEATHER), streams.weather_landing, per_interval=False)
        for _ in range(2):
            layers.start_bronze_weather(spark, streams, layers.AVAILABLE_NOW).awaitTermination()
    kept = tables.read_layer(spark, streams.lake.weather, ["road_name", "temperature"])
    assert sorted(map(tuple, kept.collect())) == [("A", 2.0), ("A", 5.0), ("B", 4.0)]
    aside = spark.read.parquet(late_path(streams.lake.weather))
    assert [(r["temperature"], r["_batch"]) for r in aside.collect()] == [(1.0, 1)]


def test_changes_are_archived(spark):
    """After many triggers the folder that a trigger lists holds the last few files only."""
    streams = make_streams(spark)
    layer = streams.lake.silver
    layers._prepare(spark, layer)
    seen = []
    for k in range(12):
        keys = spark.createDataFrame([("A", date(2024, 1, 1), k)], layers.CHANGED_HOURS)
        tables.publish_changes(keys.coalesce(1), layer)
        query = layers._changes(spark, streams, layer).writeStream.foreachBatch(lambda df, _: seen.extend(r["hour"] for r in df.collect()))
        query.option("checkpointLocation", f"{streams.checkpoints}/reader").trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == list(range(12))
    assert len(spark.read.schema(layers.CHANGED_HOURS).parquet(layer.changes).inputFiles()) <= 6


def test_few_rows_in_many_folders_are_written_by_many_tasks(spark, tmp_path):
    layer = Layer(str(tmp_path / "few"), ["id"], ("date", "hour"))
    rows = spark.range(400).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 20 AS INT)) AS date", "CAST(id % 5 AS INT) AS hour")
    placed = {(r.date, r.hour, r.part) for r in tables._by_partition(rows, layer, few=True).select("date", "hour", F.spark_partition_id().alias("part")).distinct().collect()}
    assert len(placed) == 20 and len({part for *_, part in placed}) > 1
    for _ in range(2):  # the first write of the table and one that replaces rows
        tables.upsert(rows, layer, groups=rows.select("date", "hour").distinct(), pinned=True)
        assert sorted(r.id for r in tables.read_layer(spark, layer).collect()) == list(range(400))
        files = [p.parent for p in (tmp_path / "few").rglob("*.parquet")]
        assert len(files) == len(set(files)) == 20


def test_first_batch_looks_up_no_replaced_readings(spark, tmp_path, monkeypatch):
    from kerbside.catalog import base

    seen = []
    inner = layers._hours_superseded
    monkeypatch.setattr(layers, "_hours_superseded", lambda *args: seen.append(args[-1]) or inner(*args))
    streams = layers.Streams(lake=Lake(str(tmp_path / "lake")), traffic_landing=str(tmp_path / "traffic"), weather_landing=str(tmp_path / "weather"),
                             checkpoints=str(tmp_path / "checkpoints"), clock=base.fixed_clock())
    rows = base.landing_traffic(spark, "/root/testdata/sf0.001").limit(20).localCheckpoint()
    for expected in ([], [1]):
        write_landing(rows, streams.traffic_landing, per_interval=False)
        layers.start_bronze_traffic(spark, streams, layers.AVAILABLE_NOW).awaitTermination()
        assert seen == expected
