"""Edge cases of the column functions, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from kerbside.functions import labels, roads, times, values


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def text(value):
    return F.lit(value).cast("string")


def integer(value):
    return F.lit(value).cast("int")


def double(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize("day, clock, expected", [
    ("2024-01-31", "24:00", "2024-02-01T00:00"),
    ("2024-01-31", "00:03", "2024-01-31T00:03"),
    ("2024-01-31", "25:10", None),
    ("someday", "10:00", None),
    ("someday", "24:00", None),
    (None, "10:00", None),
    ("2024-01-31", None, None),
])
def test_interval_time(spark, day, clock, expected):
    assert one(spark, times.minute_text(times.interval_time(text(day), text(clock)))) == expected


def test_closing_interval_has_its_own_hour(spark):
    ts = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert one(spark, times.hour_of_day(ts, F.lit("2024-01-31").cast("date"))) == 24
    assert one(spark, times.hour_of_day(ts, F.lit("2024-02-01").cast("date"))) == 0


@pytest.mark.parametrize("function, value, expected", [
    (times.minutes_to_clock, 1440, "24:00"), (times.minutes_to_clock, -5, "00:00"), (times.minutes_to_clock, None, None),
    (times.snap_to_five, 1439, 1435), (times.snap_to_five, None, None), (times.snap_to_five, 2, 0),
    (times.minute_from_number, 2000, 1439), (times.minute_from_number, None, None),
    (times.nearest_step, 4, 3), (times.nearest_step, 5, 6),
    (times.bucket_to_clock, 479, "23:57"),
])
def test_minutes(spark, function, value, expected):
    assert one(spark, function(integer(value))) == expected


@pytest.mark.parametrize("value, expected", [
    ("T10:05", 605), ("2024-01-01 23:59:59", 1439), ("7:05", 425), ("2024-01-01", 0), ("noon", None), ("", None), (None, None),
])
def test_minute_from_text(spark, value, expected):
    assert one(spark, times.minute_from_text(text(value))) == expected


def test_hour_wins_over_time(spark):
    ts = F.lit("2024-01-01 10:14:00").cast("timestamp")
    assert one(spark, times.bucket_of(ts)) == 204
    assert one(spark, times.bucket_of(ts, double(7.9))) == 140
    assert one(spark, times.bucket_of(ts, double(99))) == 460
    assert one(spark, times.bucket_of(ts, double(None))) == 204
    assert one(spark, times.bucket_of(ts, double(float("nan")))) == 204


def test_floor_in_local_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        ts = F.lit("2024-01-01 10:14:59").cast("timestamp")
        assert one(spark, times.minute_text(times.floor_minutes(ts))) == "2024-01-01T10:12"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_schedule_ends_with_the_day(spark):
    assert one(spark, times.day_schedule(integer(1434))) == [1434, 1437, 1440]
    assert one(spark, times.day_schedule(integer(1443))) == []
    assert one(spark, times.next_interval_end(integer(1439))) == 1440


@pytest.mark.parametrize("value, highway, expected", [
    (1.5, "trunk", "busy"), (1.49, "trunk", "free"), (5.0, "trunk", "jammed"), (4.0, "unknown", "busy"),
    (3.99, None, "free"), (None, "trunk", "no data"), (float("nan"), "trunk", "no data"), (11.9, None, "heavy"),
])
def test_density_class(spark, value, highway, expected):
    assert one(spark, labels.density_class(double(value), text(highway))) == expected


@pytest.mark.parametrize("value, expected", [(99, "Thunderstorm w/ heavy hail"), (4, "Unknown"), (None, "Unknown")])
def test_weather_label(spark, value, expected):
    assert one(spark, labels.weather_label(integer(value))) == expected


@pytest.mark.parametrize("value, expected", [
    ("Thunderstorm with rain", "storm"), ("partly cloudy", "cloud"), ("few drops", "partly"), ("sandstorm", "storm"), (None, "other"),
])
def test_weather_category(spark, value, expected):
    assert one(spark, labels.weather_category(text(value))) == expected


@pytest.mark.parametrize("value, expected", [
    ("12A/3b Đường Nguyễn Văn Huyên", "nguyen van huyen"), ("Ngõ 5  Láng", "5 lang"), ("Đường", "duong"),
    ("  7 Phố  Huế ", "hue"), (None, ""), ("Ấn", "an"),
])
def test_normal_road_name(spark, value, expected):
    assert one(spark, roads.normal_road_name(text(value))) == expected


@pytest.mark.parametrize("value, way, keys", [
    ("-123#4", "123", ["-123#4", "123#4", "123"]), ("123", "123", ["123"]), (":x_0", None, [":x_0"]),
    ("--5#1", "5", ["--5#1", "-5#1", "-5"]), ("#1", None, ["#1"]), ("-A b#2", "A b", ["-A b#2", "A b#2", "A b", "-a b#2"]), (None, None, []),
])
def test_edge_ids(spark, value, way, keys):
    assert one(spark, roads.way_of_edge(text(value))) == way
    assert one(spark, roads.edge_keys(text(value))) == keys


def test_congestion_is_strictly_below(spark):
    assert one(spark, values.congestion_flag(double(20 / 3.6))) == 0
    assert one(spark, values.congestion_flag(double(5.55))) == 1
    assert one(spark, values.congestion_flag(double(None))) == 0


def test_clips_keep_null(spark):
    assert one(spark, values.clip(double(None), -1.0, 2.0)) is None
    assert one(spark, values.scaled_density(double(float("inf")))) == 2.0
    assert one(spark, values.scaled_density(double(float("-inf")))) == -1.0
    assert one(spark, values.model_input(double(float("-inf")))) == 0.0
    assert one(spark, values.model_input(double(-5000))) == -1000.0


def test_candidate_columns(spark):
    df = spark.createDataFrame([(None, "x", 3.0), ("4", None, 5.0)], "actualFlow string, flow string, avg_flow double")
    got = [r[0] for r in df.select(values.first_number(df, values.FLOW_CANDIDATES)).collect()]
    assert got == [3.0, 4.0]
    assert df.select(values.first_number(df, values.WIND_CANDIDATES)).first()[0] is None


@pytest.mark.parametrize("path, expected", [
    ("sim/test_01-05-2026_output.xml", "2026-05-01"), ("sim/test_output.xml", None), ("test_99-99-2026.xml", None),
])
def test_file_date(spark, path, expected):
    got = one(spark, times.date_from_file_name(text(path)))
    assert (got and got.isoformat()) == expected


def test_offset_is_dropped(spark):
    assert one(spark, times.parse_local(text("2024-01-01T10:00:00+05:30")).cast("string")) == "2024-01-01 10:00:00"


def test_plain_names_and_dated_clocks_skip_the_patterns_with_the_same_result(spark):
    names = ["Street 5", "STREET  5", "street 5\n", " street 5", "pho", "Pho Hue", "phong ba", "ngo 12 hue", "12 pho hue", "K\u212aelvin way",
             "a-b.c's_d", "ngach\thue", "duong", "hem x", "Phố Huế", "", "5", "x\u00a0y"]
    normal = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(roads.normal_road_name(F.col("n"))).collect()]
    assert normal == ["street 5", "street 5", "street 5", "street 5", "pho", "hue", "phong ba", "12 hue", "hue", "kkelvin way",
                      "a-b.c's_d", "hue", "duong", "x", "hue", "", "5", "x\u00a0y"]
    clocks = ["2024-01-01T14:05", " 2024-01-01T99:07:30Z", "2024-01-01T1:05", "2024-01-01 14:05", "14:05", "24-01-01T14:05", "2024-01-01T14:0", "x", None]
    df = spark.createDataFrame([(c,) for c in clocks], "c string")
    assert [r[0] for r in df.select(times.minute_from_text(F.col("c"))).collect()] == [845, 5947, 65, 845, 845, 845, 840, None, None]
    assert "RLIKE" in df.select(roads.name_keys(F.col("c")))._jdf.queryExecution().optimizedPlan().toString()
