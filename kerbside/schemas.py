"""Edge schemas and published column contracts."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()

# --- fixed values: field names and orders of the landing files and published tables ---
TRAFFIC_MEASURES = [
    "laneDensity", "occupancy", "waitingTime", "speed", "sampledSeconds",
    "traveltime", "flow", "entered", "left", "timeLoss",
]
TRAFFIC_HEAD = ["id", "road_name", "date", "begin", "end"]
WEATHER_FIELDS = {
    "road_id": _S, "road_name": _S, "date": _S, "begin": _S, "end": _S,
    "temperature": _D, "windspeed": _D, "humidity": _I, "precipitation": _D,
    "weathercode": _I, "weather": _S, "ingestion_time": _S,
}
WEATHER_VALUES = ["temperature", "windspeed", "precipitation", "weather"]
SILVER_MEANS = {
    "avg_speed": "speed",
    "avg_density": "laneDensity",
    "avg_occupancy": "occupancy",
    "avg_waitingTime": "waitingTime",
    "avg_traveltime": "traveltime",
    "avg_flow": "flow",
    "avg_timeloss": "timeloss",
}
SILVER_TOTALS = {"total_entered": "entered", "total_left": "left"}
SILVER_COLUMNS = [
    "road_name", "recordDatetime",
    "avg_speed", "avg_density", "avg_occupancy", "avg_waitingTime", "avg_traveltime", "avg_flow",
    "total_entered", "total_left", "avg_timeloss",
    "temperature", "windspeed", "precipitation", "weather",
    "date",
]
GOLD_COLUMNS = [
    "roadName", "recordDatetime", "totalVehicle", "congestionHour",
    "peakFlow", "minFlow", "actualFlow", "avg_speed",
    "temperature", "windspeed", "precipitation", "weather", "date",
]
# --- end of fixed values ---

LANDING_TRAFFIC = T.StructType([T.StructField(n, _S) for n in TRAFFIC_HEAD + TRAFFIC_MEASURES])
LANDING_WEATHER = T.StructType([T.StructField(n, t) for n, t in WEATHER_FIELDS.items()])

_DATE, _TS, _L = T.DateType(), T.TimestampType(), T.LongType()


def _table(columns: list[str], kinds: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, kinds.get(n, _D)) for n in columns])


# The layers' tables as stored: published columns, then what partitions or speeds them.
BRONZE_TRAFFIC = _table(
    ["id", "road_name", "recordDatetime", *["timeloss" if m == "timeLoss" else m for m in TRAFFIC_MEASURES],
     "processDatetime", "rec_ts", "date", "hour", "_batch"],
    {"id": _S, "road_name": _S, "recordDatetime": _S, "processDatetime": _S, "rec_ts": _TS, "date": _DATE, "hour": _I, "_batch": _L})
BRONZE_WEATHER = _table(
    ["road_id", "road_name", "datetime", "temperature", "windspeed", "humidity", "precipitation", "weather", "processDatetime",
     "date", "_batch"],
    {"road_id": _S, "road_name": _S, "datetime": _S, "humidity": _I, "weather": _S, "processDatetime": _S, "date": _DATE, "_batch": _L})
SILVER = _table([*[c for c in SILVER_COLUMNS if c != "date"], "rec_ts", "date", "hour"],
                {"road_name": _S, "recordDatetime": _S, "weather": _S, "rec_ts": _TS, "date": _DATE, "hour": _I})
GOLD = _table([*[c for c in GOLD_COLUMNS if c != "date"], "date", "hour"],
              {"roadName": _S, "recordDatetime": _S, "totalVehicle": _L, "congestionHour": _I, "weather": _S, "date": _DATE, "hour": _I})

BRONZE_TRAFFIC_KEYS = ["date", "id", "recordDatetime"]
BRONZE_WEATHER_KEYS = ["date", "road_name", "datetime"]
SILVER_KEYS = ["date", "road_name", "recordDatetime"]
GOLD_KEYS = ["date", "roadName", "recordDatetime"]
HOUR_KEYS = ["road_name", "date", "hour"]

# Simulation output: one <interval> holding one <edge> per road segment; XML
# attributes surface with the reader's "_" prefix.
_EDGE = T.StructType([T.StructField("_id", _S)] + [T.StructField(f"_{m}", _S) for m in TRAFFIC_MEASURES])
INTERVAL_XML = T.StructType([
    T.StructField("_begin", _S),
    T.StructField("_end", _S),
    T.StructField("edge", T.ArrayType(_EDGE)),
])
WAY_XML = T.StructType([
    T.StructField("_id", _S),
    T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", _S)]))),
    T.StructField("tag", T.ArrayType(T.StructType([T.StructField("_k", _S), T.StructField("_v", _S)]))),
])
NODE_XML = T.StructType([T.StructField(n, _S) for n in ("_id", "_lat", "_lon")])
BOUNDS_XML = T.StructType([T.StructField(n, _S) for n in ("_minlat", "_minlon", "_maxlat", "_maxlon")])
NET_EDGE_XML = T.StructType([T.StructField("_id", _S)])
ROAD_LOOKUP = T.StructType([T.StructField(n, _S) for n in ("way_id", "name", "lat", "lon")])
WAY_LOOKUP = T.StructType([
    T.StructField("osm_id", _S), T.StructField("name", _S), T.StructField("highway", _S),
    T.StructField("lat", _D), T.StructField("lon", _D),
])

# Hourly archive response and current-weather response of the weather service.
_HOURLY = T.StructType([
    T.StructField("time", T.ArrayType(_S)),
    T.StructField("temperature_2m", T.ArrayType(_D)),
    T.StructField("precipitation", T.ArrayType(_D)),
    T.StructField("weathercode", T.ArrayType(_I)),
    T.StructField("windspeed_10m", T.ArrayType(_D)),
    T.StructField("relativehumidity_2m", T.ArrayType(_D)),
])
WEATHER_ARCHIVE = T.StructType([T.StructField("hourly", _HOURLY)])
WEATHER_CURRENT = T.StructType([
    T.StructField("current_weather", T.StructType([
        T.StructField("time", _S), T.StructField("temperature", _D),
        T.StructField("windspeed", _D), T.StructField("weathercode", _I),
    ])),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(_S)),
        T.StructField("relativehumidity_2m", T.ArrayType(_D)),
        T.StructField("precipitation", T.ArrayType(_D)),
    ])),
])
