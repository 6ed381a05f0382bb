"""Numbers, defaults, flags and candidate-column resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: accepted column names, first usable one wins; thresholds and clips ---
ROAD_CANDIDATES = ["road_name", "roadName"]
ROAD_DISPLAY_CANDIDATES = ["roadName", "road_name"]
TIME_CANDIDATES = ["recordDatetime", "record_dateTime"]
FLOW_CANDIDATES = ["actualFlow", "actual_flow", "ActualFlow", "flow", "avg_flow"]
SPEED_CANDIDATES = ["speed", "avg_speed", "avgSpeed", "speed_kmh", "velocity", "avg_velocity"]
TEMPERATURE_CANDIDATES = ["temperature", "temp", "air_temp", "airTemperature"]
PRECIPITATION_CANDIDATES = ["precipitation", "precip", "rain_mm", "precip_mm", "rain"]
WIND_CANDIDATES = ["wind_speed", "windSpeed", "windspeed", "wind", "wind_kmh", "windSpeedKmh"]
WEATHER_CANDIDATES = ["weather", "condition", "weather_label", "weatherLabel"]
DENSITY_CANDIDATES = ["avg_density", "avgDensity", "average_density", "density"]
SEGMENT_CANDIDATES = [
    "edge_id", "edgeId", "sumo_edge_id", "sumoEdgeId", "road_id", "roadId",
    "link_id", "linkId", "way_id", "wayId", "segment_id",
]
SEGMENT_NAME_CANDIDATES = ["road_name", "roadName", "name", "street_name", "streetName"]
SEGMENT_TIME_CANDIDATES = [
    "recordDatetime", "record_datetime", "datetime", "timestamp", "time",
    "interval_start", "window_start",
]
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
CONGESTION_KMH = 20.0
KMH_PER_MS = 3.6
MODEL_INPUT_CLIP = (-1000.0, 1000.0)
SCALED_DENSITY_CLIP = (-1.0, 2.0)
# --- end of fixed values ---


def _finite(value: Column) -> Column:
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(~F.isnan(value) & ~infinite, value)


def number_from_text(text: Column) -> Column:
    """Finite double of a text, else null; blank, 'NaN' and 'Infinity' give null."""
    bare = trimmed(text)
    return F.when(bare.rlike(NUMBER_PATTERN), _finite(bare.try_cast("double")))


def number_of(df: DataFrame, name: str) -> Column:
    """Finite double of a column of any scalar type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return number_from_text(F.col(name))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _finite(F.col(name).cast("double"))
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    return F.lit(None).cast("double")


def trimmed(text: Column) -> Column:
    """Text without white space of any kind at its ends: tabs, line ends and wide spaces too.

    Text that begins and ends with a visible ASCII character is taken as it is, without the pattern.
    """
    def visible(character: Column) -> Column:
        return F.ascii(character).between(33, 126)

    bare = F.regexp_replace(text, r"^[\s\u0085\p{Z}]+|[\s\u0085\p{Z}]+$", "")
    return F.when(visible(text) & visible(F.right(text, F.lit(1))), text).otherwise(bare)


def text_of(df: DataFrame, name: str) -> Column:
    """Trimmed text of a column, blank as null."""
    return F.nullif(trimmed(F.col(name).cast("string")), F.lit(""))


def present(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    columns = set(df.columns)
    return [name for name in candidates if name in columns]


def first_number(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First usable number among the candidate columns the frame has."""
    found = [number_of(df, name) for name in present(df, candidates)]
    return F.coalesce(*found) if found else F.lit(None).cast("double")


def number_of_first(df: DataFrame, candidates: Sequence[str]) -> Column:
    """Number of the first candidate column that is not blank; null if that is no number."""
    def given(name: str) -> Column:
        # The text of a number is never blank, so it need not be written out.
        return (F.col(name) if isinstance(df.schema[name].dataType, T.NumericType) else text_of(df, name)).isNotNull()

    found = [F.when(given(n), F.struct(number_of(df, n).alias("n"))) for n in present(df, candidates)]
    return F.coalesce(*found)["n"] if found else F.lit(None).cast("double")


def first_text(df: DataFrame, candidates: Sequence[str]) -> Column:
    found = [text_of(df, name) for name in present(df, candidates)]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def first_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    found = present(df, candidates)
    return found[0] if found else None


def congestion_flag(speed_ms: Column, limit_kmh: float = CONGESTION_KMH) -> Column:
    """1 below the limit, else 0; an unknown speed is not congested."""
    return F.when(speed_ms < limit_kmh / KMH_PER_MS, 1).otherwise(0)


def speed_kmh(speed_ms: Column) -> Column:
    return speed_ms * KMH_PER_MS


def whole_vehicles(total: Column) -> Column:
    """Truncated to a long; a value no long can hold gives null."""
    return total.try_cast("bigint")


def mean_or_zero(value: Column, digits: int = 2) -> Column:
    return F.coalesce(F.round(F.avg(value), digits), F.lit(0.0))


def rain_or_zero(precipitation: Column) -> Column:
    return F.coalesce(precipitation, F.lit(0.0))


def weather_or_unknown(label: Column) -> Column:
    return F.coalesce(label, F.lit("Unknown"))


def clip(value: Column, low: float, high: float) -> Column:
    """``value`` moved into low..high; null stays null, which least and greatest alone skip."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def zero_if_not_finite(value: Column) -> Column:
    return F.coalesce(_finite(value), F.lit(0.0))


def model_input(value: Column) -> Column:
    return clip(zero_if_not_finite(value), *MODEL_INPUT_CLIP)


def scaled_density(value: Column) -> Column:
    """Forecast output held to the scaled range: NaN and null are 0, infinities the ends."""
    low, high = SCALED_DENSITY_CLIP
    return clip(F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0)), low, high)


def scored_density(value: Column) -> Column:
    """Batch scores held to the scaled range: as ``scaled_density``, but infinities are 1 and 0."""
    infinite = F.abs(value) == float("inf")
    return scaled_density(F.when(infinite, F.when(value > 0, 1.0).otherwise(0.0)).otherwise(value))
