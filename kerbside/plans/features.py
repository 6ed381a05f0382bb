"""Model features of silver rows.

The model's artifacts (road classes, scaler, road graph, weather vocabulary, source columns)
are arguments: small tables that are fitted once, stored, and joined here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import times, values
from kerbside.operators.joins import neighbour_mean_of_rows, with_neighbour_means
from kerbside.operators.paging import with_row_number
from kerbside.operators.windows import lag_in_chunks
from kerbside.session import pin

# --- fixed values: input columns, derived feature names and their small constant ---
MODEL_MEASURES = [
    "avg_speed", "avg_density", "avg_occupancy", "avg_waitingTime", "avg_traveltime", "avg_flow",
    "total_entered", "total_left", "avg_timeloss", "temperature", "windspeed", "precipitation",
]
MODEL_INPUT = ["road_name", "recordDatetime", "weather", *MODEL_MEASURES]
CALENDAR = ["hour", "minute", "day_of_week", "is_weekend"]
GRAPH_FEATURES = [
    "neighbor_density_hop1", "neighbor_density_hop2", "spatial_speed_diff", "spatial_density_ratio",
    "traffic_pressure_index", "density_acceleration", "speed_anomaly_index", "spatial_density_share",
    "traffic_resistance", "node_centrality", "st_momentum",
]
EPSILON = 1e-5
LAGS = 3
# --- end of fixed values ---


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns a model is built from.

    ``density``, ``speed`` and ``density_before`` are the columns the derived features compare
    with the neighbourhood. The defaults use lags, so that a same-time model does not see the
    value it predicts.
    """

    weather_labels: Sequence[str]
    measures: Sequence[str] = field(default=tuple(MODEL_MEASURES))
    target: str = "avg_density"
    density: str = "avg_density_lag_1"
    speed: str = "avg_speed_lag_1"
    density_before: str = "avg_density_lag_2"

    @property
    def lag_columns(self) -> list[str]:
        return [f"{c}_lag_{k}" for k in range(1, LAGS + 1) for c in ("avg_density", "avg_speed")]

    @property
    def weather_columns(self) -> list[str]:
        return [weather_column(label) for label in self.weather_labels]

    @property
    def base(self) -> list[str]:
        measures = [m for m in self.measures if m != self.target]
        return [*measures, *CALENDAR, "road_id", *self.weather_columns, *self.lag_columns]

    @property
    def features(self) -> list[str]:
        return [*self.base, *GRAPH_FEATURES]


def weather_column(label: str) -> str:
    return f"weather_{label}"


def canonical_input(df: DataFrame) -> DataFrame:
    """The 15 model input columns under their own names; an error names missing ones."""
    renames = {"roadName": "road_name", "record_dateTime": "recordDatetime"}
    for old, new in renames.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    missing = [c for c in MODEL_INPUT if c not in df.columns]
    if missing:
        raise ValueError("missing input columns: " + ", ".join(missing))
    return df.select(*MODEL_INPUT)


def fit_roads(df: DataFrame) -> DataFrame:
    """Road classes: names in order, numbered from 0."""
    names = df.select("road_name").filter("road_name IS NOT NULL").distinct()
    numbered = with_row_number(names, [F.col("road_name").asc()], "road_id")
    return pin(numbered.withColumn("road_id", (F.col("road_id") - 1).cast("int")))


def fit_scaler(df: DataFrame, measures: Sequence[str] = tuple(MODEL_MEASURES)) -> DataFrame:
    """One row: a struct of minimum and range per measure; a constant measure has range 1."""
    columns = []
    for name in measures:
        low, high = F.min(name), F.max(name)
        span = F.coalesce(F.nullif(high - low, F.lit(0.0)), F.lit(1.0))
        columns.append(F.struct(low.alias("low"), span.alias("span")).alias(name))
    return df.agg(*columns).select(F.struct(*measures).alias("scale"))


def scaled(df: DataFrame, scaler: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Measures on the scaler's 0..1 range; the one stats row enters as a scalar subquery."""
    scale = scaler.scalar()
    return df.withColumns({
        m: (F.col(m).cast("double") - scale.getField(m).getField("low")) / scale.getField(m).getField("span")
        for m in measures
    })


def unscaled(value: Column, scaler: DataFrame, measure: str) -> Column:
    scale = scaler.scalar().getField(measure)
    return value * scale.getField("span") + scale.getField("low")


def one_hot_weather(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """0/1 column per known label, so the schema does not depend on the rows."""
    hits = {weather_column(x): F.coalesce((F.col("weather") == x).cast("int"), F.lit(0)) for x in labels}
    return df.withColumns(hits)


def base_rows(df: DataFrame, roads: DataFrame, scaler: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Known roads' rows with calendar, road class, weather columns and scaled measures.

    Scaling comes before lags and neighbour means, which are therefore scaled too.
    """
    rows = canonical_input(df).join(roads, "road_name")
    # A time that can't be read fails the job: its features would be made up.
    unread = F.raise_error(F.concat(F.lit("unreadable recordDatetime: "), F.coalesce("recordDatetime", F.lit("null"))))
    parsed = times.parse_minute_text(F.col("recordDatetime"))
    rows = rows.withColumn("rec_ts", F.coalesce(parsed, unread.cast("timestamp")))
    rows = rows.withColumns(times.calendar_features(F.col("rec_ts")))
    return scaled(one_hot_weather(rows, spec.weather_labels), scaler, spec.measures)


def graph_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The nine figures derived from own values and the hop means.

    ``spatial_speed_diff`` takes the neighbours' density from the speed; both are scaled.
    """
    density, speed, before = F.col(spec.density), F.col(spec.speed), F.col(spec.density_before)
    hop1, hop2 = F.col("neighbor_density_hop1"), F.col("neighbor_density_hop2")
    df = df.withColumns({
        "spatial_speed_diff": speed - hop1,
        "spatial_density_ratio": F.try_divide(density, hop1 + EPSILON),
        "traffic_pressure_index": hop1 * hop2,
        "density_acceleration": density - before,
        "speed_anomaly_index": F.abs(speed - hop1),
        "spatial_density_share": F.try_divide(density, hop1 + density + EPSILON),
        "traffic_resistance": speed * (hop1 + EPSILON),
        "node_centrality": hop1 + hop2 * 0.5,
    })
    return df.withColumn("st_momentum", F.col("density_acceleration") * F.col("traffic_pressure_index"))


def build_features(
    df: DataFrame, roads: DataFrame, edges: DataFrame, scaler: DataFrame, spec: FeatureSpec, mean_of: str | None = None
) -> DataFrame:
    """Features of every known-road row: ``spec.features`` plus road_name, recordDatetime and
    the target, all finite. ``mean_of`` is the density the neighbour means average."""
    rows = base_rows(df, roads, scaler, spec)
    # The rows feed the lags' windows and the neighbours' means: written once, read twice.
    lagged = pin(lag_in_chunks(rows, ["road_id"], "rec_ts", ["avg_density", "avg_speed"], LAGS))
    means = neighbour_mean_of_rows(lagged, edges, "road_id", mean_of or spec.density)
    derived = graph_features(with_neighbour_means(lagged, means, "road_id"), spec)
    numeric = [F.col(c).cast("double").alias(c) for c in (*spec.features, spec.target)]
    typed = derived.select("road_name", "recordDatetime", *numeric)
    return typed.withColumns({c: values.zero_if_not_finite(F.col(c)) for c in (*spec.features, spec.target)})
