"""Recursive density forecast for all roads at a target time."""

from __future__ import annotations

from datetime import datetime, timedelta
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import values
from kerbside.operators.filters import up_to_anchor
from kerbside.operators.windows import last_row, last_values
from kerbside.plans.ensembles import Ensemble, Linear, features_of, from_pipeline
from kerbside.plans.features import LAGS, FeatureSpec, base_rows, graph_features, unscaled
from kerbside.plans.scoring import PRIMARY_WEIGHT, SECONDARY_WEIGHT, predict
from kerbside.session import pin

# --- fixed values ---
MAX_HORIZON = timedelta(days=3)
DEFAULT_STEP_MINUTES = 5
STEP_MINUTES_RANGE = (1, 1440)
# --- end of fixed values ---

# Steps between lineage cuts, so that plans stay small; each cut writes one row per road.
STEPS_PER_PIN = 24


def status(silver: DataFrame) -> DataFrame:
    """Newest day's anchor, the latest time that may be forecast, and its row count; a layer
    without rows gives one row of nulls and 0."""
    newest = silver.agg(F.max("date").alias("d")).scalar()
    day = silver.filter(F.col("date") == newest)
    return day.agg(
        F.max("date").alias("latest_date"),
        F.max("rec_ts").alias("anchor_datetime"),
        (F.max("rec_ts") + F.expr("INTERVAL 3 DAYS")).alias("max_forecast_datetime"),
        F.count(F.lit(1)).alias("row_count"),
    )


def check_target(anchor: datetime, target: datetime, step_minutes: int = DEFAULT_STEP_MINUTES) -> tuple[int, int]:
    """(horizon minutes, steps) of an allowed forecast; errors tell why another is not."""
    low, high = STEP_MINUTES_RANGE
    if not low <= step_minutes <= high:
        raise ValueError(f"step must be between {low} and {high} minutes")
    if target <= anchor:
        raise ValueError("target must be after the latest record")
    if target > anchor + MAX_HORIZON:
        raise ValueError("target cannot be more than 3 days after the latest record")
    horizon = round((target - anchor).total_seconds() / 60)
    if horizon <= 0:
        raise ValueError("target must be at least one minute after the latest record")
    return horizon, ceil(horizon / step_minutes)


def anchor_state(base: DataFrame, spec: FeatureSpec, wanted: set[str] | None = None) -> DataFrame:
    """Per road: the last row's features, or the wanted ones of them, and its last three densities and speeds."""
    histories = last_values(base, ["road_id"], "rec_ts", ["avg_density", "avg_speed"], LAGS)
    kept = [c for c in spec.base if c not in (*spec.lag_columns, "road_id") and (wanted is None or c in wanted | {"avg_speed"})]
    newest = last_row(base.select("road_id", "rec_ts", "road_name", *kept), ["road_id"], "rec_ts").drop("rec_ts")
    zeros = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in kept}
    return newest.withColumns(zeros).join(histories, "road_id")


def _step(state: DataFrame, at: datetime, models, spec: FeatureSpec, weights, wanted: set[str]) -> DataFrame:
    """One forecast step; returns the state with the new density appended to its history.

    Each road sends its state to itself and its latest density to the roads it is a neighbour of, so one
    exchange brings together what a road needs and the state is read once.
    """
    own = F.struct(F.col("road_id").alias("to"), F.lit(0).alias("hop"))
    sent = state.select(
        F.explode(F.concat(F.array(own), "near")).alias("_to"),
        values.scaled_density(F.element_at("avg_density_last", -1)).alias("_density"),
        F.struct(*state.columns).alias("_state"),
    ).select("_to.*", "_density", F.when(F.col("_to.hop") == 0, F.col("_state")).alias("_state"))
    hops = {}
    for hop in (1, 2):
        seen = F.when(F.col("hop") == hop, F.col("_density"))
        hops[f"neighbor_density_hop{hop}"] = values.scaled_density(F.try_divide(F.sum(seen), F.count(seen)))
    met = sent.groupBy("to").agg(F.first("_state", ignorenulls=True).alias("_state"), *[c.alias(n) for n, c in hops.items()])
    lags = {
        f"{c}_lag_{k}": F.element_at(f"{c}_last", -k) for c in ("avg_density", "avg_speed") for k in range(1, LAGS + 1)
    }
    calendar = {
        "hour": at.hour, "minute": at.minute, "day_of_week": at.weekday(), "is_weekend": int(at.weekday() >= 5),
    }
    # Densities sent to roads without a history meet no state.
    rows = met.filter("_state IS NOT NULL").select("_state", "_state.*", *hops)
    rows = rows.withColumns({**lags, **{c: F.lit(float(v)) for c, v in calendar.items()}})
    rows = graph_features(rows, spec)
    inputs = [values.model_input(F.col(c).cast("double")).alias(c) for c in spec.features if c in wanted and c != "road_id"]
    rows = rows.select("_state", F.col("road_id").cast("double").alias("road_id"), *inputs)
    scored = predict(rows, models, weights).select("_state.*", values.scaled_density(F.col("pred_scaled")).alias("pred_scaled"))
    return scored.withColumns({
        "avg_density_last": F.concat(F.slice("avg_density_last", 2, LAGS - 1), F.array("pred_scaled")),
        # The speed is not forecast: its last known value moves through the lags.
        "avg_speed_last": F.concat(F.slice("avg_speed_last", 2, LAGS - 1), F.array("avg_speed")),
    }).drop("pred_scaled")


def forecast(
    silver: DataFrame,
    roads: DataFrame,
    edges: DataFrame,
    scaler: DataFrame,
    models,
    spec: FeatureSpec,
    target: datetime,
    anchor: datetime,
    step_minutes: int = DEFAULT_STEP_MINUTES,
    weights: tuple[float, float] = (PRIMARY_WEIGHT, SECONDARY_WEIGHT),
) -> DataFrame:
    """Density of every road at ``target``, from its history up to ``anchor``.

    One query over the features that the models read: each step adds an exchange of one row per road and neighbour to the plan, and only
    long horizons cut it. Errors of one step feed the next, so one step (``step_minutes`` = horizon) is the
    steadier choice.
    """
    horizon, steps = check_target(anchor, target, step_minutes)
    base = up_to_anchor(base_rows(silver, roads, scaler, spec), F.lit(anchor.isoformat()).cast("timestamp"))
    near = edges.groupBy(F.col("dst").alias("road_id")).agg(
        F.collect_list(F.struct(F.col("src").alias("to"), "hop")).alias("near"))
    none = F.array().cast("array<struct<to: int, hop: int>>")
    models = [m if isinstance(m, (Ensemble, Linear)) else from_pipeline(m) for m in models]
    wanted = set().union(*map(features_of, models))
    state = anchor_state(base, spec, wanted).join(near, "road_id", "left").withColumn("near", F.coalesce("near", none))
    for step in range(1, steps + 1):
        at = target if step == steps else anchor + timedelta(minutes=step * step_minutes)
        state = _step(state, at, models, spec, weights, wanted)
        if step % STEPS_PER_PIN == 0 and step < steps:
            state = pin(state)
    state = state.withColumn("pred_scaled", F.element_at("avg_density_last", -1))
    return state.select(
        "road_name",
        F.lit(anchor.isoformat(timespec="minutes")).alias("anchor_datetime"),
        F.lit(target.isoformat(timespec="minutes")).alias("recordDatetime"),
        F.lit(horizon).alias("horizon_minutes"),
        F.col("pred_scaled").alias("pred_avg_density_scaled"),
        unscaled(F.col("pred_scaled"), scaler, spec.target).alias("pred_avg_density"),
    )
