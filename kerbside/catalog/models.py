"""Features, scoring and forecast over silver rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from kerbside.catalog import base
from kerbside.catalog.base import flat, register, with_sql
from kerbside.plans import features as feat
from kerbside.plans import forecast as fc
from kerbside.plans import scoring
from kerbside.plans.ensembles import Linear, from_leafwise_dump
from kerbside.plans.features import FeatureSpec
from kerbside.session import pin

SPEC = FeatureSpec(weather_labels=[label for _, label in base.EVENT_WEATHER.values()])


def _fitted(spark, sf_dir):
    """Silver rows, pinned once for the several jobs that read them, and the fitted tables."""
    silver = pin(base.silver(spark, sf_dir))
    roads = feat.fit_roads(silver)
    edges = base.road_edges(spark, sf_dir, roads)
    return silver, roads, edges, pin(feat.fit_scaler(silver))


_IDS = """,
ids AS (SELECT road_name, CAST(row_number() OVER (ORDER BY road_name) - 1 AS INTEGER) AS road_id
        FROM (SELECT DISTINCT road_name FROM silver))"""
_SCALED = """,
ms AS (SELECT min(avg_density) AS d0, max(avg_density) - min(avg_density) AS d1, min(avg_speed) AS s0, max(avg_speed) - min(avg_speed) AS s1,
              min(temperature) AS t0, max(temperature) - min(temperature) AS t1 FROM silver)"""


@register("m02_weather_columns", with_sql(base.silver_sql(), "SELECT road_name, recordDatetime, " + ", ".join(
    f"CAST(coalesce(weather = '{label}', false) AS INTEGER) AS \"weather_{label}\"" for label in SPEC.weather_labels
) + " FROM silver"))
def weather_columns(spark, sf_dir):
    rows = feat.one_hot_weather(base.silver(spark, sf_dir), SPEC.weather_labels)
    return rows.select("road_name", "recordDatetime", *SPEC.weather_columns)


@register("m03_scaled_measures", with_sql(base.silver_sql() + _SCALED, """
SELECT road_name, recordDatetime, (avg_density - d0) / d1 AS avg_density, (avg_speed - s0) / s1 AS avg_speed,
       (avg_density - d0) / d1 * d1 + d0 AS restored FROM silver, ms"""))
def scaled(spark, sf_dir):
    rows = base.silver(spark, sf_dir)
    scaler = feat.fit_scaler(rows, ["avg_density", "avg_speed"])
    out = feat.scaled(rows, scaler, ["avg_density", "avg_speed"])
    return out.select(
        "road_name", "recordDatetime", "avg_density", "avg_speed",
        feat.unscaled(F.col("avg_density"), scaler, "avg_density").alias("restored"),
    )


@register("m05_base_rows", with_sql(base.silver_sql() + _IDS + _SCALED, """
SELECT road_name, recordDatetime, road_id, (avg_density - d0) / d1 AS avg_density, (temperature - t0) / t1 AS temperature,
       CAST(hour(rec_ts) AS INTEGER) AS hour, CAST(isodow(rec_ts) - 1 AS INTEGER) AS day_of_week,
       CAST(coalesce(weather = 'Overcast', false) AS INTEGER) AS "weather_Overcast"
FROM silver JOIN ids USING (road_name), ms"""))
def base_rows(spark, sf_dir):
    silver, roads, _, scaler = _fitted(spark, sf_dir)
    rows = feat.base_rows(silver, roads, scaler, SPEC)
    return rows.select("road_name", "recordDatetime", "road_id", "avg_density", "temperature", "hour", "day_of_week", "weather_Overcast")


@register("m04_graph_features", with_sql(base.EV, """
, g AS (SELECT event_id, CAST(k AS DOUBLE) AS d, CAST(user_id AS DOUBLE) AS b, floor(value) AS s, CAST(k % 7 AS DOUBLE) AS h1, CAST(k % 11 AS DOUBLE) AS h2 FROM ev)
SELECT event_id, s - h1 AS spatial_speed_diff, d / (h1 + 1e-5) AS spatial_density_ratio, h1 * h2 AS traffic_pressure_index,
       d - b AS density_acceleration, abs(s - h1) AS speed_anomaly_index, d / (h1 + d + 1e-5) AS spatial_density_share,
       s * (h1 + 1e-5) AS traffic_resistance, h1 + h2 * 0.5 AS node_centrality, (d - b) * (h1 * h2) AS st_momentum
FROM g""".replace("1e-5", "CAST(0.00001 AS DOUBLE)").replace("h2 * 0.5", "h2 * CAST(0.5 AS DOUBLE)")))
def graph_features(spark, sf_dir):
    rows = base.events(spark, sf_dir).select(
        "event_id",
        F.col("k").cast("double").alias(SPEC.density),
        F.col("user_id").cast("double").alias(SPEC.density_before),
        F.floor("value").cast("double").alias(SPEC.speed),
        (F.col("k") % 7).cast("double").alias("neighbor_density_hop1"),
        (F.col("k") % 11).cast("double").alias("neighbor_density_hop2"),
    )
    return feat.graph_features(rows, SPEC).select("event_id", *feat.GRAPH_FEATURES[2:])


@register("m06_blend", with_sql(base.EV, """
SELECT event_id, value * CAST(0.88 AS DOUBLE) + CAST(k AS DOUBLE) * CAST(0.12 AS DOUBLE) AS blended FROM ev"""))
def blended(spark, sf_dir):
    mixed = scoring.blend(F.col("value"), F.col("k").cast("double"))
    return base.events(spark, sf_dir).select("event_id", mixed.alias("blended"))


@register("m08_anchor_state", with_sql(base.silver_sql() + _IDS + _SCALED, """
, r AS (SELECT i.road_id, s.road_name, (avg_density - d0) / d1 AS d, (avg_speed - s0) / s1 AS v,
               row_number() OVER (PARTITION BY s.road_name ORDER BY rec_ts DESC) AS back FROM silver s JOIN ids i USING (road_name), ms)
SELECT road_id, road_name, max(d) FILTER (back = 1) AS density_1, max(d) FILTER (back = 2) AS density_2, max(d) FILTER (back = 3) AS density_3,
       max(v) FILTER (back = 1) AS speed_1 FROM r GROUP BY ALL"""))
def anchor_state(spark, sf_dir):
    silver, roads, _, scaler = _fitted(spark, sf_dir)
    state = fc.anchor_state(feat.base_rows(silver, roads, scaler, SPEC), SPEC)
    return state.select(
        "road_id", "road_name", *[F.col("avg_density_last")[3 - k].alias(f"density_{k}") for k in (1, 2, 3)],
        F.col("avg_speed_last")[2].alias("speed_1"),
    )


@register("m10_forecast_status", with_sql(base.silver_sql(), """
SELECT CAST(max(date) AS VARCHAR) AS latest_date, strftime(max(rec_ts), '%Y-%m-%d %H:%M:%S') AS anchor_datetime,
       strftime(max(rec_ts) + INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S') AS max_forecast_datetime, count(*) AS row_count
FROM silver WHERE date = (SELECT max(date) FROM silver)"""))
def status(spark, sf_dir):
    return flat(fc.status(base.silver(spark, sf_dir)))


# --- fixed values: given models, as their dumps state them ---
GIVEN_TREES = """{"feature_names": ["avg_density_lag_1", "neighbor_density_hop1", "density_acceleration", "avg_speed_lag_1", "minute"], "tree_info": [
 {"tree_structure": {"split_feature": 0, "threshold": 0.4371, "decision_type": "<=",
   "left_child": {"split_feature": 1, "threshold": 0.5013, "decision_type": "<=", "left_child": {"leaf_value": 0.21}, "right_child": {"leaf_value": 0.29}},
   "right_child": {"leaf_value": 0.47}}},
 {"tree_structure": {"split_feature": 2, "threshold": -0.0317, "decision_type": "<=", "left_child": {"leaf_value": 0.06},
   "right_child": {"split_feature": 3, "threshold": 0.4871, "decision_type": "<=", "left_child": {"leaf_value": 0.11}, "right_child": {"leaf_value": 0.02}}}},
 {"tree_structure": {"split_feature": 4, "threshold": 29.5, "decision_type": "<=", "left_child": {"leaf_value": 0.015}, "right_child": {"leaf_value": -0.015}}}]}"""
GIVEN_LINEAR = {"avg_density_lag_1": 0.5, "avg_density_lag_2": 0.25, "neighbor_density_hop1": 0.125, "neighbor_density_hop2": 0.0625,
                "spatial_density_share": 0.03125, "avg_speed": -0.0625}
GIVEN_OFFSET = 0.0625
# --- end of fixed values ---


def _given():
    return from_leafwise_dump(GIVEN_TREES), Linear(GIVEN_LINEAR, GIVEN_OFFSET)


def _blend_sql(d1: str, d2: str, change: str, h1: str, h2: str, v1: str, v: str, minute: str) -> str:
    return f"""0.88 * (CASE WHEN {d1} <= 0.4371 THEN CASE WHEN {h1} <= 0.5013 THEN 0.21 ELSE 0.29 END ELSE 0.47 END
      + CASE WHEN {change} <= -0.0317 THEN 0.06 WHEN {v1} <= 0.4871 THEN 0.11 ELSE 0.02 END
      + CASE WHEN {minute} <= 29.5 THEN 0.015 ELSE -0.015 END)
    + 0.12 * (0.0625 + {d1} * 0.5 + {d2} * 0.25 + {h1} * 0.125 + {h2} * 0.0625 + {d1} / ({h1} + {d1} + 0.00001) * 0.03125 - {v} * 0.0625)"""


def _rounded(df):
    """Doubles to six digits: sums of neighbours come in any order."""
    return df.withColumns({n: F.round(n, 6) for n, kind in df.dtypes if kind == "double"})


# Feature frame: scaled measures, lags in time, means over all rows of the neighbours, derived figures.
_EDGES = """,
edges AS (SELECT i.road_id AS src, (i.road_id + h) % (SELECT count(*) FROM ids) AS dst, h AS hop FROM ids i, range(1, 3) t(h))"""
_MEASURES = [m for m in feat.MODEL_MEASURES if m != "avg_density"]
_FEATURES = base.silver_sql() + _IDS + _EDGES + """,
spans AS (SELECT """ + ", ".join(
    f"min({m}) AS {m}_low, coalesce(nullif(max({m}) - min({m}), 0), 1) AS {m}_span" for m in feat.MODEL_MEASURES) + """ FROM silver),
scaled AS (SELECT s.road_name, s.recordDatetime, s.rec_ts, s.weather, i.road_id, """ + ", ".join(
    f"(s.{m} - {m}_low) / {m}_span AS {m}" for m in feat.MODEL_MEASURES) + """ FROM silver s JOIN ids i USING (road_name), spans),
lagged AS (SELECT *, """ + ", ".join(
    f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in ("avg_density", "avg_speed") for k in (1, 2, 3)
) + """ FROM scaled WINDOW w AS (PARTITION BY road_id ORDER BY rec_ts)),
hops AS (SELECT src AS road_id, coalesce(sum(s) FILTER (hop = 1) / nullif(sum(n) FILTER (hop = 1), 0), 0) AS h1,
                coalesce(sum(s) FILTER (hop = 2) / nullif(sum(n) FILTER (hop = 2), 0), 0) AS h2
         FROM edges JOIN (SELECT road_id AS dst, sum(avg_density_lag_1) AS s, count(avg_density_lag_1) AS n FROM lagged GROUP BY ALL) USING (dst)
         GROUP BY ALL),
raw AS (SELECT l.*, coalesce(h1, 0) AS h1, coalesce(h2, 0) AS h2, avg_density_lag_1 AS d, avg_density_lag_2 AS b, avg_speed_lag_1 AS v
        FROM lagged l LEFT JOIN hops USING (road_id))"""


def _number(sql: str, name: str) -> str:
    return f"round(coalesce({sql}, CAST(0 AS DOUBLE)), 6) AS \"{name}\""


_FEATURE_COLUMNS = ", ".join([
    *[_number(m, m) for m in _MEASURES],
    _number("CAST(hour(rec_ts) AS DOUBLE)", "hour"), _number("CAST(minute(rec_ts) AS DOUBLE)", "minute"),
    _number("CAST(isodow(rec_ts) - 1 AS DOUBLE)", "day_of_week"), _number("CAST(CASE WHEN isodow(rec_ts) >= 6 THEN 1 ELSE 0 END AS DOUBLE)", "is_weekend"),
    _number("CAST(road_id AS DOUBLE)", "road_id"),
    *[_number(f"CAST(CASE WHEN weather = '{label}' THEN 1 ELSE 0 END AS DOUBLE)", f"weather_{label}") for label in SPEC.weather_labels],
    *[_number(f"{c}_lag_{k}", f"{c}_lag_{k}") for c in ("avg_density", "avg_speed") for k in (1, 2, 3)],
    _number("h1", "neighbor_density_hop1"), _number("h2", "neighbor_density_hop2"), _number("v - h1", "spatial_speed_diff"),
    _number("d / (h1 + 0.00001)", "spatial_density_ratio"), _number("h1 * h2", "traffic_pressure_index"),
    _number("d - b", "density_acceleration"), _number("abs(v - h1)", "speed_anomaly_index"),
    _number("d / (h1 + d + 0.00001)", "spatial_density_share"), _number("v * (h1 + 0.00001)", "traffic_resistance"),
    _number("h1 + h2 * 0.5", "node_centrality"), _number("(d - b) * (h1 * h2)", "st_momentum"), _number("avg_density", "avg_density"),
])


@register("m05_features", with_sql(_FEATURES, f"SELECT road_name, recordDatetime, {_FEATURE_COLUMNS} FROM raw"))
def features(spark, sf_dir):
    silver, roads, edges, scaler = _fitted(spark, sf_dir)
    return _rounded(feat.build_features(silver, roads, edges, scaler, SPEC))


@register("m07_given_models", with_sql(_FEATURES, f"""
, p AS (SELECT *, {_blend_sql("coalesce(d, 0)", "coalesce(b, 0)", "coalesce(d - b, 0)", "h1", "h2", "coalesce(v, 0)", "avg_speed", "minute(rec_ts)")} AS scaled_
        FROM raw, spans)
SELECT road_name, recordDatetime, round(scaled_, 6) AS pred_avg_density_scaled,
       round(least(greatest(scaled_, -1), 2) * avg_density_span + avg_density_low, 6) AS pred_avg_density,
       round(avg_density, 6) AS actual_avg_density_scaled, round(avg_density * avg_density_span + avg_density_low, 6) AS actual_avg_density
FROM p"""))
def given_scores(spark, sf_dir):
    """Boosted trees and a linear model, given by their dumps, over all feature rows."""
    silver, roads, edges, scaler = _fitted(spark, sf_dir)
    rows = feat.build_features(silver, roads, edges, scaler, SPEC)
    return _rounded(scoring.score(rows, _given(), scaler, SPEC))


@register("m07_m11_scores")
def scores(spark, sf_dir):
    """Models fitted on the rows and applied to them."""
    silver, roads, edges, scaler = _fitted(spark, sf_dir)
    rows = pin(feat.build_features(silver, roads, edges, scaler, SPEC))
    return scoring.score(rows, scoring.fit_models(rows, SPEC, rounds=5), scaler, SPEC)


_STEPS, _STEP_MINUTES = 6, 5


def _forecast_sql() -> str:
    """One CTE for the roads' newest rows and one for each step from there."""
    clipped = "least(greatest({}, -1), 2)"
    sql = _FEATURES + """,
anchor AS (SELECT max(rec_ts) AS anchor_ts FROM silver),
newest AS (SELECT road_id, road_name, avg_density AS d1, coalesce(avg_density_lag_1, avg_density) AS d2,
                  coalesce(avg_speed, 0) AS v FROM lagged QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY rec_ts DESC) = 1),
s0 AS (SELECT * FROM newest)"""
    for step in range(1, _STEPS + 1):
        blended = _blend_sql("s.d1", "s.d2", "s.d1 - s.d2", "h.h1", "h.h2", "s.v", "s.v", f"minute(anchor_ts + INTERVAL {step * _STEP_MINUTES} MINUTE)")
        sql += f""",
n{step} AS (SELECT e.src AS road_id, {clipped.format("coalesce(avg(c) FILTER (hop = 1), 0)")} AS h1, {clipped.format("coalesce(avg(c) FILTER (hop = 2), 0)")} AS h2
       FROM edges e JOIN (SELECT road_id AS dst, {clipped.format("d1")} AS c FROM s{step - 1}) USING (dst) GROUP BY ALL),
h{step} AS (SELECT road_id, coalesce(h1, 0) AS h1, coalesce(h2, 0) AS h2 FROM s{step - 1} LEFT JOIN n{step} USING (road_id)),
s{step} AS (SELECT s.road_id, s.road_name, {clipped.format(blended)} AS d1, s.d1 AS d2, s.v FROM s{step - 1} s JOIN h{step} h USING (road_id), anchor)"""
    return with_sql(sql, f"""
SELECT road_name, strftime(anchor_ts, '%Y-%m-%dT%H:%M') AS anchor_datetime, strftime(anchor_ts + INTERVAL {_STEPS * _STEP_MINUTES} MINUTE, '%Y-%m-%dT%H:%M') AS recordDatetime,
       CAST({_STEPS * _STEP_MINUTES} AS INTEGER) AS horizon_minutes, round(d1, 6) AS pred_avg_density_scaled,
       round(d1 * avg_density_span + avg_density_low, 6) AS pred_avg_density
FROM s{_STEPS}, anchor, spans""")


@register("m09_forecast", _forecast_sql())
def forecasts(spark, sf_dir):
    """All roads half an hour ahead in steps of five minutes, by the given models."""
    silver, roads, edges, scaler = _fitted(spark, sf_dir)
    anchor = silver.agg(F.max("rec_ts")).first()[0]
    target = anchor + timedelta(minutes=_STEPS * _STEP_MINUTES)
    return _rounded(fc.forecast(silver, roads, edges, scaler, _given(), SPEC, target, anchor, _STEP_MINUTES))
