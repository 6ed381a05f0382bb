"""Features, scores and forecast: invariants and refusals."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.catalog import models as models_
from kerbside.plans import ensembles
from kerbside.plans import features as feat
from kerbside.plans import forecast as fc
from kerbside.plans import scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    silver, roads, edges, scaler = models_._fitted(spark, SF)
    rows = feat.build_features(silver, roads, edges, scaler, models_.SPEC)
    return silver, roads, edges, scaler, rows, scoring.fit_models(rows, models_.SPEC, rounds=3)


def test_features_are_finite_and_complete(fitted):
    silver, *_, rows, _ = fitted
    assert rows.count() == silver.count()
    odd = [F.count_if(F.col(f"`{c}`").isNull() | F.isnan(f"`{c}`")).alias(c) for c in models_.SPEC.features]
    assert set(rows.agg(*odd).first()) == {0}
    assert "avg_density" not in models_.SPEC.features


def test_scores_undo_the_scale(fitted):
    silver, _, _, scaler, rows, both = fitted
    scored = scoring.score(rows, both, scaler, models_.SPEC)
    actual = {(r["road_name"], r["recordDatetime"]): r["avg_density"] for r in silver.collect()}
    for r in scored.collect():
        assert r["actual_avg_density"] == pytest.approx(actual[(r["road_name"], r["recordDatetime"])], abs=1e-6)


def test_forecast_is_whole_and_bounded(spark, fitted):
    silver, roads, edges, scaler, _, both = fitted
    anchor = silver.agg(F.max("rec_ts")).first()[0]
    for step in (7, 30):
        args = (silver, roads, edges, scaler, both, models_.SPEC, anchor + timedelta(minutes=30), anchor, step)
        got = fc.forecast(*args).collect()
        assert sorted(r["road_name"] for r in got) == sorted(r["road_name"] for r in roads.collect())
        assert all(-1.0 <= r["pred_avg_density_scaled"] <= 2.0 and r["horizon_minutes"] == 30 for r in got)


def test_refused_targets():
    anchor = datetime(2024, 1, 1, 12)
    assert fc.check_target(anchor, anchor + timedelta(minutes=31), 5) == (31, 7)
    for target, step in ((anchor, 5), (anchor + timedelta(days=3, minutes=1), 5), (anchor + timedelta(hours=1), 0), (anchor + timedelta(seconds=20), 5)):
        with pytest.raises(ValueError):
            fc.check_target(anchor, target, step)


def test_missing_inputs_are_named(spark):
    with pytest.raises(ValueError, match="avg_speed"):
        feat.canonical_input(spark.range(1))


def test_compiled_models_give_what_the_fitted_ones_give(fitted):
    *_, rows, models = fitted
    for model in models:
        scored = model.transform(rows)
        want = scored.withColumn("want", F.col("_primary" if "_primary" in scored.columns else "_secondary"))
        far = want.select(F.max(F.abs(F.col("want") - ensembles.as_column(model)))).first()[0]
        assert far < 1e-9
    assert ensembles.features_of(models[0]) <= set(feat.FeatureSpec(models_.SPEC.weather_labels).features)


def test_dumped_trees(spark):
    """Both kinds of dumps, with values on a threshold, above and below it, NaN and null."""
    leafwise = ensembles.from_leafwise_dump({"feature_names": ["a", "b"], "tree_info": [{"tree_structure": {
        "split_feature": 0, "threshold": 1.0, "decision_type": "<=", "missing_type": "NaN", "default_left": True, "left_child": {"leaf_value": 1.0},
        "right_child": {"split_feature": 1, "threshold": 0.0, "decision_type": "<=", "left_child": {"leaf_value": 2.0}, "right_child": {"leaf_value": 4.0}}}}]})
    levelwise = ensembles.from_levelwise_dump(['{"nodeid": 0, "split": "a", "split_condition": 1.0, "yes": 1, "no": 2, "missing": 2,'
                                               ' "children": [{"nodeid": 1, "leaf": 10}, {"nodeid": 2, "leaf": 20}]}'], offset=0.5)
    rows = spark.createDataFrame([(1.0, 0.0), (0.5, 9.0), (1.5, 0.0), (1.5, 0.1), (None, 1.0), (float("nan"), 1.0), (2.0, None)], "a double, b double")
    got = [tuple(r) for r in rows.select(ensembles.as_column(leafwise), ensembles.as_column(levelwise)).collect()]
    assert got == [(1.0, 20.5), (1.0, 10.5), (2.0, 20.5), (4.0, 20.5), (1.0, 20.5), (1.0, 20.5), (4.0, 20.5)]
    with pytest.raises(ValueError, match="decision"):
        ensembles.from_leafwise_dump({"feature_names": ["a"], "tree_info": [{"tree_structure": {
            "split_feature": 0, "threshold": "1", "decision_type": "==", "left_child": {"leaf_value": 0}, "right_child": {"leaf_value": 0}}}]})


def test_forecast_of_roads_apart(spark, fitted):
    """Roads without neighbours forecast too, and edges to roads without a history change nothing."""
    silver, roads, edges, scaler, _, both = fitted
    anchor = silver.agg(F.max("rec_ts")).first()[0]
    args = (scaler, both, models_.SPEC, anchor + timedelta(minutes=12), anchor, 5)
    none = fc.forecast(silver, roads, edges.limit(0), *args).collect()
    unknown = spark.createDataFrame([(0, 999, 1), (999, 0, 2)], edges.schema)
    assert len(none) == roads.count()
    got = fc.forecast(silver, roads, unknown, *args).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, none))
