"""Model fitting with Spark ML, and batch scoring by compiled models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import values
from kerbside.plans.ensembles import Ensemble, Linear, as_column
from kerbside.plans.features import FeatureSpec, unscaled

# --- fixed values ---
PRIMARY_WEIGHT, SECONDARY_WEIGHT = 0.88, 0.12
# --- end of fixed values ---


def fit_models(
    features: DataFrame, spec: FeatureSpec, seed: int = 7, rounds: int = 10, depth: int = 4
) -> tuple[PipelineModel, PipelineModel]:
    """A boosted-tree and a linear model of the target, the two branches of the blend."""
    assembler = VectorAssembler(inputCols=list(spec.features), outputCol="_vector")
    trees = GBTRegressor(
        featuresCol="_vector", labelCol=spec.target, predictionCol="_primary",
        maxIter=rounds, maxDepth=depth, seed=seed, cacheNodeIds=False,
    )
    linear = LinearRegression(
        featuresCol="_vector", labelCol=spec.target, predictionCol="_secondary", regParam=0.01, solver="normal"
    )
    vectors = assembler.transform(features).select("_vector", spec.target)
    return (
        PipelineModel([assembler, trees.fit(vectors)]),
        PipelineModel([assembler.copy().setOutputCol("_vector2"), linear.fit(vectors).setFeaturesCol("_vector2")]),
    )


def blend(primary: Column, secondary: Column, weights: tuple[float, float] = (PRIMARY_WEIGHT, SECONDARY_WEIGHT)) -> Column:
    return primary * weights[0] + secondary * weights[1]


Model = PipelineModel | Ensemble | Linear


def predict(
    features: DataFrame, models: tuple[Model, Model], weights: tuple[float, float] = (PRIMARY_WEIGHT, SECONDARY_WEIGHT)
) -> DataFrame:
    """``pred_scaled`` added to every row, by expressions in the plan of the features."""
    return features.withColumn("pred_scaled", blend(*(as_column(m) for m in models), weights))


def score(
    features: DataFrame,
    models: tuple[Model, Model],
    scaler: DataFrame,
    spec: FeatureSpec,
    weights: tuple[float, float] = (PRIMARY_WEIGHT, SECONDARY_WEIGHT),
) -> DataFrame:
    """Predicted and actual density of each row, scaled and real."""
    scored = predict(features, models, weights)
    real = unscaled(values.scored_density(F.col("pred_scaled")), scaler, spec.target)
    actual = unscaled(values.scored_density(F.col(spec.target)), scaler, spec.target)
    return scored.select(
        "road_name",
        "recordDatetime",
        F.col("pred_scaled").alias("pred_avg_density_scaled"),
        real.alias("pred_avg_density"),
        F.col(spec.target).alias("actual_avg_density_scaled"),
        actual.alias("actual_avg_density"),
    )
