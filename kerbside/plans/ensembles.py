"""Tree ensembles and linear models as Catalyst expressions.

A fitted or dumped model becomes one ``Column``: a chain of conditions per tree, summed, or a
weighted sum of features. Scores are then computed inside the plan that makes the features, without
Python and without a model on each executor. Any tool's boosted trees come in through their JSON dump.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    """Rows with ``feature`` up to ``threshold`` (below it, if ``below``) go left; missing ones where ``missing_left`` says."""

    feature: str
    threshold: float
    left: Leaf | Split
    right: Leaf | Split
    below: bool = False
    missing_left: bool = False


@dataclass(frozen=True)
class Ensemble:
    """The weighted sum of the trees' leaves, plus ``offset``."""

    trees: tuple[Leaf | Split, ...]
    weights: tuple[float, ...]
    offset: float = 0.0


@dataclass(frozen=True)
class Linear:
    weights: Mapping[str, float]
    offset: float = 0.0


def features_of(model: Ensemble | Linear | PipelineModel) -> set[str]:
    """Names of the features that the model's prediction depends on."""
    if isinstance(model, PipelineModel):
        model = from_pipeline(model)
    if isinstance(model, Linear):
        return set(model.weights)

    def of(node: Leaf | Split) -> set[str]:
        return set() if isinstance(node, Leaf) else {node.feature} | of(node.left) | of(node.right)

    return set().union(*map(of, model.trees))


def _tree_column(node: Leaf | Split, column: Callable[[str], Column]) -> Column:
    if isinstance(node, Leaf):
        return F.lit(float(node.value))
    value = column(node.feature)
    # A null condition and a comparison with NaN both go right by themselves.
    goes_left = value < node.threshold if node.below else value <= node.threshold
    if node.missing_left:
        goes_left = value.isNull() | F.isnan(value) | goes_left
    return F.when(goes_left, _tree_column(node.left, column)).otherwise(_tree_column(node.right, column))


def as_column(model: Ensemble | Linear | PipelineModel, column: Callable[[str], Column] = F.col) -> Column:
    """The model's prediction from the feature columns; ``column`` finds a feature by its name."""
    if isinstance(model, PipelineModel):
        model = from_pipeline(model)
    total = F.lit(float(model.offset))
    if isinstance(model, Linear):
        for feature, weight in model.weights.items():
            total = total + column(feature) * F.lit(float(weight))
        return total
    for tree, weight in zip(model.trees, model.weights):
        value = _tree_column(tree, column)
        total = total + (value if weight == 1.0 else value * F.lit(float(weight)))
    return total


def from_pipeline(model: PipelineModel) -> Ensemble | Linear:
    """The model of a fitted pipeline of an assembler and one regression."""
    assembler, fitted = model.stages
    if not isinstance(assembler, VectorAssembler):
        raise TypeError("the first stage must assemble the features")
    return from_fitted(fitted, assembler.getInputCols())


def from_fitted(model, features: Sequence[str]) -> Ensemble | Linear:
    """A fitted Spark ML regression over ``features``, in the order of its vector."""
    if isinstance(model, LinearRegressionModel):
        return Linear(dict(zip(features, model.coefficients.toArray().tolist())), model.intercept)
    if isinstance(model, DecisionTreeRegressionModel):
        return Ensemble((_spark_node(model._java_obj.rootNode(), features),), (1.0,))
    if isinstance(model, GBTRegressionModel):
        weights = tuple(model.treeWeights)
    elif isinstance(model, RandomForestRegressionModel):
        weights = (1.0 / model.getNumTrees,) * model.getNumTrees
    else:
        raise TypeError(f"no expression for {type(model).__name__}")
    return Ensemble(tuple(_spark_node(t._java_obj.rootNode(), features) for t in model.trees), weights)


def _spark_node(node, features: Sequence[str]) -> Leaf | Split:
    if node.subtreeDepth() == 0:
        return Leaf(node.prediction())
    split = node.split()
    return Split(features[split.featureIndex()], split.threshold(), _spark_node(node.leftChild(), features), _spark_node(node.rightChild(), features))


def from_leafwise_dump(dump: str | dict) -> Ensemble:
    """The JSON dump of leaf-wise boosted trees: ``feature_names`` and ``tree_info`` with nested ``tree_structure``."""
    model = json.loads(dump) if isinstance(dump, str) else dump

    def node(found: dict) -> Leaf | Split:
        if "leaf_value" in found:
            return Leaf(found["leaf_value"])
        if found.get("decision_type", "<=") != "<=":
            raise ValueError(f"no expression for decision {found['decision_type']}")
        missing_left = found.get("missing_type", "None") != "None" and bool(found.get("default_left"))
        return Split(model["feature_names"][found["split_feature"]], found["threshold"], node(found["left_child"]), node(found["right_child"]),
                     missing_left=missing_left)

    trees = tuple(node(t["tree_structure"]) for t in model["tree_info"])
    return Ensemble(trees, (1.0,) * len(trees))


def from_levelwise_dump(trees: Sequence[str | dict], offset: float = 0.0) -> Ensemble:
    """JSON dumps of level-wise boosted trees, one a tree: nodes with ``split``, ``split_condition``, ``yes``, ``no``, ``children``."""

    def node(found: dict) -> Leaf | Split:
        if "leaf" in found:
            return Leaf(found["leaf"])
        children = {c["nodeid"]: c for c in found["children"]}
        return Split(found["split"], found["split_condition"], node(children[found["yes"]]), node(children[found["no"]]), below=True,
                     missing_left=found.get("missing") == found["yes"])

    read = tuple(node(json.loads(t) if isinstance(t, str) else t) for t in trees)
    return Ensemble(read, (1.0,) * len(read), offset)
