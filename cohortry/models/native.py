"""Saved models as one native SQL expression, callable from SQL by name.

Scoring through a pipeline assembles a vector for each row and calls the model on
it. Here the parameters of a saved model become an expression that Spark plans with
the rest of a query: no vector, no Python, and filters and columns are pruned around
it. A linear model is its formula. The trees of a forest or of a boosted model lie
in a few constant arrays, one entry a node; a row walks each tree from its root for
as many steps as the deepest tree has, and a leaf leads to itself. The expression has
the same size for every number of trees.

A NULL feature is an error, as it is when the pipeline scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel,
)
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# The nodes of all trees come to the driver and into the plan, so their number is bounded.
MOST_NODES = 1_000_000


class NotNative(ValueError):
    """A model that has no native expression."""


def _double(x: float) -> str:
    return f"{float(x)!r}D"


def _doubles(values: Sequence[float]) -> str:
    return f"array({', '.join(map(_double, values))})"


def _ints(values: Sequence[int]) -> str:
    return f"array({', '.join(map(str, values))})"


def _feature(name: str) -> str:
    return f"coalesce(cast(`{name}` as double), raise_error('feature {name} is NULL'))"


def _stage_path(path: str, model: PipelineModel, at: int) -> str:
    digits = len(str(len(model.stages)))
    return f"{path}/stages/{at:0{digits}d}_{model.stages[at].uid}"


def _nodes(spark: SparkSession, path: str) -> tuple[list[Row], dict[int, float]]:
    """All nodes of a saved ensemble in the order of trees and nodes, and the weight of each tree."""
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id")
    rows = data.limit(MOST_NODES + 1).collect()
    if len(rows) > MOST_NODES:
        raise NotNative(f"more than {MOST_NODES} nodes")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight")
    return rows, {r["tree"]: r["weight"] for r in weights.select("tree", "weight").collect()}


def _walk(features: Sequence[str], rows: list[Row], leaf_value) -> str:
    """The sum over all trees of the value of the leaf that a row comes to."""
    place = {(r["treeID"], r["id"]): i for i, r in enumerate(rows, 1)}
    feature, bound, left, right, value, depth_of = [], [], [], [], [], {}
    for i, r in enumerate(rows, 1):
        inner = r["leftChild"] >= 0
        if inner and r["split"]["numCategories"] != -1:
            raise NotNative("a split by categories")
        feature.append(r["split"]["featureIndex"] + 1 if inner else 1)
        bound.append(r["split"]["leftCategoriesOrThreshold"][0] if inner else 0.0)
        left.append(place[r["treeID"], r["leftChild"]] if inner else i)
        right.append(place[r["treeID"], r["rightChild"]] if inner else i)
        value.append(0.0 if inner else leaf_value(r))
        # A parent comes before its children.
        level = depth_of.setdefault(i, 0)
        for child in (left[-1], right[-1]) if inner else ():
            depth_of[child] = level + 1
    roots = [i for i, r in enumerate(rows, 1) if r["id"] == 0]
    levels = _ints(range(max(depth_of.values(), default=0)) or [0])
    step = (
        f"if(element_at(x, element_at({_ints(feature)}, node)) <= element_at({_doubles(bound)}, node), "
        f"element_at({_ints(left)}, node), element_at({_ints(right)}, node))"
    )
    leaf = f"aggregate({levels}, root, (node, level) -> {step})"
    summed = f"aggregate({_ints(roots)}, 0.0D, (so_far, root) -> so_far + element_at({_doubles(value)}, {leaf}))"
    # The features are put into an array once a row.
    row = f"array({', '.join(map(_feature, features))})"
    return f"element_at(transform(array({row}), x -> {summed}), 1)"


def _linear(stages: Sequence, model: LogisticRegressionModel, features: Sequence[str]) -> str:
    terms = [_feature(f) for f in features]
    for scaler in stages:
        if scaler.getWithMean():
            terms = [f"({t} - {_double(m)})" for t, m in zip(terms, scaler.mean.toArray(), strict=True)]
        if scaler.getWithStd():
            terms = [f"{t} * {_double(1 / s if s else 0.0)}" for t, s in zip(terms, scaler.std.toArray(), strict=True)]
    weighed = [f"{_double(c)} * ({t})" for c, t in zip(model.coefficients.toArray(), terms, strict=True)]
    return f"1.0D / (1.0D + exp(-({' + '.join([_double(model.intercept), *weighed])})))"


def score_sql(spark: SparkSession, path: str) -> str:
    """SQL of the positive class's probability under the model saved at ``path``, in the names of its features."""
    model = PipelineModel.load(path)
    assembler, *between, last = model.stages
    if not isinstance(assembler, VectorAssembler) or not all(isinstance(s, StandardScalerModel) for s in between):
        raise NotNative("only assembled and scaled features are known")
    features = assembler.getInputCols()
    if isinstance(last, LogisticRegressionModel):
        return _linear(between, last, features)
    if between:
        raise NotNative("trees over scaled features")
    rows, weights = _nodes(spark, _stage_path(path, model, len(model.stages) - 1))
    if isinstance(last, RandomForestClassificationModel):
        def share(r: Row) -> float:
            total = sum(r["impurityStats"])
            return r["impurityStats"][1] / total / len(weights) if total else 0.0

        return _walk(features, rows, share)
    if isinstance(last, GBTClassificationModel):
        margin = _walk(features, rows, lambda r: weights[r["treeID"]] * r["prediction"])
        return f"1.0D / (1.0D + exp(-2.0D * {margin}))"
    raise NotNative(f"{type(last).__name__} has no native expression")


def register_score(
    spark: SparkSession, function: str, path: str, signature: Sequence[tuple[str, str]], replace: bool = True
) -> None:
    """Make the saved model a SQL function of its features, in the order of ``signature``.

    The planner puts the function's body in the place of each call.
    """
    if not replace and spark.catalog.functionExists(function):
        raise ValueError(f"function {function!r} is already registered")
    parameters = ", ".join(f"`{name}` {dtype}" for name, dtype in signature)
    create = "CREATE OR REPLACE TEMPORARY FUNCTION" if replace else "CREATE TEMPORARY FUNCTION"
    spark.sql(f"{create} `{function}`({parameters}) RETURNS DOUBLE RETURN {score_sql(spark, path)}")


def scored(df: DataFrame, function: str, features: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """``df`` with the score of a registered function and the class above the threshold."""
    with_score = df.withColumn("score", F.call_function(function, *(F.col(f) for f in features)))
    return with_score.withColumn("prediction", (F.col("score") > threshold).cast("bigint"))
