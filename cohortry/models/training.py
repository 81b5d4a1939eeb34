"""Three classifiers as Spark ML pipelines, and the checks before one is kept."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.models.metrics import holdout_metrics
from cohortry.operators.sampling import stratified_split, with_class_weights
from cohortry.session import checkpointed


class SingleClassError(ValueError):
    """The model, or its training label, knows only one class."""


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    holdout: DataFrame


def _assembled(features: Sequence[str], name: str = "features") -> VectorAssembler:
    # A NULL feature is an error, not a silently dropped row.
    return VectorAssembler(inputCols=list(features), outputCol=name, handleInvalid="error")


def logistic(features: Sequence[str], label: str, weight: str = "weight", max_iter: int = 1000) -> Pipeline:
    """Standardised features and a linear model, kept together as one."""
    return Pipeline(
        stages=[
            _assembled(features, "raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            LogisticRegression(
                featuresCol="features", labelCol=label, weightCol=weight, maxIter=max_iter,
                standardization=False,
            ),
        ]
    )


def forest(
    features: Sequence[str], label: str, weight: str = "weight", trees: int = 40, depth: int = 8,
    min_rows: int = 50, seed: int = 42,
) -> Pipeline:
    return Pipeline(
        stages=[
            _assembled(features),
            RandomForestClassifier(
                featuresCol="features", labelCol=label, weightCol=weight, numTrees=trees,
                maxDepth=depth, minInstancesPerNode=min_rows, seed=seed,
            ),
        ]
    )


def boosted(
    features: Sequence[str], label: str, weight: str = "weight", rounds: int = 120, depth: int = 6,
    step: float = 0.1, min_rows: int = 50, seed: int = 7,
) -> Pipeline:
    return Pipeline(
        stages=[
            _assembled(features),
            GBTClassifier(
                featuresCol="features", labelCol=label, weightCol=weight, maxIter=rounds,
                maxDepth=depth, stepSize=step, minInstancesPerNode=min_rows, seed=seed,
            ),
        ]
    )


def given_logistic(
    spark: SparkSession, features: Sequence[str], coefficients: Sequence[float], intercept: float
) -> PipelineModel:
    """A logistic model whose numbers come from elsewhere, as a pipeline that can be saved and registered."""
    context = spark.sparkContext
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "given_logistic", _py2java(context, DenseVector(coefficients)), float(intercept)
    )
    model = LogisticRegressionModel(made)
    return PipelineModel([_assembled(features), model])


def with_probability(scored: DataFrame, name: str = "score") -> DataFrame:
    """The probability of the positive class as a plain double."""
    return scored.withColumn(name, vector_to_array("probability")[1])


def train(
    frame: DataFrame, pipeline: Pipeline, label: str, key: Sequence[str], test_share: float = 0.25,
    tie_break: Sequence[str] = (), salt: int = 0,
) -> Trained:
    """Fit on three quarters of each class, measure on the rest.

    The frame and its split are checkpointed, so that all passes of the fit
    read the same rows and a lost executor does not draw the sample again. A
    model that predicts a single class is refused.
    """
    split = checkpointed(
        stratified_split(checkpointed(frame), label, test_share, key, tie_break=tie_break, salt=salt)
    )
    classes = split.filter(~F.col("is_test")).select(label).distinct().limit(2).count()
    if classes < 2:
        raise SingleClassError(f"label {label!r} has a single class in the training rows")
    fit_rows = with_class_weights(split.filter(~F.col("is_test")), label)
    model = pipeline.fit(fit_rows)
    holdout = with_probability(model.transform(split.filter("is_test")))
    metrics = holdout_metrics(holdout, "score", "prediction", label)
    if metrics["predicted_positive_rate"] in (0.0, 1.0):
        raise SingleClassError("the model predicts a single class")
    return Trained(model, metrics, holdout)
