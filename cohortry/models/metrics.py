"""Quality of a score, computed on the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.operators.ranking import running_total


def auc_by_rank(df: DataFrame, score: str, label: str, name: str = "roc_auc") -> DataFrame:
    """Area under the ROC curve as one row; tied scores count half.

    Rows are first counted per distinct score; the distinct scores are then
    ranked across tasks, however many there are. NULL without both classes.
    """
    positive = F.col(label) == 1
    counts = df.groupBy(score).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranked = running_total(counts, [], [score], "neg")
    # Twice the number of ordered pairs, exact: a bigint would overflow.
    twice_below = (F.col("running") - F.col("neg")) * 2 + F.col("neg")
    pairs = F.sum(F.col("pos").cast("decimal(18,0)") * twice_below.cast("decimal(19,0)"))
    return ranked.agg(
        F.try_divide(
            pairs.cast("double"),
            F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
        ).alias(name)
    )


def confusion_rates(df: DataFrame, predicted: Column, label: str) -> DataFrame:
    """Recall, predicted-positive rate and base rate as one row."""
    actual = F.col(label) == 1
    rows = F.count(F.lit(1)).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.try_divide(F.count_if(predicted & actual).cast("double"), F.count_if(actual).cast("double")).alias("recall"),
        F.try_divide(F.count_if(predicted).cast("double"), rows).alias("predicted_positive_rate"),
        F.try_divide(F.count_if(actual).cast("double"), rows).alias("base_rate"),
    )


def holdout_metrics(scored: DataFrame, score: str, prediction: str, label: str) -> dict[str, float]:
    """The same numbers on the driver: two rows of doubles, never data."""
    rates = confusion_rates(scored, F.col(prediction) == 1, label).first().asDict()
    auc = auc_by_rank(scored, score, label).first()[0]
    return {"roc_auc": auc, **{k: v for k, v in rates.items() if k != "n_rows"}}
