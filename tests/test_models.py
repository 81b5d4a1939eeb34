import random
import re

import pytest
from pyspark.sql import functions as F

from cohortry.models import training
from cohortry.models.metrics import auc_by_rank, confusion_rates
from cohortry.models.registry import ModelRegistry, SignatureError, VersionError, signature_of
from cohortry.plans import workloads as w
from cohortry.session import shared_folder
from tests.conftest import rows

LABEL = "is_pathogenic"


@pytest.fixture(scope="module")
def frame(cohort):
    from cohortry.session import checkpointed

    return checkpointed(w.training_frame(cohort))


@pytest.fixture(scope="module")
def trained(cohort, frame):
    return training.train(frame, training.logistic(w.FEATURES, LABEL), LABEL, cohort.call_key)


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [3, 10**6])
def test_auc_matches_all_pairs(spark, levels):
    rng = random.Random(levels)
    pairs = [(float(rng.randrange(levels)), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "s double, y int").repartition(5)
    assert auc_by_rank(df, "s", "y").first()[0] == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_rates_and_single_class(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 1), (0.8, 0), (0.1, 0)], "s double, y int")
    assert rows(confusion_rates(df, F.col("s") > 0.5, "y")) == [(4, 0.5, 0.5, 0.5)]
    assert auc_by_rank(df.filter("y = 0"), "s", "y").first()[0] is None
    with pytest.raises(training.SingleClassError):
        one = df.withColumn("y", F.lit(0)).withColumn("id", F.monotonically_increasing_id())
        training.train(one, training.logistic(["s"], "y"), "y", ["id"])


def check(result, frame):
    scored = result.holdout
    n = frame.count()
    assert abs(scored.count() - 0.25 * n) <= 1
    assert scored.filter("score < 0 OR score > 1").count() == 0
    assert scored.select("prediction").distinct().count() == 2
    assert result.metrics["roc_auc"] > 0.6
    assert 0 < result.metrics["recall"] <= 1


def test_logistic(trained, frame):
    check(trained, frame)


def test_forest_and_boosting(cohort, frame):
    for pipeline in (
        training.forest(w.FEATURES, LABEL, trees=10, depth=5),
        training.boosted(w.FEATURES, LABEL, rounds=4, depth=4),
    ):
        check(training.train(frame, pipeline, LABEL, cohort.call_key), frame)


def test_retraining_gives_the_same_scores(cohort, frame, trained):
    again = training.train(
        frame.repartition(3), training.logistic(w.FEATURES, LABEL), LABEL, cohort.call_key
    )
    assert again.metrics["roc_auc"] == pytest.approx(trained.metrics["roc_auc"], abs=1e-6)


def test_null_feature_is_an_error(cohort, frame):
    broken = frame.withColumn("vaf", F.when(F.col("line_number") > 1, F.col("vaf")))
    with pytest.raises(Exception, match="[Nn]ull"):
        training.train(broken, training.logistic(w.FEATURES, LABEL), LABEL, cohort.call_key)


def test_registry_life_cycle(spark, cohort, frame, trained):
    registry = ModelRegistry(spark, shared_folder(spark, "models"))
    assert registry.versions().count() == 0
    signature = signature_of(frame, w.FEATURES)
    registry.register("clf", "V1", trained.model, signature, trained.metrics, "first")
    with pytest.raises(VersionError):
        registry.register("clf", "V1", trained.model, signature)
    with pytest.raises(VersionError):
        registry.register("clf", "", trained.model, signature)
    with pytest.raises(ValueError, match="single class"):
        registry.register("clf", "V9", trained.model, signature, {"predicted_positive_rate": 1.0})
    path = registry.versions("clf").first().path
    registry.register_saved("clf", "V2", path, signature, comment="loaded")
    listed = registry.versions("clf").select("version", "comment", "is_default")
    assert rows(listed) == [("V1", "first", True), ("V2", "loaded", False)]
    registry.set_default("clf", "V2")
    registry.register("clf", "V1", trained.model, signature, comment="again", replace=True)
    listed = registry.versions("clf").select("version", "comment", "is_default")
    assert rows(listed) == [("V1", "again", False), ("V2", "loaded", True)]
    registry.drop_version("clf", "V1")
    with pytest.raises(VersionError):
        registry.load("clf", "V1")
    with pytest.raises(VersionError):
        registry.set_default("clf", "V7")

    calls = cohort.calls.select(*cohort.call_key, *w.FEATURES)
    scored = registry.score(calls, "clf")
    assert scored.count() == calls.count()
    assert scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert rows(scored.select("prediction").distinct()) == [(0,), (1,)]
    with pytest.raises(SignatureError):
        registry.score(calls.drop("vaf"), "clf")
    with pytest.raises(SignatureError):
        registry.score(calls.withColumn("vaf", F.col("vaf").cast("string")), "clf")


@pytest.mark.parametrize("kind", ["logistic", "forest", "boosted", "given"])
def test_native_function_scores_like_the_pipeline(spark, cohort, frame, kind):
    made = {
        "logistic": lambda: training.logistic(w.FEATURES, LABEL),
        "forest": lambda: training.forest(w.FEATURES, LABEL, trees=7, depth=6, min_rows=5),
        "boosted": lambda: training.boosted(w.FEATURES, LABEL, rounds=5, depth=4, min_rows=5),
    }
    if kind == "given":
        model = training.given_logistic(spark, w.FEATURES, w.GIVEN_COEFFICIENTS, w.GIVEN_INTERCEPT)
    else:
        model = training.train(frame, made[kind](), LABEL, cohort.call_key).model
    registry = ModelRegistry(spark, shared_folder(spark, "models"))
    registry.register("clf", "V1", model, signature_of(frame, w.FEATURES))
    registry.register_function(f"clf_{kind}", "clf", "V1")
    registry.score(frame, "clf", "V1").createOrReplaceTempView("piped")
    call = f"clf_{kind}({', '.join(w.FEATURES)})"
    plan = spark.sql(f"SELECT {call} FROM {{t}}", t=frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|UDF|[vV]ector", plan)
    n, apart = spark.sql(f"SELECT count(*), max(abs(score - {call})) FROM piped").first()
    assert n == frame.count() and apart < 1e-12


def test_native_function_refuses_null_features_and_unknown_versions(spark, frame):
    registry = ModelRegistry(spark, shared_folder(spark, "models"))
    model = training.given_logistic(spark, ["a", "b"], [1.0, 2.0], 0.0)
    registry.register("ab", "V1", model, [("a", "double"), ("b", "int")])
    registry.register_function("ab", "ab")
    assert spark.sql("SELECT ab(0.0D, 0)").first()[0] == 0.5
    with pytest.raises(Exception, match="feature a is NULL"):
        spark.sql("SELECT ab(a, 1) FROM VALUES (NULL), (1.0D) AS t(a)").collect()
    with pytest.raises(VersionError):
        registry.register_function("ab", "ab", "V2")
    with pytest.raises(ValueError, match="already registered"):
        registry.register_function("ab", "ab", replace=False)
