import pytest
from pyspark.sql import functions as F

from cohortry.functions.hashing import key_hash
from cohortry.operators import sampling as s
from tests.conftest import rows


@pytest.mark.parametrize("n", [0, 1, 37, 999, 1000, 5000])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    by_hash = [r.id for r in df.orderBy(key_hash("id"), "id").collect()]
    for parts in (1, 16):
        got = {r.id for r in s.sample_rows(df.repartition(parts), n, ["id"]).collect()}
        assert got == set(by_hash[:n])


def test_sample_of_nothing(spark):
    assert s.sample_rows(spark.range(0), 10, ["id"]).count() == 0


def test_sample_comes_before_the_filter(cohort):
    drawn = s.sample_rows(cohort.calls, 1000, cohort.call_key, cohort.call_order)
    assert drawn.count() == 1000
    assert 0 < drawn.filter(cohort.ladder.clears()).count() < 1000


def test_split_is_stratified_to_the_row(spark):
    df = spark.range(1003).select(
        "id", F.when(F.col("id") < 100, 1).when(F.col("id") < 1000, 0).alias("y")
    )
    split = s.stratified_split(df, "y", 0.25, ["id"])
    sizes = split.groupBy("y").agg(F.count_if("is_test"), F.count(F.lit(1)))
    assert rows(sizes) == [(0, 225, 900), (1, 25, 100), (None, 1, 3)]
    again = s.stratified_split(df.repartition(13), "y", 0.25, ["id"])
    assert rows(split) == rows(again)


def test_class_weights_balance(spark):
    df = spark.range(100).select("id", (F.col("id") < 10).cast("int").alias("y"))
    assert rows(s.class_weights(df, "y")) == [(0, 100 / 180), (1, 5.0)]
    weighted = s.with_class_weights(df, "y").groupBy("y").agg(F.round(F.sum("weight"), 6))
    assert rows(weighted) == [(0, 50.0), (1, 50.0)]


def test_repeated_keys_are_told_apart_by_the_tie_break(spark):
    df = spark.range(300).selectExpr("id div 30 AS k", "id AS t")
    for n in (1, 45, 299):
        assert s.sample_rows(df, n, ["k"], ["t"]).count() == n
