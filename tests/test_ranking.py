import random
import statistics

import pytest
from pyspark.sql import functions as F

from cohortry.operators import ranking
from tests.conftest import rows


def skewed(spark, parts):
    """One key holds two thirds of the rows; a NULL key and NULL values occur."""
    rng = random.Random(3)
    data = [("hot", rng.random()) for _ in range(2000)]
    data += [(f"k{i % 40}", rng.choice([0.5, 1.5, 2.5])) for i in range(900)]
    data += [(None, float(i)) for i in range(101)] + [("k1", None), ("empty", None)]
    return data, spark.createDataFrame(data, "k string, v double").repartition(parts)


@pytest.mark.parametrize("parts", [1, 16])
def test_exact_median_over_unlimited_values(spark, parts):
    data, df = skewed(spark, parts)
    got = dict(rows(ranking.exact_median(df, ["k"], "v")))
    want = {}
    for k in {k for k, _ in data}:
        values = [v for kk, v in data if kk == k and v is not None]
        if values:
            want[k] = statistics.median(values)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_both_median_forms_agree(spark):
    _, df = skewed(spark, 4)
    small = df.withColumn("d", F.col("v").cast("decimal(6,3)"))
    assert ranking.small_domain(small.schema["d"].dataType)
    assert not ranking.small_domain(small.schema["v"].dataType)
    buffered = dict(rows(ranking.exact_median(small, ["k"], "d")))
    ranked = dict(rows(ranking.exact_median(small.withColumn("v", F.col("d").cast("double")), ["k"], "v")))
    assert buffered.keys() == ranked.keys()
    assert all(abs(buffered[k] - ranked[k]) < 1e-9 for k in ranked)


def test_global_median(spark):
    df = spark.range(1001).select((F.col("id") * 0.5).alias("v"))
    assert rows(ranking.exact_median(df, [], "v")) == [(250.0,)]


def test_running_total_per_key(spark):
    data = [("a", i, i % 3) for i in range(500)] + [("b", 1, 4), (None, 2, 5)]
    df = spark.createDataFrame(data, "k string, o int, w long").repartition(7)
    got = {(r.k, r.o): (r.running, r.total) for r in ranking.running_total(df, ["k"], ["o"], "w").collect()}
    for key in {k for k, _, _ in data}:
        mine = sorted((o, w) for k, o, w in data if k == key)
        total, run = sum(w for _, w in mine), 0
        for o, weight in mine:
            run += weight
            assert got[(key, o)] == (run, total)


def test_numbering_is_gapless_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5003).alias("x")).repartition(9)
    numbered = rows(ranking.number_rows(df, ["x"], partitions=5))
    ordered = sorted(x for x, _ in numbered)
    assert {x: n for x, n in numbered} == {x: i + 1 for i, x in enumerate(ordered)}


def test_first_numbered_and_top_per_group_break_ties(spark):
    df = spark.createDataFrame(
        [("s", 1, 0.5), ("s", 2, 0.9), ("s", 3, 0.9), ("t", 4, None)], "g string, id int, v double"
    )
    best = ranking.top_per_group(df, ["g"], [F.desc_nulls_last("v"), F.asc("id")])
    assert rows(best.select("g", "id")) == [("s", 2), ("t", 4)]
    assert rows(ranking.first_numbered(df.select("id"), ["id"], 2)) == [(1, 1), (2, 2)]
    assert ranking.first_numbered(df.select("id"), ["id"], 99).count() == 4


@pytest.mark.parametrize("buckets", [4, 4096])
def test_median_by_ranges_matches_a_plain_median(spark, buckets):
    import random
    import statistics

    draw = random.Random(buckets)
    values = {
        "skew": [draw.lognormvariate(0, 9) for _ in range(501)], "same": [2.5] * 40, "two": [1.0, 4.0], "one": [7.0],
        "huge": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1e-300], "ties": [1.0] * 10 + [2.0] * 10 + [3.0],
        None: [float(i) for i in range(100)],
    }
    data = [(k, v) for k, vs in values.items() for v in vs] + [("none", None), ("nan", float("nan")), ("one", float("nan"))]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = dict((r.k, r.median) for r in ranking.median_by_ranges(df, ["k"], "v", buckets=buckets).collect())
    assert got == {k: statistics.median(vs) for k, vs in values.items()}
    every = [v for vs in values.values() for v in vs]
    assert rows(ranking.median_by_ranges(df, [], "v", buckets=buckets)) == [(statistics.median(every),)]
    assert rows(ranking.median_by_ranges(df.limit(0), ["k"], "v")) == []


def test_median_by_ranges_moves_no_rows(spark):
    df = spark.range(5000).selectExpr("id % 3 AS k", "id * 1.7D AS v").repartition(4)
    ranking.median_by_ranges(df, ["k"], "v")
    from cohortry.operators.ranking import null_safe_join

    ranges = spark.range(3).selectExpr("id AS k", "0.0D AS lo", "9.0D AS hi")
    text = null_safe_join(df, ranges, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
