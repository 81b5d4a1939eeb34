import statistics

import pytest
from pyspark.sql import functions as F

from cohortry.operators import grouping as g
from tests.conftest import rows

DATA = [
    ("a", "x", 1.0, 10, True), ("a", "x", 2.0, 20, False), ("a", "y", 4.0, 31, None),
    ("a", None, 4.0, 40, False), ("b", "z", None, 7, False), (None, "z", 3.0, 1, None),
    (None, "w", 5.0, 2, None),
]
MEASURES = [
    g.rows("n"), g.distinct("d", "s"), g.median("m", "v"), g.mean("avg", "i", decimals=2),
    g.largest("top", "v"), g.smallest("low", "v"), g.any_true("any", "f"),
    g.count_where("big", "i > 15"), g.rate("share", "i > 15"), g.total("sum", "i"),
]


def brute(key):
    mine = [r for r in DATA if r[0] == key]
    v = [r[2] for r in mine if r[2] is not None]
    f = [r[4] for r in mine if r[4] is not None]
    big = sum(r[3] > 15 for r in mine)
    return (
        key, len(mine), len({r[1] for r in mine if r[1] is not None}),
        statistics.median(v) if v else None, sum(r[3] for r in mine) / len(mine),
        max(v, default=None), min(v, default=None), any(f) if f else None, big,
        100.0 * big / len(mine), sum(r[3] for r in mine),
    )


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(DATA, "k string, s string, v double, i int, f boolean")


def test_all_measures_match_brute_force(df):
    got = {r[0]: tuple(r) for r in g.group_stats(df, ["k"], MEASURES).collect()}
    assert got == {k: brute(k) for k in ("a", "b", None)}


def test_buffered_median_gives_the_same(df):
    measures = [m if m.kind != "median" else g.median("m", F.col("v").cast("decimal(5,2)")) for m in MEASURES]
    got = {r[0]: tuple(r) for r in g.group_stats(df, ["k"], measures).collect()}
    assert got == {k: brute(k) for k in ("a", "b", None)}


def test_two_distinct_counts_and_no_keys(df):
    got = g.group_stats(df, [], [g.distinct("a", "s"), g.distinct("b", "k"), g.rows("n")])
    assert rows(got) == [(4, 2, 7)]


def test_empty_input(df):
    none = df.filter("i < 0")
    assert g.group_stats(none, ["k"], MEASURES).count() == 0
    assert rows(g.group_stats(none, [], [g.rows("n"), g.distinct("d", "s"), g.distinct("e", "k")])) == [
        (0, 0, 0)
    ]
    assert rows(g.group_stats(none, [], [g.rate("r", F.col("i") > 1)])) == [(None,)]


def test_partitioning_does_not_matter(df):
    one = rows(g.group_stats(df.repartition(1), ["k"], MEASURES))
    assert one == rows(g.group_stats(df.repartition(16), ["k"], MEASURES))


def test_share_and_stitch(spark, df):
    shares = rows(g.counts_with_share(df, ["k"], "n", "pct"))
    assert shares == [("a", 4, 57.14), ("b", 1, 14.29), (None, 2, 28.57)]
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([(None, 3.0), ("c", 4.0)], "k string, y double")
    assert rows(g.stitch([left, right], ["k"])) == [("a", 1, None), ("c", None, 4.0), (None, 2, 3.0)]


def test_partial_statistics_merge_to_the_same_as_whole_ones(spark):
    df = spark.range(3000).selectExpr(
        "id % 40 AS fk", "id % 40 % 3 AS k", "CASE WHEN id % 11 > 0 THEN id % 97 - 40 END AS v", "id * 40000 % 700000 AS wide",
        "CAST(id % 13 / 100 AS DECIMAL(6,5)) AS x", "id % 50 / 4.0D AS money",
    )
    measures = [
        g.rows("n"), g.distinct("values", F.col("v")), g.mean("m", F.col("money"), decimals=2), g.median("x50", F.col("x")),
        g.distinct("far", F.col("wide")), g.count_where("pos", F.col("v") > 0), g.largest("top", F.col("v")),
    ]
    assert all(g.mergeable(df, m) for m in measures)
    whole = g.group_stats(df, ["k"], measures)
    parts = g.partial_stats(df, ["fk"], measures)
    assert set(parts.columns) == {"fk", *g.partial_names(measures)}
    merged = g.merged_stats(parts.withColumn("k", F.col("fk") % 3), ["k"], measures)
    assert rows(merged) == rows(whole)
    for few in ([measures[1]], [measures[3]], [measures[0], measures[3]]):
        parts = g.partial_stats(df, ["fk"], few).withColumn("k", F.col("fk") % 3)
        assert rows(g.merged_stats(parts, ["k"], few)) == rows(g.group_stats(df, ["k"], few))
    assert not g.mergeable(df, g.distinct("t", F.col("v").cast("string")))


def test_more_decimals_than_declared_are_an_error(spark):
    df = spark.createDataFrame([(1.25,), (2.5,), (None,)], "x double")
    assert rows(g.group_stats(df, [], [g.mean("m", "x", decimals=2)])) == [(1.875,)]
    with pytest.raises(Exception, match="m has more than 1 decimals"):
        g.group_stats(df, [], [g.mean("m", "x", decimals=1)]).collect()
