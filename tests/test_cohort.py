"""Workloads on a hand-made cohort, and series against a plain lag."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.operators import relational
from cohortry.operators.series import trajectory
from cohortry.plans import workloads as w
from tests.conftest import rows


def test_reportable_view_of_natural_cohort(tiny):
    view = relational.reportable_view(tiny)
    assert set(relational.VIEW_COLUMNS) <= set(view.columns) and len(view.columns) == 21
    assert rows(view.select("variant_call_id")) == [(1,), (2,), (3,), (4,), (6,)]
    assert view.filter("gene_symbol = 'G2' AND targeted_therapy IS NULL").count() == 1


def test_gene_burden_by_hand(tiny):
    got = rows(w.gene_burden(tiny))
    assert got == [("G1", 4, 3, 11.0, 3750.0, True), ("G2", 1, 1, 3.0, 3000.0, False)]
    assert w.gene_burden(tiny, 1).toPandas()["gene_symbol"].tolist() == ["G1"]


def test_gene_stats_by_hand(tiny):
    assert rows(w.gene_stats(tiny)) == [
        ("G1", True, 5, 4, 3, 12.0, 20.0, 3800.0), ("G2", False, 2, 2, 2, 5.5, 8.0, 2500.0),
    ]


def test_segments_assays_profile(tiny):
    assert rows(w.actionable_by_segment(tiny)) == [("Lung", 2, 4)]
    assert rows(w.calls_by_gene_and_assay(tiny)) == [("G1", "A", 3), ("G1", "B", 1), ("G2", "A", 1)]
    assert rows(w.table_profile(tiny)) == [(7, 4, 2, 1.8)]
    assert rows(w.filter_breakdown(tiny)) == [("PASS", 6, 85.71), ("low_mapq", 1, 14.29)]


def test_trajectory_by_hand(tiny):
    """Only the last call of the earlier date and the first of the later meet."""
    (row,) = w.vaf_trajectory(tiny).collect()
    assert (row.patient_id, row.gene_symbol, row.prev_vaf, row.vaf) == ("P1", "G1", 0.12, 0.12)
    assert (row.vaf_delta, row.days_between, row.vaf_trend) == (0.0, 31, "falling")
    assert rows(w.rising_by_gene(tiny)) == [("G1", 1, 0, 0.0, 0.0)]


def test_top_confidence_and_cohort(tiny):
    top = w.top_confidence(tiny, 2).collect()
    assert [r.variant_call_id for r in top] == [4, 1]
    assert rows(w.actionable_cohort(tiny).select("variant_call_id")) == [(1,), (2,), (4,), (6,)]


def test_top_call_prefers_the_smaller_key_on_ties(spark, tiny):
    tied = tiny.calls.withColumn("vaf", F.lit(0.5))
    best = w.top_calls(tiny, relational.passing_calls(tied, tiny.ladder))
    assert rows(best.select("specimen_id", "variant_call_id")) == [
        ("S1", 1), ("S2", 4), ("S3", 6), ("S5", 7),
    ]



def test_training_frame_options(tiny):
    frame = rows(w.training_frame(tiny).select("variant_call_id", "is_pathogenic"))
    assert frame == [(1, 1), (2, 1), (3, 0), (4, 1), (6, 0), (7, 0)]
    checked = w.training_frame(tiny, require_qc=True)
    assert rows(checked.select("variant_call_id")) == [(1,), (2,), (3,), (4,), (6,)]


def test_load_checks_find_what_is_wrong(spark, tiny):
    from dataclasses import replace

    assert all(r.ok for r in w.load_checks(tiny).collect())
    extra = tiny.calls.filter("variant_call_id = 1").withColumn("specimen_id", F.lit("S99"))
    broken = replace(tiny, calls=tiny.calls.unionByName(extra))
    failed = {r.check_name for r in w.load_checks(broken).collect() if not r.ok}
    assert failed == {"duplicate_call_keys", "calls_without_specimen"}


def test_restriction_never_multiplies(spark, tiny):
    picked = tiny.calls.select("specimen_id").unionAll(tiny.calls.select("specimen_id"))
    assert relational.restrict_to(tiny.specimens, picked, ["specimen_id"]).count() == 4


def plain_lag(df):
    """The same pairs by a lag over every row."""
    order = Window.partitionBy("s").orderBy("d", "id")
    return (
        df.withColumns({"p": F.lag("v").over(order), "pd": F.lag("d").over(order)})
        .filter("p IS NOT NULL")
        .withColumn("days", F.datediff("d", "pd"))
        .filter("days > 0")
        .select("s", "d", "id", "v", "p", "pd", "days")
    )


@pytest.mark.parametrize("parts", [1, 16])
def test_trajectory_equals_lag_over_all_rows(spark, parts):
    rng = random.Random(11)
    start = dt.date(2024, 1, 1)
    data = [
        ("hot" if i % 3 else f"s{i % 20}", start + dt.timedelta(rng.randrange(12)), i,
         rng.choice([0.1, 0.2, None, 0.25]))
        for i in range(1500)
    ]
    data.append(("single", start, 9999, 0.5))
    df = spark.createDataFrame(data, "s string, d date, id int, v double").repartition(parts)
    got = trajectory(df, ["s"], "d", "v", ["id"], carry=["id"])
    slim = got.select("s", "d", "id", "v", "prev_v", "prev_date", "days_between")
    assert rows(slim) == rows(plain_lag(df))
