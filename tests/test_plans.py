"""What the plans must look like, whatever the data."""

import re

import pytest
from pyspark.sql import functions as F

from cohortry.operators import grouping as g
from cohortry.operators import relational
from cohortry.plans import workloads as w
from cohortry.plans.queries import QUERIES, semantic
from tests.conftest import SMALL


def plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def scan_of(text, column):
    return [line for line in text.splitlines() if "FileScan" in line and column in line]


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_thresholds_reach_the_scan_and_columns_are_pruned(cohort):
    text = formatted(relational.passing_calls(cohort.calls, cohort.ladder).select("vaf"))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for column in ("l_tax", "l_extendedprice", "l_discount", "l_quantity"):
        assert f"GreaterThanOrEqual({column}" in pushed
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "l_returnflag" not in schema and "l_shipdate" not in schema


def test_small_dimensions_are_broadcast_by_size_not_by_hint(cohort):
    assert "BroadcastHashJoin" in plan(w.gene_stats(cohort))


def test_large_dimensions_shuffle(cohort, no_broadcast):
    text = plan(w.gene_burden(cohort))
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_statistics_take_one_scan(cohort):
    for df in (w.gene_burden(cohort), w.gene_stats(cohort)):
        assert len(scan_of(plan(df), "l_discount")) == 1


def test_facts_are_shuffled_once_per_direct_parent(cohort, no_broadcast):
    calls = relational.passing_calls(cohort.calls, cohort.ladder)
    draws = relational.draws_with_patients(
        relational.passing_specimens(cohort.specimens), cohort.patients
    )
    text = plan(calls.join(draws, "specimen_id").select("vaf", "primary_cancer_type"))
    assert len(re.findall(r"\bExchange hashpartitioning\(specimen_id", text)) == 2
    assert len(re.findall(r"\bExchange hashpartitioning\(patient_id", text)) == 2


def test_share_scans_once_and_has_no_window(cohort):
    text = plan(w.filter_breakdown(cohort))
    assert "ReusedExchange" in text and "Window" not in text


def test_top_call_is_limited_before_the_shuffle(cohort):
    text = plan(w.top_calls(cohort, relational.passing_calls(cohort.calls, cohort.ladder)))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_themes_are_limited_before_the_shuffle(spark):
    assert "Partial" in plan(QUERIES["text_themes"](spark, SMALL))


def test_top_k_is_no_full_sort(cohort):
    assert "TakeOrderedAndProject" in plan(w.top_confidence(cohort))
    assert "TakeOrderedAndProject" in plan(w.gene_burden(cohort))


def test_series_are_combined_before_the_window(cohort, no_broadcast):
    text = plan(w.vaf_trajectory(cohort))
    window = text.index("Window")
    assert "partial_min_by" in text[window:]


SINGLE = [n for n in QUERIES if n in (
    "gene_burden", "gene_stats", "vaf_trajectory", "rising_by_gene", "filter_share",
    "top_call_per_specimen", "text_themes", "sv_yield", "sv_call_metrics", "numbered_draws",
)]


@pytest.mark.parametrize("name", SINGLE)
def test_no_join_is_a_nested_loop(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_semantic_restriction_uses_the_foreign_key(cohort, no_broadcast):
    layer = semantic(cohort)
    text = plan(layer.run(["cancer_type"], ["patient_count"], ["is_reportable", "is_actionable"]))
    assert "LeftSemi" in text
    assert len(scan_of(text, "c_mktsegment")) == 1 and text.count("customer.parquet") <= 1


def test_hot_join_key_is_split(spark, cohort, no_broadcast):
    """A third of the calls on one draw: the skewed side is cut into pieces."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    hot = F.when(F.col("line_number") <= 3, F.lit(1)).otherwise(F.col("specimen_id"))
    calls = cohort.calls.withColumn("specimen_id", hot.cast("bigint")).repartition(16)
    joined = calls.join(cohort.specimens, "specimen_id")
    stats = g.group_stats(
        joined, ["lab_site"], [g.rows("n"), g.distinct("d", "specimen_id"), g.mean("v", "read_depth")]
    )
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        text = plan(stats)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in text


def scans(text):
    return text.count("FileScan")


def test_samples_take_two_scans_of_the_table(cohort):
    """The histogram's scan is over when the plan is made; the plan reads what the second one wrote."""
    text = plan(QUERIES["hash_sample"](cohort.spark, SMALL))
    assert scans(text) <= 5 and not scan_of(text, "l_orderkey")
    assert "SortAggregate" not in text


def test_score_defined_in_sql_needs_no_python(spark):
    text = plan(QUERIES["top_confidence_sql"](spark, SMALL))
    assert "Python" not in text and "Arrow" not in text
    assert "ArrowEvalPython" in plan(QUERIES["top_confidence"](spark, SMALL))


def test_model_score_is_a_native_expression(spark):
    text = plan(QUERIES["model_score"](spark, SMALL))
    assert not re.search("Python|Arrow|UDF|[vV]ector", text)


def test_bucketed_calls_are_not_moved(spark, no_broadcast):
    from cohortry.sources.tables import mapped
    from cohortry.sources import sinks

    cohort = mapped(spark, SMALL)
    stored = sinks.save_bucketed(cohort.calls, "calls_of_plan_test", "specimen_id")
    joined = stored.join(relational.passing_specimens(cohort.specimens), "specimen_id")
    text = plan(joined.groupBy("specimen_id").agg(F.max("vaf")))
    assert text.count("Exchange") == 1 and "SortMergeJoin" in text


def test_filtered_panel_prunes_the_folders_of_calls(spark):
    df = QUERIES["pruned_join"](spark, SMALL)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower()


@pytest.mark.parametrize("name", ["sv_actionable", "sv_call_metrics", "sv_synonyms"])
def test_distinct_metrics_meet_the_join_grouped(spark, no_broadcast, name):
    """Nothing of the calls reaches a join before it is grouped by its keys."""
    optimized = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    for at, line in enumerate(optimized):
        if "l_orderkey" in line and "Relation" in line:
            depth = len(re.match(r"[ :+\-]*", line).group())
            above = []
            for upper in reversed(optimized[:at]):
                d = len(re.match(r"[ :+\-]*", upper).group())
                if d < depth:
                    depth = d
                    above.append(upper[d:].split()[0])
            first = next(x for x in above if x in ("Join", "Aggregate"))
            assert first == "Aggregate", (name, above)


def test_table_parity_compares_digests(cohort):
    calls = cohort.calls.limit(3000).persist()
    try:
        one = F.col("specimen_id") == calls.agg(F.min("specimen_id")).first()[0]
        other = calls.withColumn("vaf", F.when(one, 0.77).otherwise(F.col("vaf")))
        key = cohort.call_key
        n = other.filter("vaf = 0.77").count()
        found = w.changed_rows(calls, other, key, buckets=64).collect()
        assert n >= 1 and len(found) == 2 * n
        assert {(r.n_left, r.n_right) for r in found} == {(1, 0), (0, 1)}
        assert w.unequal_buckets(calls, other, key, buckets=64).count() <= n
        missing = calls.filter("line_number <> 2")
        assert w.changed_rows(calls, missing, key, 64).agg(F.sum("n_left") - F.sum("n_right")).first()[0] == (
            calls.count() - missing.count()
        )
        assert w.unequal_buckets(calls, calls.repartition(7), key).count() == 0
        null = calls.withColumn("vaf", F.lit(None).cast("double"))
        assert w.unequal_buckets(null, null.withColumn("variant_type", F.lit(None).cast("string")), key, 8).count() == 8
    finally:
        calls.unpersist()
