from dataclasses import replace

import pytest

from cohortry.plans.queries import semantic
from cohortry.plans.workloads import parity
from cohortry.semantic.model import (
    DerivedMetric, LogicalTable, ModelError, Relationship, SemanticModel, cohort_model, from_dict,
)
from cohortry.semantic.query import SemanticQuery
from tests.conftest import rows


@pytest.fixture(scope="module")
def layer(tiny):
    """The shipped model on the hand-made cohort, whose call key differs."""
    model = cohort_model()
    tables = tuple(
        replace(t, primary_key=("variant_call_id",)) if t.name == "calls" else t
        for t in model.tables
    )
    return SemanticQuery(replace(model, tables=tables), tiny.tables())


def test_each_metric_keeps_its_own_grain(layer):
    got = layer.run(["specimens.lab_site"], ["avg_tumor_fraction", "specimen_count", "total_calls"])
    # N has two draws with five calls; S has two draws, one of them without calls.
    assert rows(got) == [("N", 0.15, 2, 5), ("S", 0.03, 2, 1), ("W", 0.3, 1, 1)]


def test_group_without_calls_counts_zero_not_null(layer):
    got = layer.run(
        ["specimens.specimen_id"], ["total_calls", "reportable_calls_per_specimen"]
    )
    assert ("S4", 0, 0.0) in rows(got)


def test_patients_without_draws_count_until_a_child_filter(layer):
    assert rows(layer.run(["cancer_type"], ["patient_count"])) == [("Breast", 2), ("Lung", 2)]
    with_draw = layer.run(["cancer_type"], ["patient_count"], ["specimens.qc_passed"])
    assert rows(with_draw) == [("Lung", 2)]
    actionable = layer.run(["cancer_type"], ["patient_count"], ["calls.is_reportable", "is_actionable"])
    assert rows(actionable) == [("Lung", 2)]


def test_far_filters_must_hold_on_one_row(layer):
    """P3 has a reportable call and P3 has no actionable one: no match."""
    got = layer.run([], ["patient_count"], [("calls.consequence", "stop_gained"), "is_actionable"])
    assert rows(got) == [(1,)]


def test_filters_say_what_they_say(layer):
    plain = layer.run([], ["total_calls"], ["is_reportable"])
    assert rows(plain) == [(6,)]
    defaults = layer.run([], ["total_calls"], default_filters=True)
    assert rows(defaults) == [(5,)]
    listed = layer.run([], ["total_calls"], [("specimens.lab_site", ["S", "W"])])
    assert rows(listed) == [(2,)]


def test_zero_denominator_is_null(layer):
    model = replace(
        layer.model,
        derived=(DerivedMetric("odd", "calls.total_calls", "calls.reportable_calls"),),
    )
    query = SemanticQuery(model, layer._tables)
    got = query.run(["call_filter"], ["odd"])
    assert rows(got) == [("PASS", 1.0), ("low_mapq", None)]


def test_panel_genes_never_hit_stay(layer):
    got = layer.run(["panel.gene"], ["genes_on_panel", "total_calls", "median_vaf_pct"])
    assert rows(got) == [("G1", 1, 5, 12.0), ("G2", 1, 2, 5.5), ("G9", 1, 0, None)]


def test_names_synonyms_and_errors(layer):
    run = layer.run
    assert rows(run(["Segment"], ["Number of Patients"])) == rows(run(["cancer_type"], ["patient_count"]))
    for dims, metrics, where in (
        ([], ["nothing"], ()), (["nothing"], ["total_calls"], ()), ([], [], ()),
        (["calls.f_is_pass"], ["total_calls"], ()), (["calls.f_vaf"], ["total_calls"], ()),
        (["lab_site"], ["patient_count"], ()), ([], ["total_calls"], ["lab_site"]),
        (["patient_id", "specimen_id"], ["patient_count"], ()),
    ):
        with pytest.raises(ModelError):
            run(dims, metrics, where)
    assert layer.model.synonyms()["site"] == ["specimens.lab_site"]


def test_ambiguous_names_and_paths():
    a = from_dict({
        "name": "m",
        "tables": [
            {"name": t, "base_table": t, "primary_key": {"columns": ["id"]},
             "dimensions": [{"name": "gene", "synonyms": ["symbol"]}]}
            for t in ("x", "y")
        ],
    })
    for name in ("gene", "symbol"):
        with pytest.raises(ModelError, match="ambiguous"):
            a.field_named(name)
    assert a.field_named("x.gene")[0] == "x" and a.field_named("y.symbol")[0] == "y"
    link = lambda n, m, o: Relationship(n, m, o, (("k", "k"),))
    diamond = SemanticModel(
        "d", tuple(LogicalTable(t, t, ("k",)) for t in "abcd"),
        (link("1", "a", "b"), link("2", "a", "c"), link("3", "b", "d"), link("4", "c", "d")),
    )
    with pytest.raises(ModelError, match="several paths"):
        diamond.path("a", "d")
    assert diamond.path("b", "c") is None


def test_free_expressions_and_ratio_text(tiny):
    """A specification that states metrics as aggregate expressions only."""
    spec = {
        "name": "plain",
        "tables": [
            {"name": "specimens", "base_table": {"database": "x", "schema": "y", "table": "specimens"},
             "primary_key": {"columns": ["SPECIMEN_ID"]},
             "dimensions": [{"name": "lab_site", "expr": "LAB_SITE", "data_type": "VARCHAR"}],
             "metrics": [{"name": "specimen_count", "expr": "COUNT(DISTINCT SPECIMEN_ID)"}]},
            {"name": "calls", "base_table": {"table": "calls"},
             "primary_key": {"columns": ["VARIANT_CALL_ID"]},
             "metrics": [
                 {"name": "reportable", "expr": "SUM(CASE WHEN CALL_FILTER = 'PASS' THEN 1 ELSE 0 END)"},
                 {"name": "median_vaf_pct", "expr": "MEDIAN(VAF) * 100"},
             ]},
        ],
        "relationships": [
            {"name": "r", "left_table": "calls", "right_table": "specimens",
             "relationship_columns": [{"left_column": "SPECIMEN_ID", "right_column": "SPECIMEN_ID"}]},
        ],
        "metrics": [{"name": "per_draw", "expr": "calls.reportable / specimens.specimen_count"}],
    }
    query = SemanticQuery(from_dict(spec), tiny.tables())
    assert query.verify() == []
    got = query.run(["lab_site"], ["per_draw", "median_vaf_pct"], round_pct=2)
    assert rows(got) == [("N", 2.0, 12.0), ("S", 0.5, 5.0), ("W", 1.0, 8.0)]


def test_verify_reads_schemas_only(layer, cohort):
    assert semantic(cohort).verify() == []
    # The hand-made calls lack the line number of the mapped key, nothing else.
    assert layer.verify() == []
    (table, *rest) = layer.model.tables
    broken = replace(table, fields=(*table.fields, replace(table.fields[0], name="bad", expr="no_such")))
    problems = SemanticQuery(replace(layer.model, tables=(broken, *rest)), layer._tables).verify()
    assert len(problems) == 1 and "patients.bad" in problems[0]


def test_bad_specifications():
    base = {"name": "t", "base_table": "t", "primary_key": {"columns": ["k"]}}
    for metric in ({"name": "m"}, {"name": "m", "kind": "odd"}, {"name": "m", "kind": "rows", "expr": "x"}):
        with pytest.raises(ModelError):
            from_dict({"name": "m", "tables": [{**base, "metrics": [metric]}]})
    with pytest.raises(ModelError):
        from_dict({"name": "m", "tables": [base], "metrics": [{"name": "d", "expr": "a + b"}]})


def test_verified_queries_and_description(spark, layer):
    got = [tuple(r) for r in layer.verified("actionable_patients_by_cancer_type").collect()]
    assert got == [("Lung", 2, 4)]
    burden = [tuple(r) for r in layer.verified("burden_by_gene").collect()]
    assert [r[0] for r in burden] == ["G1", "G2"]
    described = layer.describe(spark)
    kinds = {r.kind for r in described.select("kind").distinct().collect()}
    assert kinds == {"dimension", "time", "fact", "metric", "relationship", "derived"}
    assert described.filter("name = 'f_is_pass' AND NOT public").count() == 1


def test_key_check_reports_repeats(spark, layer):
    doubled = dict(layer._tables)
    doubled["panel"] = doubled["panel"].unionAll(doubled["panel"].limit(1))
    assert rows(SemanticQuery(layer.model, doubled).key_check("panel")) == [("panel", 4, 1, 0)]


def test_parity_shows_differences(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert rows(parity(a, b, ["k", "v"])) == [(1, "x", 2, 1), (2, None, 1, 1), (3, "y", 0, 1)]


def test_export_round_trip():
    import yaml

    from cohortry.semantic.model import cohort_model, from_dict, to_yaml

    model = cohort_model()
    assert from_dict(yaml.safe_load(to_yaml(model))) == model


def test_additive_metrics_reach_the_join_grouped(spark):
    """Calls are counted by draw before draws are joined."""
    from cohortry.plans.queries import semantic
    from cohortry.sources.tables import mapped

    layer = semantic(mapped(spark, "/root/testdata/sf0.001"))
    plan = layer.run(["specimens.lab_site"], ["calls.reportable_calls"])._jdf.queryExecution().optimizedPlan().toString()
    lines = [x.strip(" +-:") for x in plan.split("\n")]
    join = next(i for i, x in enumerate(lines) if x.startswith("Join"))
    assert any(x.startswith("Aggregate") for x in lines[join + 1 :])
