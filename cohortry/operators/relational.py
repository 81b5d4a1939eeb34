"""The star join and the restrictions around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions.ladders import FloorLadder, significance
from cohortry.sources.tables import Cohort

PANEL_COLUMNS = ("gene_id", "gene_symbol", "chromosome", "is_actionable", "targeted_therapy")

VIEW_COLUMNS = (
    "specimen_id", "patient_id", "primary_cancer_type", "stage_at_diagnosis", "collection_date",
    "assay", "tumor_fraction", "lab_site", "gene_symbol", "chromosome", "position",
    "variant_type", "consequence", "vaf", "read_depth", "alt_read_count", "mapping_quality",
    "clinical_significance", "is_actionable", "targeted_therapy",
)


def keyed(cohort: Cohort, columns: Sequence[str]) -> list[str]:
    """The key of a call followed by the other columns."""
    return [*cohort.call_key, *[c for c in columns if c not in cohort.call_key]]


def labelled_calls(calls: DataFrame, ladder: FloorLadder) -> DataFrame:
    """Calls with ``call_filter``; a stored one is kept."""
    if "call_filter" in calls.columns:
        return calls
    return calls.withColumn("call_filter", ladder.label())


def passing_calls(calls: DataFrame, ladder: FloorLadder) -> DataFrame:
    """Calls above every floor, by a predicate the scan can use."""
    if "call_filter" in calls.columns:
        return calls.filter(F.col("call_filter") == ladder.otherwise)
    return calls.filter(ladder.clears())


def passing_specimens(specimens: DataFrame) -> DataFrame:
    return specimens.filter(F.col("qc_status") == "PASS")


def with_panel(calls: DataFrame, panel: DataFrame) -> DataFrame:
    """Add panel context. The key keeps one name, so nothing is ambiguous.

    No broadcast is forced: Spark broadcasts the panel as long as its size
    allows, and joins by shuffle when a panel outgrows that.
    """
    stored = [c for c in PANEL_COLUMNS if c in calls.columns and c != "gene_id"]
    return calls.drop(*stored).join(panel.select(*PANEL_COLUMNS), "gene_id")


def clinical_significance(cohort: Cohort, calls: DataFrame) -> Column:
    if "clinical_significance" in calls.columns:
        return F.col("clinical_significance")
    return significance(
        F.col("is_actionable"),
        F.col("vaf"),
        F.col("consequence").isin(*cohort.strong_consequences),
        F.col("consequence").isin(*cohort.weak_consequences),
    )


def draws_with_patients(specimens: DataFrame, patients: DataFrame) -> DataFrame:
    return specimens.join(patients, "patient_id")


def reportable_view(cohort: Cohort) -> DataFrame:
    """Passing calls of passing draws with patient and panel context.

    Draws and patients are joined with each other first, so that the calls,
    the one large table, are shuffled at most once.
    """
    calls = with_panel(passing_calls(cohort.calls, cohort.ladder), cohort.panel)
    draws = draws_with_patients(passing_specimens(cohort.specimens), cohort.patients)
    full = calls.withColumn("clinical_significance", clinical_significance(cohort, calls)).join(
        draws, "specimen_id"
    )
    return full.select(*keyed(cohort, VIEW_COLUMNS))


def register_reportable(cohort: Cohort, name: str = "reportable_calls") -> None:
    """The reportable view as a SQL name of the session."""
    reportable_view(cohort).createOrReplaceTempView(name)


def restrict_to(df: DataFrame, picked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the rows whose keys occur in ``picked``; rows are never multiplied.

    Repeated keys of ``picked`` are removed before they travel.
    """
    return df.join(picked.select(*keys).distinct(), list(keys), "left_semi")


def calls_with_draws(cohort: Cohort, extra: Column | None = None) -> DataFrame:
    """Passing calls joined to passing draws; ``extra`` narrows the calls first."""
    calls = passing_calls(cohort.calls, cohort.ladder)
    if extra is not None:
        calls = calls.filter(extra)
    return calls.join(passing_specimens(cohort.specimens), "specimen_id")
