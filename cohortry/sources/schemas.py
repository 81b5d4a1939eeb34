"""Declared types of the cohort tables."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, TEXT, DATE, FLAG = (
    T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.BooleanType(),
)


def _schema(*columns: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], len(c) > 2 and c[2]) for c in columns])


PANEL = _schema(
    ("gene_idx", INT), ("gene_symbol", TEXT), ("chromosome", TEXT), ("region_start", LONG),
    ("region_length", INT), ("is_actionable", FLAG), ("targeted_therapy", TEXT, True),
)
PATIENTS = _schema(
    ("patient_id", TEXT), ("birth_year", INT), ("sex", TEXT), ("primary_cancer_type", TEXT),
    ("stage_at_diagnosis", TEXT), ("smoking_history", TEXT), ("enrollment_date", DATE),
)
SPECIMENS = _schema(
    ("specimen_id", TEXT), ("patient_id", TEXT), ("collection_date", DATE), ("assay", TEXT),
    ("draw_number", INT), ("tumor_fraction", T.DecimalType(7, 5)),
    ("ctdna_input_ng", T.DecimalType(7, 2)), ("mean_depth", INT), ("qc_status", TEXT),
    ("lab_site", TEXT),
)
CALLS = _schema(
    ("variant_call_id", LONG), ("specimen_id", TEXT), ("gene_symbol", TEXT), ("chromosome", TEXT),
    ("position", LONG), ("ref_allele", TEXT), ("alt_allele", TEXT), ("variant_type", TEXT),
    ("consequence", TEXT), ("vaf", T.DecimalType(7, 5)), ("read_depth", INT),
    ("alt_read_count", INT), ("mapping_quality", INT), ("clinical_significance", TEXT),
    ("call_filter", TEXT),
)
REPORTS = _schema(
    ("report_id", TEXT), ("specimen_id", TEXT), ("patient_id", TEXT), ("report_date", DATE),
    ("pathologist", TEXT), ("report_text", TEXT),
)

# The mapped calls as a typed table: same measures, keys of the test tables.
MAPPED_CALLS = _schema(
    ("specimen_id", LONG), ("line_number", INT), ("gene_id", LONG), ("position", LONG),
    ("variant_type", TEXT), ("consequence", TEXT), ("vaf", T.DecimalType(7, 5)),
    ("read_depth", T.DecimalType(12, 2)), ("alt_read_count", INT),
    ("mapping_quality", T.DecimalType(7, 5)), ("call_filter", TEXT),
)
