"""Reference tables written down in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What each outcome of the call filter means.
FILTER_REASONS = (
    ("PASS", "above every floor", True),
    ("low_mapq", "mapping quality below its floor", False),
    ("low_depth", "read depth below its floor", False),
    ("low_vaf", "allele fraction below its floor", False),
    ("low_alt_reads", "too few supporting reads", False),
)


def filter_reasons(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(FILTER_REASONS), "call_filter string, reason string, is_reportable boolean"
    )
