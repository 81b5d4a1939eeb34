"""The registered queries of this subpackage: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm.chat_format import op13_chat_formatting
from cohortry.llm.decontamination import op2_benchmark_decontamination
from cohortry.llm.fingerprints import op4_document_fingerprints
from cohortry.llm.html_text import op1_html_extraction
from cohortry.llm.language import op8_language_id
from cohortry.llm.mixing import op6_mixing
from cohortry.llm.near_dedup import op7_minhash_near_dedup
from cohortry.llm.oracle import ORACLE
from cohortry.llm.resampling import op12_importance_resampling
from cohortry.llm.secret_scan import op5_secret_scans
from cohortry.llm.sharding import op9_sharding
from cohortry.llm.substring_dedup import op10_substring_dedup
from cohortry.llm.toxicity import op3_toxicity
from cohortry.llm.whitening import op11_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_html_extraction,
        op2_benchmark_decontamination,
        op3_toxicity,
        op4_document_fingerprints,
        op5_secret_scans,
        op6_mixing,
        op7_minhash_near_dedup,
        op8_language_id,
        op9_sharding,
        op10_substring_dedup,
        op11_embedding_whitening,
        op12_importance_resampling,
        op13_chat_formatting,
    )
}

__all__ = ["ORACLE", "QUERIES"]
