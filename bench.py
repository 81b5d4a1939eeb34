"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_SHARED_DIR  folder for checkpoints (default a new temporary one; the bench runs on one machine)
BENCH_REPEAT  runs per query, the best one counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortry.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "scan_profile", "filter_share", "gene_burden", "gene_stats", "actionable_by_segment",
    "calls_by_gene_assay", "reportable_view", "actionable_cohort", "cohort_writeback",
    "clustered_write_scan", "typed_load", "top_call_per_specimen", "vaf_trajectory",
    "rising_by_gene", "numbered_draws", "tumor_fraction_median", "confidence_score",
    "confidence_score_udf", "top_confidence", "top_confidence_sql", "hash_sample", "training_frame",
    "stratified_split", "auc_by_rank", "lr_scores", "text_extract", "text_classify",
    "text_themes", "report_assembly", "sv_actionable", "sv_burden", "sv_yield",
    "sv_call_metrics", "sv_significance", "rf_scores", "gbt_scores", "model_score", "model_flag_rate",
)
# Trainings take long and vary little; they run once.
ONCE = {"lr_scores", "rf_scores", "gbt_scores", "model_score", "model_flag_rate"}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cohortry-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", f"file:{tempfile.mkdtemp()}"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 if name in ONCE else repeat):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rpartition("sf")[2],
            }
        )
    )


if __name__ == "__main__":
    main()
