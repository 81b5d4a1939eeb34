"""Every registered query: (spark, folder of the tables) -> DataFrame.

All of them read the given tables in full. Limits occur only where the limit
is the feature: top-k reports, the numbered pick and the samples.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions import hashing as h
from cohortry.functions import ladders, scalars
from cohortry.functions.scalars import exact_round, percent_share
from cohortry.functions.scoring import confidence, register_confidence, register_confidence_sql
from cohortry.models import native, training
from cohortry.models.metrics import auc_by_rank, confusion_rates
from cohortry.models.registry import ModelRegistry, signature_of
from cohortry.operators import grouping as g
from cohortry.operators import ranking, relational, sampling
from cohortry.operators import text as tx
from cohortry.operators.relational import with_panel
from cohortry.plans import workloads as w
from cohortry.semantic.model import cohort_model
from cohortry.semantic.query import SemanticQuery
from cohortry.session import apply_defaults, checkpointed, shared_folder
from cohortry.sources import sinks
from cohortry.sources.literals import filter_reasons
from cohortry.sources.schemas import MAPPED_CALLS
from cohortry.sources.tables import Cohort, mapped, parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Callable[[Cohort], DataFrame]) -> Callable[[Cohort], DataFrame]:
    """Register a function of the cohort under its own name."""

    def call(spark: SparkSession, folder: str) -> DataFrame:
        return run(mapped(apply_defaults(spark), folder))

    QUERIES[run.__name__] = call
    return run


def table_query(run: Query) -> Query:
    """Register a function that reads a table outside the cohort."""
    QUERIES[run.__name__] = lambda spark, folder: run(apply_defaults(spark), folder)
    return run


# -- sources and sinks -------------------------------------------------------


@query
def scan_profile(c: Cohort) -> DataFrame:
    return w.table_profile(c)


@query
def sql_source(c: Cohort) -> DataFrame:
    c.register_views("src_")
    return c.spark.sql(
        """
        SELECT p.gene_symbol, count(*) AS calls, max(v.vaf) AS max_vaf
        FROM src_calls v JOIN src_panel p ON p.gene_id = v.gene_id
        WHERE p.is_actionable
        GROUP BY p.gene_symbol
        """
    )


@query
def sql_bound_params(c: Cohort) -> DataFrame:
    c.register_views("bound_")
    return c.spark.sql(
        """
        SELECT lab_site, count(*) AS draws
        FROM bound_specimens
        WHERE qc_status = :status AND collection_date >= :since
        GROUP BY lab_site
        """,
        args={"status": "PASS", "since": date(1997, 1, 1)},
    )


@query
def sequence_rows(c: Cohort) -> DataFrame:
    """One generated row per month from the first to the last draw, with its draws."""
    month = F.trunc("collection_date", "month")
    counts = c.specimens.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("draws"))
    span = counts.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    months = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month"))
    return months.join(counts, "month", "left").select(
        "month", F.coalesce("draws", F.lit(0)).alias("draws")
    )


@query
def inline_reference_join(c: Cohort) -> DataFrame:
    calls = relational.labelled_calls(c.calls, c.ladder)
    counts = calls.groupBy("call_filter").agg(F.count(F.lit(1)).alias("calls"))
    return counts.join(filter_reasons(c.spark), "call_filter")


@query
def typed_load(c: Cohort) -> DataFrame:
    calls = relational.labelled_calls(c.calls, c.ladder)
    loaded = sinks.typed_load(calls, MAPPED_CALLS, shared_folder(c.spark, "typed"))
    doubles = ["vaf", "read_depth", "mapping_quality"]
    wide = ["line_number", "alt_read_count"]
    return loaded.withColumns(
        {d: F.col(d).cast("double") for d in doubles} | {i: F.col(i).cast("bigint") for i in wide}
    )


@query
def clustered_write_scan(c: Cohort) -> DataFrame:
    stored = sinks.write_clustered(
        c.calls, shared_folder(c.spark, "clustered"), ["variant_type", "gene_id"], c.call_key
    )
    hit = stored.filter((F.col("variant_type") == "F") & F.col("gene_id").between(100, 499))
    return hit.groupBy("gene_id").agg(F.count(F.lit(1)).alias("calls"), F.max("vaf").alias("max_vaf"))


@query
def actionable_cohort(c: Cohort) -> DataFrame:
    return w.actionable_cohort(c)


@query
def cohort_writeback(c: Cohort) -> DataFrame:
    stored = sinks.write_back(w.actionable_cohort(c), shared_folder(c.spark, "cohort"))
    return stored.groupBy("primary_cancer_type").agg(F.count(F.lit(1)).alias("calls"))


@query
def repeated_load(c: Cohort) -> DataFrame:
    """Calls loaded in two parts, the first one twice: every call counts once."""
    calls, path = relational.labelled_calls(c.calls, c.ladder), shared_folder(c.spark, "loads")
    for state in ("F", "O", "F"):
        loaded = sinks.load_part(calls.filter(F.col("variant_type") == state), MAPPED_CALLS, path, state)
    return loaded.groupBy("load_id").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("call_filter") == "PASS").alias("passing"),
        F.max("vaf").cast("double").alias("max_vaf"),
    )


@query
def replaced_table(c: Cohort) -> DataFrame:
    """A table under a name, rewritten from itself without its failed draws."""
    sinks.replace_table(c.specimens, "draws_now")
    kept = sinks.replace_table(c.spark.table("draws_now").filter("qc_status = 'PASS'"), "draws_now")
    return kept.groupBy("lab_site").agg(F.count(F.lit(1)).alias("draws"))


@query
def reportable_bucketed(c: Cohort) -> DataFrame:
    """The reportable view over calls that are stored in buckets of their draw."""
    return relational.reportable_view(replace(c, calls=sinks.save_bucketed(c.calls, "calls_by_draw", "specimen_id")))


@query
def pruned_join(c: Cohort) -> DataFrame:
    """Calls of actionable genes per brand, from a layout that the panel's filter prunes."""
    brands = c.panel.select("gene_id", F.col("gene_symbol").alias("brand"))
    stored = sinks.write_pruned(c.calls.join(brands, "gene_id"), shared_folder(c.spark, "by-brand"), "brand")
    wanted = c.panel.filter(F.col("is_actionable") & (F.col("chromosome") == "chr7"))
    wanted = wanted.select(F.col("gene_symbol").alias("brand"), "targeted_therapy").distinct()
    few = wanted.groupBy("brand").agg(F.count(F.lit(1)).alias("therapies")).filter("therapies > 1")
    return stored.join(few, "brand").groupBy("brand").agg(F.count(F.lit(1)).alias("calls"), F.max("vaf").alias("max_vaf"))


@query
def load_checks(c: Cohort) -> DataFrame:
    return w.load_checks(c)


# -- filters, ladders, joins -------------------------------------------------


@query
def pass_filter_count(c: Cohort) -> DataFrame:
    passing = relational.passing_calls(c.calls, c.ladder)
    return passing.agg(F.count(F.lit(1)).alias("pass_calls"))


@query
def segment_in_list(c: Cohort) -> DataFrame:
    chosen = c.patients.filter(F.col("primary_cancer_type").isin("BUILDING", "MACHINERY"))
    draws = relational.draws_with_patients(c.specimens, chosen)
    return draws.groupBy("primary_cancer_type").agg(F.count(F.lit(1)).alias("draws"))


@query
def first_document(c: Cohort) -> DataFrame:
    first = c.reports.agg(F.min("report_id")).scalar()
    return c.reports.filter(F.col("report_id") == first).select("report_id", "report_text")


@query
def call_filter_ladder(c: Cohort) -> DataFrame:
    return relational.labelled_calls(c.calls, c.ladder).select(*c.call_key, "call_filter")


@query
def significance_ladder(c: Cohort) -> DataFrame:
    calls = relational.with_panel(c.calls, c.panel)
    return calls.select(
        *c.call_key, relational.clinical_significance(c, calls).alias("clinical_significance")
    )


@query
def qc_ladder(c: Cohort) -> DataFrame:
    status = ladders.qc_status(_rank_share(), F.col("tumor_fraction"), 30000.0)
    return c.specimens.select("specimen_id", status.alias("qc_status"))


def _rank_share() -> Column:
    """Where a draw's date stands within its month, 0 to 1."""
    return (F.dayofmonth("collection_date") - 1) / F.lit(31.0)


# Cumulative shares of the variant types.
TYPE_SHARES = [(0.86, "SNV"), (0.94, "INSERTION"), (0.99, "DELETION")]
STAGES = ["IV", "IV", "IV", "III", "III", "II", "I"]


@query
def weighted_category(c: Cohort) -> DataFrame:
    """Categories by where measured values stand in their range."""
    return c.calls.select(
        *c.call_key,
        h.share_pick(TYPE_SHARES, "MNV", F.col("alt_read_count") / 51).alias("depth_type"),
        h.weighted_pick(STAGES, F.col("mapping_quality") / 0.09).alias("quality_stage"),
    )


@query
def skewed_dim_lookup(c: Cohort) -> DataFrame:
    """Calls land on a computed gene: the one that starts their hundred. All calls stay."""
    index = F.col("gene_id") - (F.col("gene_id") - 1) % 100
    hits = c.calls.groupBy(index.alias("gene_id")).agg(F.count(F.lit(1)).alias("n"))
    looked_up = hits.join(c.panel.select("gene_id", "gene_symbol"), "gene_id", "left")
    return looked_up.groupBy("gene_symbol").agg(F.sum("n").alias("calls"))


@query
def reportable_view(c: Cohort) -> DataFrame:
    return relational.reportable_view(c)


@query
def calls_by_gene_assay(c: Cohort) -> DataFrame:
    return w.calls_by_gene_and_assay(c)


@query
def top_call_per_specimen(c: Cohort) -> DataFrame:
    best = w.top_calls(c, relational.passing_calls(c.calls, c.ladder))
    return best.select(*c.call_key, "vaf", "consequence")


@query
def restrict_to_picked(c: Cohort) -> DataFrame:
    """Calls of draws whose patient has an early stage."""
    early = c.patients.filter(F.col("stage_at_diagnosis") < 5)
    picked = relational.restrict_to(c.specimens, early, ["patient_id"])
    calls = relational.restrict_to(c.calls, picked, ["specimen_id"])
    return calls.select(*c.call_key, "vaf")


# -- aggregation and windows -------------------------------------------------


@query
def filter_share(c: Cohort) -> DataFrame:
    return w.filter_breakdown(c)


@query
def gene_burden(c: Cohort) -> DataFrame:
    return w.gene_burden(c)


@query
def actionable_by_segment(c: Cohort) -> DataFrame:
    return w.actionable_by_segment(c)


@query
def gene_stats(c: Cohort) -> DataFrame:
    return w.gene_stats(c)


@query
def tumor_fraction_median(c: Cohort) -> DataFrame:
    """Median of a measure with unlimited values, from counts in ranges that narrow."""
    draws = relational.draws_with_patients(c.specimens, c.patients)
    medians = ranking.median_by_ranges(draws, ["primary_cancer_type"], "tumor_fraction")
    return medians.select("primary_cancer_type", exact_round(F.col("median"), 3).alias("median"))


@query
def qc_pass_rate(c: Cohort) -> DataFrame:
    rates = g.group_stats(c.specimens, ["lab_site"], [g.rate("rate", F.col("qc_status") == "PASS")])
    return rates.select("lab_site", exact_round(F.col("rate"), 2).alias("qc_pass_rate_pct"))


@query
def pass_rate(c: Cohort) -> DataFrame:
    calls = relational.labelled_calls(c.calls, c.ladder)
    rates = g.group_stats(
        calls, ["consequence"], [g.rate("rate", F.col("call_filter") == c.ladder.otherwise)]
    )
    return rates.select("consequence", exact_round(F.col("rate"), 2).alias("pass_rate_pct"))


@query
def vaf_trajectory(c: Cohort) -> DataFrame:
    return w.vaf_trajectory(c)


@query
def rising_by_gene(c: Cohort) -> DataFrame:
    return w.rising_by_gene(c)


@query
def numbered_pick(c: Cohort) -> DataFrame:
    passing = relational.passing_specimens(c.specimens).select("specimen_id", "patient_id")
    return ranking.first_numbered(passing, ["specimen_id"], 2000)


@query
def numbered_draws(c: Cohort) -> DataFrame:
    """All passing draws numbered, without a limit and without a single task."""
    passing = relational.passing_specimens(c.specimens).select("specimen_id", "patient_id")
    return ranking.number_rows(passing, ["specimen_id"])


# -- sampling ----------------------------------------------------------------


@query
def hash_sample(c: Cohort) -> DataFrame:
    drawn = sampling.sample_rows(c.calls, 20_000, c.call_key, c.call_order)
    return relational.passing_calls(drawn, c.ladder).select(*c.call_key, "vaf")


@query
def hash_uniform(c: Cohort) -> DataFrame:
    """Draws per quarter of the key hash under two salts; independent salts fill all sixteen cells."""
    return c.specimens.groupBy(
        h.bucket_index(h.key_uniform("specimen_id", salt=1), 4).alias("one"),
        h.bucket_index(h.key_uniform("specimen_id", salt=2), 4).alias("other"),
    ).agg(F.count(F.lit(1)).alias("draws"))


@query
def bucket_index(c: Cohort) -> DataFrame:
    """Calls per bucket of the mapping quality, even and favouring low values."""
    share = F.col("mapping_quality") / 0.09
    buckets = c.calls.select(
        h.bucket_index(share, 17, power=1.7).alias("skewed"), h.bucket_index(share, 7).alias("even")
    )
    return buckets.groupBy("skewed", "even").agg(F.count(F.lit(1)).alias("calls"))


# -- scalar functions --------------------------------------------------------


@query
def fn_math(c: Cohort) -> DataFrame:
    vaf = F.col("vaf")
    return c.calls.select(
        *c.call_key,
        exact_round(vaf * 100, 1).alias("vaf_pct"),
        exact_round(F.pow(vaf, 3) * 0.48 + 0.0002, 5).alias("cubed"),
        exact_round(F.pow(vaf, 1.7), 6).alias("shaped"),
        F.floor(F.col("read_depth") / 1000).cast("bigint").alias("depth_bucket"),
        exact_round(F.greatest(F.lit(1.0), F.col("alt_read_count") * vaf), 0).alias("alt_floor"),
        F.least(F.col("alt_read_count"), F.lit(25.0)).alias("alt_cap"),
        exact_round(
            (F.col("read_depth") - F.col("alt_read_count")) / F.col("alt_read_count"), 4
        ).alias("per_alt"),
    )


@query
def fn_string(c: Cohort) -> DataFrame:
    name = F.concat(F.lower("gene_symbol"), F.lit("_"), F.lower("targeted_therapy"))
    return c.panel.select(
        scalars.padded_id("GENE-", F.col("gene_id"), 9).alias("gene_label"),
        F.lower("gene_symbol").alias("lowered"),
        F.replace(name, F.lit("_"), F.lit(" ")).alias("spaced"),
        F.length("gene_symbol").cast("bigint").alias("symbol_length"),
        scalars.plain_number(F.col("gene_id").cast("decimal(20,2)") / 4).alias("quarter"),
    )


@query
def fn_date(c: Cohort) -> DataFrame:
    as_of = date(2002, 1, 1)
    draws = relational.draws_with_patients(c.specimens, c.patients)
    day = F.col("collection_date")
    return draws.select(
        "specimen_id",
        scalars.long_date(day).alias("collected"),
        (F.year(day) - F.col("birth_year")).cast("bigint").alias("age"),
        F.date_add(day, 14).alias("due"),
        scalars.days_between(day, scalars.today(as_of)).alias("days_ago"),
    )


@table_query
def json_path(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.parse_json("props")
    path = F.try_variant_get(parsed, "$.k", "bigint")
    labels = F.array(F.lit("low"), F.lit("mid"), F.lit("high"))
    detail = F.struct(path.alias("k"), F.get(labels, (path / 34).cast("int")).alias("level"))
    picked = parquet(spark, folder, "events").select("event_id", detail.alias("detail"))
    return picked.select("event_id", "detail.k", "detail.level")


@query
def udf_by_name(c: Cohort) -> DataFrame:
    register_confidence(c.spark, "cohort_confidence", c.caps, digits=None)
    calls = relational.with_panel(c.calls, c.panel)
    score = F.call_udf("cohort_confidence", *[F.col(x) for x in w.FEATURES], F.col("is_actionable"))
    scored = calls.select("gene_symbol", exact_round(score, 2).alias("confidence"))
    peak = scored.groupBy("gene_symbol").agg(F.max("confidence").alias("max_confidence"))
    return peak.select(
        F.call_function("lower", F.col("gene_symbol")).alias("gene"), "max_confidence"
    )


# -- scoring -----------------------------------------------------------------


@query
def confidence_score(c: Cohort) -> DataFrame:
    calls = relational.with_panel(c.calls, c.panel)
    return calls.select(*c.call_key, confidence(c.caps).alias("confidence"))


@query
def confidence_score_udf(c: Cohort) -> DataFrame:
    register_confidence(c.spark, "cohort_confidence", c.caps, digits=None)
    calls = relational.with_panel(c.calls, c.panel)
    score = F.call_udf("cohort_confidence", *[F.col(x) for x in w.FEATURES], F.col("is_actionable"))
    return calls.select(*c.call_key, exact_round(score, 2).alias("confidence"))


@query
def top_confidence(c: Cohort) -> DataFrame:
    """The registered score called from SQL text over the named reportable view."""
    register_confidence(c.spark, "cohort_confidence", c.caps, digits=None)
    call = f"cohort_confidence({', '.join(w.FEATURES)}, is_actionable)"
    return _most_trusted(c, f"CAST(round(CAST({call} AS DECIMAL(38, 10)), 2) AS DOUBLE)")


@query
def top_confidence_sql(c: Cohort) -> DataFrame:
    """The same rows from a score that is defined in SQL and needs no Python worker."""
    register_confidence_sql(c.spark, "cohort_confidence_sql", c.caps)
    return _most_trusted(c, f"cohort_confidence_sql({', '.join(w.FEATURES)}, is_actionable)")


def _most_trusted(c: Cohort, score: str) -> DataFrame:
    relational.register_reportable(c, "reportable_calls")
    order = ", ".join(c.call_order)
    return c.spark.sql(
        f"""
        SELECT {", ".join(c.call_key)}, gene_symbol, round(CAST(vaf * 100 AS DECIMAL(38, 10)), 3) AS vaf_raw,
               read_depth, alt_read_count, clinical_significance, {score} AS confidence
        FROM reportable_calls WHERE is_actionable
        ORDER BY confidence DESC NULLS LAST, {order} LIMIT 20
        """
    ).withColumn("vaf_pct", F.col("vaf_raw").cast("double")).drop("vaf_raw")


# -- text --------------------------------------------------------------------

# Fields looked for and the words that tell the labels apart.
FIELDS = {
    "email": (r"([A-Za-z0-9_.]+@[A-Za-z0-9.]+[a-z])", "string", "@"),
    "phone": (r"([0-9]{3}-[0-9]{4})", "string", "-"),
    "licensed": (r"([Ll]icense)", "string", "icense"),
    "first_number": (r"([0-9]+)", "bigint"),
    "opening": (r"^([^.!?\r\n]+)", "string"),
}
LABELS = {
    "english": ["the", "and", "of"],
    "german": ["der", "und", "die"],
    "french": ["le", "les", "du"],
    "spanish": ["el", "los", "del"],
}


@query
def corpus_profile(c: Cohort) -> DataFrame:
    return c.reports.select(
        "report_id", "specimen_id", "cohort", "pathologist",
        F.length("report_text").cast("bigint").alias("chars"),
    )


@query
def text_extract(c: Cohort) -> DataFrame:
    found = c.reports.select("report_id", tx.extract(F.col("report_text"), FIELDS).alias("e"))
    return found.select("report_id", "e.*")


@query
def text_extract_join(c: Cohort) -> DataFrame:
    found = c.reports.select(
        "report_id", "specimen_id", tx.extract(F.col("report_text"), FIELDS).alias("e")
    )
    draws = relational.draws_with_patients(c.specimens, c.patients)
    return found.join(draws, "specimen_id").select(
        "report_id",
        "specimen_id",
        F.lower("e.opening").alias("opening"),
        F.col("e.first_number").alias("first_number"),
        "primary_cancer_type",
        "tumor_fraction",
    )


@table_query
def text_extract_labels(spark: SparkSession, folder: str) -> DataFrame:
    """How often extracted fields occur in labelled reports, by quality."""
    c = mapped(spark, folder)
    found = c.reports.select("report_id", tx.extract(F.col("report_text"), FIELDS).alias("e"))
    labels = parquet(spark, folder, "labels").withColumnRenamed("doc_id", "report_id")
    return (
        found.join(labels, "report_id")
        .groupBy(F.col("quality").cast("bigint").alias("quality"))
        .agg(
            F.count(F.lit(1)).alias("reports"),
            F.count("e.email").alias("with_email"),
            F.count("e.phone").alias("with_phone"),
            F.count("e.licensed").alias("with_license"),
            F.count("e.first_number").alias("with_number"),
        )
    )


@query
def text_classify(c: Cohort) -> DataFrame:
    label = tx.classify_words(F.col("report_text"), LABELS, otherwise="unknown")
    return c.reports.select("report_id", label.alias("label"))


@query
def text_class_share(c: Cohort) -> DataFrame:
    labelled = c.reports.select(
        tx.classify_words(F.col("report_text"), LABELS, otherwise="unknown").alias("label")
    )
    return g.counts_with_share(labelled, ["label"], "reports", "pct", 1)


@query
def text_completion(c: Cohort) -> DataFrame:
    """The batch completion operator with a function that can be checked: the longest word."""

    def make():
        return lambda prompts: [max(p.split(), key=lambda w: (len(w), w), default="") for p in prompts]

    wanted = c.reports.select("report_id", "report_text")
    return tx.complete(wanted, "report_text", "", make, "answer", max_words=3).select("report_id", "answer")


@query
def text_summary(c: Cohort) -> DataFrame:
    return c.reports.select("report_id", tx.first_words(F.col("report_text"), 20).alias("summary"))


@query
def text_themes(c: Cohort) -> DataFrame:
    return tx.themes(c.reports, "cohort", "report_text")


@query
def report_assembly(c: Cohort) -> DataFrame:
    return w.assembled_reports(c)


# -- models ------------------------------------------------------------------

LABEL = "is_pathogenic"


@query
def training_frame(c: Cohort) -> DataFrame:
    return w.training_frame(c)


def _drawn(c: Cohort) -> DataFrame:
    """The training frame, drawn once: at most 50,000 rows that are read often."""
    return checkpointed(w.training_frame(c))


@query
def stratified_split(c: Cohort) -> DataFrame:
    split = sampling.stratified_split(
        _drawn(c), LABEL, 0.25, c.call_key, tie_break=w.FEATURES, salt=w.SPLIT_SALT
    )
    return split.select(*c.call_key, LABEL, "is_test")


@query
def class_weights(c: Cohort) -> DataFrame:
    weights = sampling.class_weights(_drawn(c), LABEL)
    return weights.select(LABEL, exact_round(F.col("weight"), 6).alias("weight"))


def _fixed_score(c: Cohort) -> DataFrame:
    """Every passing call with a score that needs no training: the confidence without the panel bonus."""
    score = confidence(c.caps, actionable=F.lit(False))
    calls = relational.with_panel(relational.passing_calls(c.calls, c.ladder), c.panel)
    positive = relational.clinical_significance(c, calls) == "Pathogenic"
    return calls.select(score.alias("score"), F.when(positive, 1).otherwise(0).cast("bigint").alias(LABEL))


@query
def auc_by_rank_(c: Cohort) -> DataFrame:
    return auc_by_rank(_fixed_score(c), "score", LABEL).select(
        exact_round(F.col("roc_auc"), 6).alias("roc_auc")
    )


QUERIES["auc_by_rank"] = QUERIES.pop("auc_by_rank_")


@query
def confusion_rates_(c: Cohort) -> DataFrame:
    rates = confusion_rates(_fixed_score(c), F.col("score") >= 60, LABEL)
    return rates.select(
        "n_rows",
        *[
            exact_round(F.col(r), 6).alias(r)
            for r in ("recall", "predicted_positive_rate", "base_rate")
        ],
    )


QUERIES["confusion_rates"] = QUERIES.pop("confusion_rates_")


def _fit(c: Cohort, pipeline) -> training.Trained:
    return training.train(
        w.training_frame(c), pipeline, LABEL, c.call_key, tie_break=w.FEATURES, salt=w.SPLIT_SALT
    )


def _holdout(c: Cohort, pipeline) -> DataFrame:
    scored = _fit(c, pipeline).holdout
    return scored.select(
        *c.call_key, LABEL, "score", F.col("prediction").cast("bigint").alias("prediction")
    )


@query
def lr_scores(c: Cohort) -> DataFrame:
    return _holdout(c, training.logistic(w.FEATURES, LABEL))


@query
def rf_scores(c: Cohort) -> DataFrame:
    return _holdout(c, training.forest(w.FEATURES, LABEL))


@query
def gbt_scores(c: Cohort) -> DataFrame:
    return _holdout(c, training.boosted(w.FEATURES, LABEL))


def _registry_with_model(c: Cohort) -> ModelRegistry:
    """A registry that holds the given model; its AUC is that of all passing calls."""
    registry = ModelRegistry(c.spark, shared_folder(c.spark, "registry"))
    model = training.given_logistic(c.spark, w.FEATURES, w.GIVEN_COEFFICIENTS, w.GIVEN_INTERCEPT)
    calls = with_panel(relational.passing_calls(c.calls, c.ladder), c.panel)
    labelled = calls.withColumn(
        LABEL, (relational.clinical_significance(c, calls) == "Pathogenic").cast("bigint")
    )
    signature = signature_of(labelled, w.FEATURES)
    # Rounded, so that equal scores stay equal in every engine.
    judged = training.with_probability(model.transform(labelled)).withColumn("score", exact_round(F.col("score"), 9))
    auc = auc_by_rank(judged, "score", LABEL).first()[0]
    registry.register("calls_clf", "V1", model, signature, {"roc_auc": auc}, "logistic regression")
    return registry


@query
def model_versions(c: Cohort) -> DataFrame:
    """Register, copy a saved model in as a second version, make it the default."""
    registry = _registry_with_model(c)
    first = registry.versions("calls_clf").first()
    signature = [(f["feature"], f["type"]) for f in first["signature"]]
    registry.register_saved(
        "calls_clf", "V2", first["path"], signature, metrics=first["metrics"], comment="copy of V1"
    )
    registry.set_default("calls_clf", "V2")
    shown = registry.versions("calls_clf")
    return shown.select(
        "name", "version", F.size("signature").cast("bigint").alias("n_features"),
        exact_round(F.col("metrics")["roc_auc"], 4).alias("roc_auc"), "comment", "is_default",
    )


@query
def model_score(c: Cohort) -> DataFrame:
    """All passing calls scored from SQL text by the name of a registered version."""
    _registry_with_model(c).register_function("calls_clf_v1", "calls_clf", "V1")
    relational.passing_calls(c.calls, c.ladder).createOrReplaceTempView("calls_to_score")
    features = ", ".join(w.FEATURES)
    scored = c.spark.sql(
        f"SELECT {', '.join(c.call_key)}, {features}, calls_clf_v1({features}) AS score FROM calls_to_score"
    )
    flagged = scored.withColumn("prediction", (F.col("score") > 0.5).cast("bigint"))
    return flagged.withColumn("score", exact_round(F.col("score"), 6))


@query
def model_flag_rate(c: Cohort) -> DataFrame:
    """Share of a sample of passing calls that the default model flags."""
    _registry_with_model(c).register_function("calls_clf_default", "calls_clf")
    drawn = sampling.sample_rows(c.calls, 20_000, c.call_key, c.call_order, salt=w.FLAG_SALT)
    calls = relational.passing_calls(drawn, c.ladder)
    return native.scored(calls.select(*w.FEATURES), "calls_clf_default", w.FEATURES).agg(
        F.count(F.lit(1)).alias("scored"),
        percent_share(F.sum("prediction"), F.count(F.lit(1)), 1).alias("pct_flagged"),
    )


# -- semantic layer ----------------------------------------------------------


def semantic(c: Cohort) -> SemanticQuery:
    tables = c.tables() | {"calls": relational.labelled_calls(c.calls, c.ladder)}
    return SemanticQuery(cohort_model(), tables)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            exact_round(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() in ("double", "decimal") else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@query
def sv_key_check(c: Cohort) -> DataFrame:
    layer = semantic(c)
    checks = [layer.key_check(t) for t in ("patients", "specimens", "panel", "calls")]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


@query
def sv_actionable(c: Cohort) -> DataFrame:
    return semantic(c).verified("actionable_patients_by_cancer_type")


@query
def sv_burden(c: Cohort) -> DataFrame:
    return _rounded(semantic(c).verified("burden_by_gene"))


@query
def sv_yield(c: Cohort) -> DataFrame:
    return _rounded(semantic(c).verified("yield_by_site"))


@query
def sv_panel_size(c: Cohort) -> DataFrame:
    return semantic(c).run(["panel.is_actionable"], ["panel.genes_on_panel"])


@query
def sv_call_metrics(c: Cohort) -> DataFrame:
    metrics = [
        "total_calls", "reportable_calls", "pass_rate_pct", "median_vaf_pct", "max_vaf_pct",
        "avg_read_depth", "genes_altered",
    ]
    return _rounded(semantic(c).run(["patients.cancer_type"], [f"calls.{m}" for m in metrics]))


@query
def sv_monthly_yield(c: Cohort) -> DataFrame:
    return _rounded(
        semantic(c).run(
            ["specimens.collection_month"],
            ["specimens.specimen_count", "calls.reportable_calls", "reportable_calls_per_specimen"],
        )
    )


@query
def sv_defaults(c: Cohort) -> DataFrame:
    """The same question under the default restriction, percentages rounded."""
    return semantic(c).run(
        ["specimens.lab_site"],
        ["calls.total_calls", "calls.median_vaf_pct", "specimens.specimen_count"],
        default_filters=True,
        round_pct=2,
    )


@query
def sv_synonyms(c: Cohort) -> DataFrame:
    """A request that uses synonyms only."""
    return semantic(c).run(["disease"], ["number of patients", "call volume"], ["actionable"])


@query
def sv_significance(c: Cohort) -> DataFrame:
    """Calls by their significance, a dimension worked out from the call and its gene."""
    return semantic(c).run(
        ["significance", "calls.called_chromosome"], ["total_calls", "reportable_calls", "genes_altered"],
        [("calls.called_chromosome", ["chr7", "chr9"])],
    )


@query
def sv_pathogenic_patients(c: Cohort) -> DataFrame:
    """Patients with a pathogenic call, by cancer type."""
    return semantic(c).run(["cancer_type"], ["patient_count"], [("calls.clinical_significance", "Pathogenic")])


@query
def sv_tumor_fraction_pct(c: Cohort) -> DataFrame:
    return _rounded(
        semantic(c).run(["specimens.lab_site"], ["specimens.avg_tumor_fraction_pct", "specimens.specimen_count"])
    )


def _deployed(c: Cohort) -> SemanticQuery:
    """The same model over catalog views of the tables: a second place where it runs."""
    layer = semantic(c)
    names = ["calls", "specimens", "patients", "panel"]
    for name in names:
        layer.base(name).createOrReplaceTempView(f"deployed_{name}")
    return SemanticQuery(layer.model, {n: c.spark.table(f"deployed_{n}") for n in names})


@query
def sv_parity(c: Cohort) -> DataFrame:
    """A metric of the same model in two deployments, side by side."""
    ask = (["specimens.lab_site"], ["reportable_calls_per_specimen"])
    here, there = semantic(c).run(*ask), _deployed(c).run(*ask)
    return w.parity(_rounded(here), _rounded(there), ["lab_site", "reportable_calls_per_specimen"])


@query
def sv_table_parity(c: Cohort) -> DataFrame:
    """Whole tables of two deployments compared by digests per bucket of their keys."""
    here, there = semantic(c), _deployed(c)
    each = [
        w.compared(here.base(t.name), there.base(t.name), t.primary_key, t.name) for t in here.model.tables
    ]
    return reduce(DataFrame.unionByName, each)


@query
def sv_describe(c: Cohort) -> DataFrame:
    """The model, with the number of rows that fill each of its fields."""
    layer = semantic(c)
    described = layer.describe(c.spark)
    return ranking.null_safe_join(described, layer.filled(), ["table_name", "name"], "left")
