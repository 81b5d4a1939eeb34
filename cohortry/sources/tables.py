"""The five cohort tables and how the test tables play their parts.

Operators use the column names below and nothing else, so a cohort that is
stored under these names is read with ``stored`` and needs no mapping.

``calls``      one row per measured call, many per specimen
``specimens``  one row per draw
``patients``   one row per patient
``panel``      one row per gene on the panel
``reports``    one row per free-text report
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.functions.ladders import FloorLadder
from cohortry.functions.scoring import MEASURES, ScoreCaps

TABLE_NAMES = ("calls", "specimens", "patients", "panel", "reports")


@dataclass(frozen=True)
class Cohort:
    """Lazy tables plus the settings that belong to their units.

    ``call_key`` names a call. ``call_order`` puts calls in a total order: it is
    the key, followed by measures where a table may repeat a key.
    """

    calls: DataFrame
    specimens: DataFrame
    patients: DataFrame
    panel: DataFrame
    reports: DataFrame
    call_key: tuple[str, ...]
    call_order: tuple[str, ...]
    ladder: FloorLadder
    caps: ScoreCaps
    strong_consequences: tuple[str, ...]
    weak_consequences: tuple[str, ...]

    @property
    def spark(self) -> SparkSession:
        return self.calls.sparkSession

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_NAMES}

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Thresholds, caps and categories of cohorts stored in natural
# units (fractions, read counts, phred-scaled mapping quality).
NATURAL_LADDER = FloorLadder(
    floors=(
        ("low_mapq", "mapping_quality", 30),
        ("low_depth", "read_depth", 1500),
        ("low_vaf", "vaf", 0.0025),
        ("low_alt_reads", "alt_read_count", 5),
    ),
    otherwise="PASS",
)
NATURAL_CAPS = ScoreCaps(vaf=0.10, depth=5000.0, alt_reads=50.0, mapq_floor=20.0, mapq_span=40.0)
NATURAL_STRONG = ("missense_variant",)
NATURAL_WEAK = ("frameshift_variant", "splice_site_variant", "5_prime_UTR_variant")


def stored(spark: SparkSession, name_of: dict[str, str] | None = None) -> Cohort:
    """Read a cohort from catalog tables that carry the names above.

    The gene key of such a cohort is the gene symbol itself.
    """
    names = {name: name for name in TABLE_NAMES} | (name_of or {})
    frames = {name: spark.table(table) for name, table in names.items()}
    frames["calls"] = frames["calls"].withColumnRenamed("gene_symbol", "gene_id")
    frames["panel"] = frames["panel"].withColumn("gene_id", F.col("gene_symbol"))
    return Cohort(
        **frames,
        call_key=("variant_call_id",),
        call_order=("variant_call_id",),
        ladder=NATURAL_LADDER,
        caps=NATURAL_CAPS,
        strong_consequences=NATURAL_STRONG,
        weak_consequences=NATURAL_WEAK,
    )


# The same ladder and caps in the units of the mapped columns.
MAPPED_LADDER = FloorLadder(
    floors=(
        ("low_mapq", "mapping_quality", 0.02),
        ("low_depth", "read_depth", 10000.0),
        ("low_vaf", "vaf", 0.02),
        ("low_alt_reads", "alt_read_count", 5.0),
    ),
    otherwise="PASS",
)
MAPPED_KEY = ("specimen_id", "line_number", "gene_id", "position")
MAPPED_CAPS = ScoreCaps(vaf=0.10, depth=50000.0, alt_reads=50.0, mapq_floor=0.0, mapq_span=0.08)


def mapped(spark: SparkSession, folder: str) -> Cohort:
    """Let the order tables play the cohort: lines are calls, orders are draws.

    Measures stay the bare stored columns, so that thresholds on them reach
    the Parquet scan as pushed filters.
    """
    calls = parquet(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("specimen_id"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.col("l_partkey").alias("gene_id"),
        F.col("l_suppkey").alias("position"),
        F.col("l_linestatus").alias("variant_type"),
        F.col("l_returnflag").alias("consequence"),
        F.col("l_discount").alias("vaf"),
        F.col("l_extendedprice").alias("read_depth"),
        F.col("l_quantity").alias("alt_read_count"),
        F.col("l_tax").alias("mapping_quality"),
    )
    specimens = parquet(spark, folder, "orders").select(
        F.col("o_orderkey").alias("specimen_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("collection_date"),
        F.col("o_orderstatus").alias("assay"),
        F.col("o_totalprice").alias("tumor_fraction"),
        F.when(F.col("o_orderstatus") == "P", "REVIEW").otherwise("PASS").alias("qc_status"),
        F.col("o_orderpriority").alias("lab_site"),
    )
    patients = parquet(spark, folder, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        (F.lit(1938) + F.col("c_custkey") % 61).cast("int").alias("birth_year"),
        F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("sex"),
        F.col("c_mktsegment").alias("primary_cancer_type"),
        F.col("c_nationkey").cast("bigint").alias("stage_at_diagnosis"),
    )
    panel = parquet(spark, folder, "part").select(
        F.col("p_partkey").alias("gene_id"),
        F.col("p_brand").alias("gene_symbol"),
        F.concat(F.lit("chr"), (F.col("p_size") % 22 + 1).cast("string")).alias("chromosome"),
        (F.col("p_size") <= 25).alias("is_actionable"),
        F.when(F.col("p_size") <= 25, F.col("p_type")).alias("targeted_therapy"),
    )
    reports = parquet(spark, folder, "documents").select(
        F.col("doc_id").alias("report_id"),
        F.col("doc_id").alias("specimen_id"),
        F.col("lang").alias("cohort"),
        F.col("source").alias("pathologist"),
        F.col("text").alias("report_text"),
    )
    return Cohort(
        calls=calls,
        specimens=specimens,
        patients=patients,
        panel=panel,
        reports=reports,
        call_key=MAPPED_KEY,
        call_order=(*MAPPED_KEY, *MEASURES),
        ladder=MAPPED_LADDER,
        caps=MAPPED_CAPS,
        strong_consequences=("R",),
        weak_consequences=("A",),
    )
