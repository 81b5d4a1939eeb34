import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("cohortry-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file:{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from cohortry.session import apply_defaults

    yield apply_defaults(session)
    session.stop()


@pytest.fixture(scope="session")
def cohort(spark):
    from cohortry.sources.tables import mapped

    return mapped(spark, SMALL)


@pytest.fixture(scope="session")
def tiny(spark):
    """A cohort in natural units, small enough to work out by hand.

    Draw S4 has no calls, patient P4 has no draws, gene G9 is never hit, and
    two calls of P1 in G1 share a date.
    """
    from cohortry.sources.tables import stored

    calls = [
        # id, specimen, gene, chrom, pos, type, consequence, vaf, depth, alt, mapq, significance, filter
        (1, "S1", "G1", "chr1", 10, "SNV", "missense_variant", 0.10, 3000, 300, 50, "Pathogenic", "PASS"),
        (2, "S1", "G1", "chr1", 11, "SNV", "missense_variant", 0.12, 3000, 360, 50, "Pathogenic", "PASS"),
        (3, "S1", "G2", "chr2", 12, "SNV", "intron_variant", 0.03, 3000, 90, 50, "Benign", "PASS"),
        (4, "S2", "G1", "chr1", 13, "SNV", "missense_variant", 0.12, 4000, 480, 60, "Pathogenic", "PASS"),
        (5, "S2", "G1", "chr1", 14, "SNV", "missense_variant", 0.20, 4000, 800, 25, "Pathogenic", "low_mapq"),
        (6, "S3", "G1", "chr1", 15, "SNV", "stop_gained", 0.05, 5000, 250, 40, "Likely pathogenic", "PASS"),
        (7, "S5", "G2", "chr2", 16, "SNV", "stop_gained", 0.08, 2000, 160, 40, "Benign", "PASS"),
    ]
    frames = {
        "calls": spark.createDataFrame(
            calls,
            "variant_call_id long, specimen_id string, gene_symbol string, chromosome string, "
            "position long, variant_type string, consequence string, vaf double, read_depth int, "
            "alt_read_count int, mapping_quality int, clinical_significance string, "
            "call_filter string",
        ),
        "specimens": spark.sql(
            """SELECT * FROM VALUES
            ('S1', 'P1', DATE'2024-01-01', 'A', 0.10, 'PASS', 'N'),
            ('S2', 'P1', DATE'2024-02-01', 'A', 0.20, 'PASS', 'N'),
            ('S3', 'P2', DATE'2024-01-05', 'B', 0.05, 'PASS', 'S'),
            ('S4', 'P2', DATE'2024-03-05', 'B', 0.01, 'PASS', 'S'),
            ('S5', 'P3', DATE'2024-01-09', 'A', 0.30, 'FAIL', 'W')
            AS t(specimen_id, patient_id, collection_date, assay, tumor_fraction, qc_status, lab_site)"""
        ),
        "patients": spark.sql(
            """SELECT * FROM VALUES ('P1', 1950, 'Female', 'Lung', 'IV'),
            ('P2', 1960, 'Male', 'Lung', 'II'), ('P3', 1970, 'Male', 'Breast', 'I'),
            ('P4', 1980, 'Female', 'Breast', 'I')
            AS t(patient_id, birth_year, sex, primary_cancer_type, stage_at_diagnosis)"""
        ),
        "panel": spark.sql(
            """SELECT * FROM VALUES ('G1', 'chr1', true, 'drug'), ('G2', 'chr2', false, NULL),
            ('G9', 'chr9', true, 'other')
            AS t(gene_symbol, chromosome, is_actionable, targeted_therapy)"""
        ),
        "reports": spark.sql(
            "SELECT 'R1' AS report_id, 'S1' AS specimen_id, 'Some text.' AS report_text"
        ),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(f"tiny_{name}")
    return stored(spark, {n: f"tiny_{n}" for n in frames})


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
