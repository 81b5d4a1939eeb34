import hashlib
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortry.functions import hashing as h
from cohortry.functions import ladders, scalars, scoring
from cohortry.sources.tables import MAPPED_LADDER, NATURAL_CAPS, NATURAL_LADDER
from tests.conftest import rows


def test_ladder_edges_and_first_rung_wins(spark):
    df = spark.createDataFrame(
        [
            (1, 30, 1500, 0.0025, 5, "PASS"),
            (2, 29, 1500, 0.0025, 5, "low_mapq"),
            (3, 30, 1499, 0.0025, 5, "low_depth"),
            (4, 30, 1500, 0.0024, 5, "low_vaf"),
            (5, 30, 1500, 0.0025, 4, "low_alt_reads"),
            (6, 0, 0, 0.0, 0, "low_mapq"),
            (7, 31, 0, 0.0, 0, "low_depth"),
            (8, None, 1500, 0.5, 5, "PASS"),
            (9, None, 1, 0.5, 5, "low_depth"),
        ],
        "id int, mapping_quality int, read_depth int, vaf double, alt_read_count int, want string",
    )
    got = df.select("id", "want", NATURAL_LADDER.label().alias("got"))
    assert got.filter("want <> got").count() == 0
    kept = {r.id for r in df.filter(NATURAL_LADDER.clears()).collect()}
    assert kept == {1, 8}


def test_ladder_predicate_equals_label_on_data(cohort):
    label = cohort.calls.filter(MAPPED_LADDER.label() == "PASS").count()
    assert cohort.calls.filter(MAPPED_LADDER.clears()).count() == label


def test_significance_and_qc_ladders(spark):
    df = spark.createDataFrame(
        [
            (True, 0.06, True, False, "Pathogenic"),
            (True, 0.05, True, False, "Likely pathogenic"),
            (True, 0.02, False, True, "Likely pathogenic"),
            (False, 0.03, True, False, "Likely pathogenic"),
            (False, 0.02, True, False, "Uncertain significance"),
            (False, 0.5, False, True, "Benign"),
            (True, 0.01, False, False, "Uncertain significance"),
        ],
        "a boolean, v double, s boolean, w boolean, want string",
    )
    c = F.col
    got = ladders.significance(c("a"), c("v"), c("s"), c("w"))
    assert df.filter(got != c("want")).count() == 0
    qc = spark.createDataFrame(
        [(0.01, 0.5, "FAIL"), (0.02, 0.001, "REVIEW"), (0.35, 0.001, "PASS"), (0.3, 0.002, "PASS")],
        "u double, tf double, want string",
    )
    assert qc.filter(ladders.qc_status(c("u"), c("tf"), 0.002) != c("want")).count() == 0


KNOWN = [
    (0.12, 6000, 720, 55, True, 98.12),
    (0.003, 1200, 4, 25, False, 10.53),
    (9.0, 10**6, 10**6, 1000, True, 100.0),
    (0.12, 6000, 720, 55, None, 93.12),
    (0.0, 0, 0, 0, False, 0.0),
    (None, 6000, 720, 55, True, 0.0),
    (0.12, None, 720, 55, True, 0.0),
    (0.12, 6000, None, 55, True, 0.0),
    (0.12, 6000, 720, None, True, 0.0),
]


def test_confidence_known_answers_in_all_three_forms(spark):
    df = spark.createDataFrame(
        KNOWN,
        "vaf double, read_depth int, alt_read_count int, mapping_quality int, "
        "is_actionable boolean, want double",
    )
    native = df.select("want", scoring.confidence(NATURAL_CAPS).alias("got")).collect()
    assert all(abs(r.want - r.got) <= 0.0101 for r in native)
    scoring.register_confidence(spark, "known_confidence", NATURAL_CAPS)
    df.createOrReplaceTempView("known")
    sql = spark.sql(
        "SELECT want, known_confidence(vaf, read_depth, alt_read_count, mapping_quality, "
        "is_actionable) AS got FROM known"
    ).collect()
    assert [r.got for r in sql] == [r.want for r in sql]


def test_registered_name_is_replaced_only_on_request(spark):
    scoring.register_confidence(spark, "again_confidence", NATURAL_CAPS)
    scoring.register_confidence(spark, "again_confidence", NATURAL_CAPS)
    with pytest.raises(ValueError):
        scoring.register_confidence(spark, "again_confidence", NATURAL_CAPS, replace=False)


def test_batch_form_handles_missing_values():
    s = lambda *v: pd.Series(list(v))
    got = scoring.raw_confidence_batch(
        NATURAL_CAPS, s(0.1, None), s(5000, 5000), s(50, 50), s(60, 60), s(None, True)
    )
    assert list(got) == [95.0, 0.0]


def test_key_hash_matches_plain_python_and_partitioning(spark):
    def want(*key, salt=0):
        text = ":".join(map(str, (salt, *key)))
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 2**31

    keys = [(0, 0), (1, 2), (2**40 + 3, 7), (2**62, 2**61), (-5, -(2**50))]
    df = spark.createDataFrame(keys, "a long, b long")
    got = df.select("a", "b", h.key_hash("a", "b", salt=5).alias("x"))
    for parts in (1, 16):
        assert {(r.a, r.b): r.x for r in got.repartition(parts).collect()} == {
            k: want(*k, salt=5) for k in keys
        }


def test_bucket_index_clamps_and_picks(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.999999,), (1.0,)], "u double")
    got = [r.b for r in df.select(h.bucket_index(F.col("u"), 4).alias("b")).collect()]
    assert got == [0, 2, 3, 3]
    values = ["a", "a", "b", "c"]
    assert [r.v for r in df.select(h.weighted_pick(values, F.col("u")).alias("v")).collect()] == [
        "a", "b", "c", "c",
    ]
    shares = h.share_pick([(0.5, "low"), (0.9, "mid")], "top", F.col("u"))
    assert [r.v for r in df.select(shares.alias("v")).collect()] == ["low", "mid", "top", "top"]


def test_scalars(spark):
    df = spark.sql(
        "SELECT 7 AS n, 1234567890 AS big, timestamp_ntz'2024-01-01 23:00:00' AS a, "
        "timestamp_ntz'2024-01-02 01:00:00' AS b, 2.675D AS x"
    )
    row = df.select(
        scalars.padded_id("S-", F.col("n"), 4).alias("n"),
        scalars.padded_id("S-", F.col("big"), 4).alias("big"),
        scalars.days_between(F.col("a"), F.col("b")).alias("days"),
        scalars.exact_round(F.col("x"), 2).alias("x"),
        scalars.ratio(F.col("n"), F.lit(0)).alias("none"),
        scalars.plain_number(F.lit(3.14159)).alias("text"),
        scalars.long_date(F.col("a")).alias("long"),
    ).first()
    assert tuple(row) == ("S-0007", "S-1234567890", 1, 2.68, None, "3.14", "01 Jan 2024")
    assert df.select(scalars.today().alias("d"), F.current_date().alias("e")).filter("d = e").count()


def test_session_context(spark):
    from cohortry.session import session_context

    row = session_context(spark).first()
    assert row.whoami and row.working_in == "default" and row.engine.startswith("4.")


def test_uniform_bounds(spark):
    df = spark.range(2000).select(
        h.uniform_int(3, 9, "id").alias("i"), h.uniform_float(5, 6, "id").alias("f")
    )
    low, high, flow, fhigh = rows(df.agg(F.min("i"), F.max("i"), F.min("f"), F.max("f")))[0]
    assert (low, high) == (3, 9) and 5 <= flow < fhigh < 6


def test_keys_that_differ_only_far_up_are_spread(spark):
    df = spark.range(4096).select((F.col("id") * 2**31).alias("id"))
    buckets = df.select(F.shiftright(h.key_hash("id"), 15).alias("b")).distinct().count()
    assert buckets > 3000


def test_salts_are_independent(spark):
    """Two salts differ by no constant, and their quarters meet as often as chance has it."""
    from cohortry.functions.hashing import key_hash

    df = spark.range(20000).select(key_hash("id", salt=1).alias("a"), key_hash("id", salt=2).alias("b"))
    assert df.select(((F.col("a") - F.col("b")) % 2147483648).alias("d")).distinct().count() > 19000
    cells = df.groupBy(F.floor(F.col("a") / 2**29), F.floor(F.col("b") / 2**29)).count().collect()
    assert len(cells) == 16 and all(1100 < r["count"] < 1400 for r in cells)


def test_rounding_happens_once(spark):
    row = spark.sql("SELECT 0.0049999996D AS a, 1e23D AS b, -0.285D AS c").select(
        scalars.exact_round(F.col("a"), 2), scalars.exact_round(F.col("b"), 2), scalars.exact_round(F.col("c"), 2)
    ).first()
    assert tuple(row) == (0.0, 1e23, -0.29)
