from collections import Counter

from pyspark.sql import functions as F

from cohortry.operators import text as tx
from tests.conftest import rows


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id int, t string")


def test_extract_types_absence_and_first_match(spark):
    fields = {
        "gene": (r"gene ([A-Z0-9]+)", "string"),
        "pct": (r"([0-9]+\.[0-9]+)%", "double"),
        "n": (r"n=([0-9a-z]+)", "int"),
    }
    df = texts(spark, "gene TP53 at 9.50% then gene KRAS, n=12", "nothing", "", None, "n=abc")
    got = df.select("id", tx.extract(F.col("t"), fields).alias("e")).select("id", "e.*")
    none = (None, None, None)
    assert rows(got) == [
        (0, "TP53", 9.5, 12), (1, *none), (2, *none), (3, *none), (4, *none),
    ]


def test_classify_ties_case_and_fallback(spark):
    labels = {"first": ["alpha"], "second": ["beta", "gamma"]}
    df = texts(spark, "ALPHA beta", "beta GAMMA alpha", "none", "", None, "betabeta alpha")
    plain = rows(df.select("id", tx.classify(F.col("t"), labels)))
    assert plain == [
        (0, "first"), (1, "second"), (2, "first"), (3, "first"), (4, None), (5, "second"),
    ]
    other = dict(rows(df.select("id", tx.classify(F.col("t"), labels, "other"))))
    assert other[2] == "other" and other[3] == "other" and other[4] is None


def test_classify_words_agrees_with_a_plain_count(spark, cohort):
    labels = {"first": ["alpha"], "second": ["beta", "gamma"]}
    df = texts(spark, "ALPHA beta", "beta, GAMMA! alpha", "none", "", None, "betabeta alpha", "beta beta alpha")
    got = dict(rows(df.select("id", tx.classify_words(F.col("t"), labels, "other"))))
    assert got == {0: "first", 1: "second", 2: "other", 3: "other", 4: None, 5: "first", 6: "second"}
    assert dict(rows(df.select("id", tx.classify_words(F.col("t"), labels))))[2] == "first"


def test_first_words(spark):
    df = texts(spark, "One  two\nthree four. Five.", "", None, "... x", "no stop at all")
    got = dict(rows(df.select("id", tx.first_words(F.col("t"), 3))))
    assert got[0] == "One two three" and got[1] == "" and got[3] == "" and got[4] == "no stop at"


def test_complete_keeps_rows_and_sets_up_once_per_task(spark):
    def make():
        calls = []

        def write(prompts):
            calls.append(len(prompts))
            return [p.upper() + f" setup{len(calls) > 0}" for p in prompts]

        return write

    df = texts(spark, "a b c", None, "d").repartition(2)
    got = dict(rows(tx.complete(df, "t", "Say: ", make, "answer", max_words=3).select("id", "answer")))
    assert got == {0: "SAY: A B", 1: None, 2: "SAY: D setupTrue"}


def test_themes_match_a_plain_count(cohort):
    import re

    got = {r.cohort: (r.reports_reviewed, r.themes) for r in tx.themes(cohort.reports, "cohort", "report_text").collect()}
    local = cohort.reports.select("cohort", "report_text").collect()
    for name in {r.cohort for r in local}:
        mine = [r.report_text for r in local if r.cohort == name]
        words = Counter(w for t in mine for w in re.findall(r"[^\W\d_]+", t.lower()) if len(w) >= 4)
        best = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:3]
        assert got[name] == (len(mine), ", ".join(w for w, _ in best))


def test_group_without_terms_stays(spark):
    df = spark.createDataFrame([("a", "word word"), ("b", "xx")], "g string, t string")
    assert rows(tx.themes(df, "g", "t")) == [("a", 1, "word"), ("b", 1, None)]


def test_long_numbers_and_word_edges(spark):
    from cohortry.plans.queries import FIELDS, LABELS
    from cohortry.operators import text as tx
    from pyspark.sql import functions as F

    rows = [(1, "id 2123465659789240 x"), (2, "n 99999999999999999999"), (3, "The end, and"), (4, "xyz")]
    df = spark.createDataFrame(rows, "k int, t string")
    got = {
        r.k: (r.n, r.l)
        for r in df.select(
            "k", tx.extract(F.col("t"), FIELDS)["first_number"].alias("n"),
            tx.classify(tx.padded(F.col("t")), LABELS, otherwise="unknown").alias("l"),
        ).collect()
    }
    assert got == {1: (2123465659789240, "unknown"), 2: (None, "unknown"), 3: (None, "english"), 4: (None, "unknown")}
