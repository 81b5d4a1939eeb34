"""Importance resampling against plain sums, and its defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.llm.resampling import FOLDED, Buckets, bucket_counts, drawn, gains, planes, resample, signed_planes, weighed_sums


def test_planes_give_the_exact_sums():
    draw = np.random.default_rng(5)
    for buckets in (1, 63, 64, 65, 1000):
        counts = draw.integers(0, 40, size=(9, buckets)) * (draw.random((9, buckets)) < 0.2)
        counts[0] = 0
        counts[1, 0] = 2**33
        gain = draw.integers(-9000, 9000, size=buckets)
        assert (weighed_sums(counts, *signed_planes(gain)) == counts @ gain).all()
        assert planes(counts).shape == (34, 9, -(-buckets // 64))


def test_words_and_runs():
    assert "Ab-C9 éÉ\x7fz".encode().translate(FOLDED).split() == ["ab".encode(), b"c9", "éÉ".encode(), b"z"]
    words, found = Buckets(10_000).of("One two  three", 2)
    assert words == 3
    assert list(found) == [zlib.crc32(f) % 10_000 for f in (b"one", b"two", b"three", b"one two", b"two three")]
    assert Buckets(7).of(None, 3)[0] == 0 == len(Buckets(7).of("!?", 3)[1])


def brute(docs, target, percent, least, buckets):
    place = Buckets(buckets)
    counts = [np.bincount(place.of(t, 1)[1], minlength=buckets) for _, t in docs]
    given, wanted = sum(counts), sum(np.bincount(place.of(t, 1)[1], minlength=buckets) for t in target)
    gain = gains(dict(enumerate(given.tolist())), dict(enumerate(wanted.tolist())), buckets)
    return [int(c @ gain) // max(int(c.sum()), 1) for c in counts], [int(c.sum()) for c in counts]


def test_odd_rows_against_plain_sums(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    target = ["the on re", "ent here the", None, ""]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    weights, sizes = brute(rows, target, 50, 20, 100)
    got = resample(documents, goal, percent=50, buckets=100, keep=["source", "row", "n"])
    assert got.columns == ["doc_id", "source", "row", "n", "n_features", "weight", "score", "rank"]
    found = got.collect()
    key = lambda x: tuple((v is None, v) for v in x)
    want = sorted(((i, s, w) for (i, _), s, w in zip(rows, sizes, weights, strict=True)), key=key)
    assert sorted(((r.doc_id, r.n_features, r.weight) for r in found), key=key) == want
    able = [r for r in found if r.n_features >= 20]
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(able) // 2 + 1))
    order = lambda r: (-r.score, r.doc_id is not None, r.doc_id or 0)
    assert [order(r) for r in ranked] == sorted(map(order, able))[: len(ranked)]
    assert {r.row for r in found} == {"extra"}
    ids = {r.doc_id for r in ranked}
    assert {r.doc_id for r in drawn(documents, got).collect()} == ids


def test_longer_runs(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in resample(docs, docs, percent=100, least_words=2, longest=3).collect()}
    assert [got[i].n_features for i in (1, 2, 3)] == [4 + 3 + 2, 1, 0]
    assert [got[i]["rank"] for i in (1, 2, 3)] == [1, None, None]


@pytest.mark.parametrize("texts", [[], [None, None], ["", " "]])
def test_empty_tables(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    assert bucket_counts(docs).count() == 0
    got = resample(docs, target).collect()
    assert len(got) == len(texts) and all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in got)


def test_equal_scores_go_to_the_smaller_id(spark):
    text = " ".join(["word"] * 30)
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    docs = docs.union(docs.limit(20))
    got = resample(docs, docs.select("text"), percent=100).orderBy("rank").collect()
    assert [(-r.score, r.doc_id) for r in got] == sorted((-r.score, r.doc_id) for r in got)
    assert {r.weight for r in got} == {got[0].weight} and len(got) == 60
