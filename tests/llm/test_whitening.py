"""Embedding whitening against numpy's eigenvectors, and its defined cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.llm.whitening import (
    below, fit_whitening, leading_components, leading_values, op11_embedding_whitening, products, tridiagonal, whiten,
)
from tests.llm.conftest import CLASHING, SMALL, table_rows


def matrices():
    draw = np.random.default_rng(7)
    for d in (1, 2, 3, 5, 17, 64):
        a = draw.normal(size=(d, d))
        yield a @ a.T
        yield np.eye(d) * 3.0
        q, _ = np.linalg.qr(a)
        values = np.r_[np.full(min(3, d), 5.0), draw.random(max(0, d - 3))]
        near = q @ np.diag(values) @ q.T
        yield (near + near.T) / 2
        few = draw.normal(size=(2, d))
        yield few.T @ few


@pytest.mark.parametrize("v", list(matrices()))
def test_leading_components(v):
    values, vectors = leading_components(v, 4)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    assert np.allclose(values, want, rtol=0, atol=1e-13 * want[0])
    assert np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-13)
    assert np.allclose(v @ vectors.T, vectors.T * values, atol=1e-12 * want[0])


def test_tridiagonal_keeps_the_eigenvalues():
    a = np.random.default_rng(3).normal(size=(20, 20))
    v = a + a.T
    diagonal, off, _ = tridiagonal(v)
    want = np.linalg.eigvalsh(v)
    assert np.allclose(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)), want)
    assert [below(diagonal, off, w + 1e-9) for w in want] == list(range(1, 21))
    assert np.allclose(leading_values(diagonal, off, 20), want[::-1])


def expected(vectors):
    """vec_id -> (n, deviation, four projections) by plain numpy."""
    x = {i: np.array([math.floor(256 * float(np.float32(c))) for c in e]) for i, e in vectors.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, components = np.linalg.eigh(np.cov(fit.T, bias=True))
    return n, values[::-1], {
        i: (int(((n * v - sums) ** 2).sum()), (v - sums / n) @ components[:, ::-1][:, :4] / np.sqrt(values[::-1][:4]))
        for i, v in x.items()
    }


def test_whole_table_against_numpy(spark):
    vectors = {r.vec_id: r.embedding for r in table_rows(spark, "embeddings")}
    n, values, want = expected(vectors)
    got = op11_embedding_whitening(spark, SMALL).collect()
    assert len(got) == 4 * len(vectors)
    signs = {}
    for r in got:
        far, white = want[r.vec_id]
        k = r.component - 1
        assert (r.n, r.deviation) == (n, far)
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
        assert abs(r.whitened) == pytest.approx(abs(white[k]), abs=1e-9)
        if abs(white[k]) > 1e-6:
            assert signs.setdefault(k, r.whitened * white[k] > 0) == (r.whitened * white[k] > 0)


def frame(spark, rows):
    names = [c for c in CLASHING if c != "id"] + ["x", "deviation", "whitened"]
    return spark.createDataFrame([(*r, *["extra"] * len(names)) for r in rows], "vec_id long, embedding array<float>, " + ", ".join(f"`{c}` string" for c in names))


def test_unusable_rows_copies_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), float(i % 3), -float(i)]) for i in range(12)]
    hot = [(None, [1.0, 2.0, 3.0])] * 50 + [(7, [1.0, 2.0, 3.0])] * 30
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [inf, 1.0, 1.0]), (104, [1.0, 2.0]), (105, [])]
    done = whiten(frame(spark, good + hot + odd))
    rows = done.rows.select("row.*", F.col("deviation").alias("d"), F.col("whitened").alias("w")).collect()
    assert len(rows) == 12 + 80
    assert done.model.n == 13 and done.error < 1e-12
    assert all(len(r.w) == 3 and r.row == "extra" for r in rows)
    alone = whiten(frame(spark, good + hot[:1]))
    assert done.model.values == alone.model.values and (done.model.components == alone.model.components).all()


def test_little_or_no_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])] * 9, [(1, [])]):
        done = whiten(frame(spark, rows))
        assert done.model is None and done.rows.count() == 0
    line = whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]))
    assert len(line.model.values) == 1 and line.model.explained == [pytest.approx(1.0)]
    assert {len(r.whitened) for r in line.rows.collect()} == {1}


def test_products_of_large_entries_are_exact(spark):
    rows = [([2**40 + i, -(2**39) * i, i],) for i in range(1500)]
    found = products(spark.createDataFrame(rows, "x array<long>").repartition(3), [2**40, 0, 700])
    y = np.array([[i, -(2**39) * i, i - 700] for i in range(1500)], dtype=object)
    assert (found == y.T @ y).all()


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i, [math.sin(i * j) for j in range(1, 9)]) for i in range(200)]
    one = fit_whitening(spark.createDataFrame([([math.floor(256 * c) for c in e],) for _, e in rows], "x array<long>").repartition(1))
    seven = fit_whitening(spark.createDataFrame([([math.floor(256 * c) for c in e],) for _, e in rows], "x array<long>").repartition(7))
    assert one.values == seven.values and (one.components == seven.components).all()
