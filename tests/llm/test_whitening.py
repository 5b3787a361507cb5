"""Whitening against exact fractions and NumPy's eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from requestmill.llm import whitening
from requestmill.llm.queries import op13_embedding_whitening


def frame(spark, rows):
    found = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return found.selectExpr("*", "1 AS x", "2 AS n", "3 AS component", "4 AS d", "5 AS v").repartition(3)


def usable(rows):
    keep = [(i, e) for i, e in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    return [(i, tuple(math.floor(256 * c) for c in e)) for i, e in keep]


def check(rows, got, most=4):
    """Every row's result from sums of fractions and an eigendecomposition of the exact covariance."""
    vectors = usable(rows)
    fit = sorted({x for _, x in vectors})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    mean = [Fraction(s, n) for s in sums]
    centred = np.array([[float(x[k] - mean[k]) for k in range(d)] for x in fit])
    v = centred.T @ centred / n
    values, vecs = np.linalg.eigh(v)
    values, vecs = values[::-1], vecs[:, ::-1]
    count = min(most, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(vectors) * count
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], []).append(r)
    for vec_id, x in vectors:
        own = sorted((r for r in by_row[vec_id]), key=lambda r: r["component"])
        deviation = sum((n * x[k] - sums[k]) ** 2 for k in range(d))
        exact = np.array([float(x[k] - mean[k]) for k in range(d)])
        same = [r for r in own if r["deviation"] == (deviation if deviation < 2**63 else None)]
        assert len(same) >= count
        for r in same[:count]:
            k = r["component"] - 1
            assert r["n"] == n and r["identity_error"] <= 1e-6
            assert math.isclose(r["explained"], values[k] / v.trace(), rel_tol=1e-8)
            want = exact @ vecs[:, k] / math.sqrt(values[k])
            assert math.isclose(abs(r["whitened"]), abs(want), rel_tol=1e-6, abs_tol=1e-7)


def some(seed, count, d, scale=1.0, shift=0.0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(count, d)) @ (rng.normal(size=(d, d)) * np.geomspace(1, 0.05, d))
    return [(k, [float(c) for c in row * scale + shift]) for k, row in enumerate(mixed)]


def test_random_rows_with_odd_ones(spark):
    rows = some(1, 120, 6)
    rows += [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6), (503, [float("inf")] + [0.0] * 5), (504, [])]
    rows += [(600 + k, rows[3][1]) for k in range(60)]  # a third of all rows are copies of one
    got = whitening.whitened(frame(spark, rows)).collect()
    check(rows, got)
    copies = {(r["component"], r["whitened"]) for r in got if r["vec_id"] in (3, 600, 659)}
    assert len(copies) == 4


def test_signs_are_the_same_for_all_rows(spark):
    rows = some(2, 200, 5)
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in whitening.whitened(frame(spark, rows)).collect()}
    w = np.array([[got[k, c] for c in (1, 2, 3, 4)] for k in range(200)])
    cov = (w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / 200
    assert np.abs(cov - np.eye(4)).max() < 1e-9


def test_large_means_and_values(spark):
    """Means that dwarf the spread, and squares beyond 64 bits."""
    check(rows := some(3, 90, 4, shift=1e9), whitening.whitened(frame(spark, rows)).collect())
    big = some(4, 80, 4, scale=1e9)
    got = whitening.whitened(frame(spark, big)).collect()
    check(big, got)
    assert all(r["deviation"] is None for r in got)


def test_fewer_components_than_four(spark):
    flat = [(k, [float(k), 2.0 * k, 5.0, 0.0, -float(k)]) for k in range(40)]
    got = whitening.whitened(frame(spark, flat)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 40
    check(flat, got)
    assert whitening.whitened(frame(spark, [(k, [1.0, 2.0]) for k in range(9)])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [3.0])])).collect() == []


def test_no_rows_null_ids_and_other_lengths(spark):
    none = frame(spark, some(5, 10, 3)).where("false")
    assert whitening.whitened(none).collect() == []
    assert whitening.whitened(none).columns == whitening.whitened(frame(spark, some(5, 10, 3))).columns
    rows = some(6, 30, 3) + [(None, [0.5, 0.25, -1.0]), (77, [1.0, 2.0]), (78, [1e300, 0.0, 0.0])]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == {*range(30), None}


@pytest.mark.parametrize("seed", range(6))
def test_cholesky_and_jacobi(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 24))
    a = rng.normal(size=(d, max(1, d - seed))) * np.geomspace(1, 1e-4, max(1, d - seed))
    v = a @ a.T
    factor, order = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[np.ix_(order, order)], atol=1e-12 * v.max())
    assert np.array_equal(factor[: factor.shape[1]], np.tril(factor[: factor.shape[1]]))
    turned = whitening.jacobi(factor)
    lengths = np.linalg.norm(turned, axis=0)
    assert np.abs(turned.T @ turned / np.outer(lengths, lengths) - np.eye(len(lengths))).max() < 1e-13
    values, vectors = whitening.eigen(v)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-11 * values[0])
    assert np.all(np.diff(values) <= 0)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][: len(values)], rtol=1e-6, atol=1e-12 * values[0])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, op13_embedding_whitening(spark, sf).collect())
