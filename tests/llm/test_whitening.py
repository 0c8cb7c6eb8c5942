"""Whitening against a dense eigendecomposition of the covariance."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffcast.llm import whitening
from staffcast.llm.stages import Kept

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, dim):
    """Valid rows as integers, and n, S, eigenvalues, eigenvectors and trace over the distinct ones."""
    valid = [(i, np.floor(256 * np.array(v, dtype=float)).astype(np.int64)) for i, v in rows
             if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    distinct = np.unique(np.stack([x for _, x in valid]), axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return valid, n, sums, values[::-1], vectors[:, ::-1], np.square(centred).sum() / n


def check(spark, rows, dim, components=4):
    table = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("x"), F.lit("n").alias("length")).repartition(3)
    got = whitening.whiten(table, Kept(spark)).collect()
    valid, n, sums, values, vectors, trace = brute(rows, dim)
    assert len(got) == len(valid) * components
    want = {}
    for i, x in valid:
        want[i] = ((x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4]), sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True)))
    sign = {}
    for r in got:
        k = r.component - 1
        expected, deviation = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.explained - values[k] / trace) <= 1e-9
        assert r.identity_error <= 1e-9
        if abs(expected[k]) > 1e-3:
            assert sign.setdefault(k, np.sign(expected[k] * r.whitened)) == np.sign(expected[k] * r.whitened)
        assert abs(abs(expected[k]) - abs(r.whitened)) <= 1e-8
    return got


def spectrum(rng, n, dim, scale):
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return (rng.standard_normal((n, dim)) * scale) @ turn


def test_leading_components_of_a_wide_spectrum(spark):
    rng = np.random.default_rng(1)
    scale = np.concatenate([[3, 2, 1.5, 1.2], np.linspace(1, 0.8, 60)])
    rows = [(i, v.tolist()) for i, v in enumerate(spectrum(rng, 700, 64, scale))]
    rows += [(i + 1000, v) for i, v in rows[:200]]  # copies count once
    check(spark, rows, 64)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(spectrum(rng, 60, 5, np.array([4, 3, 2, 1.5, 1])))]
    rows += [(70, None), (71, []), (72, [1.0, None, 0.0, 0.0, 0.0]), (73, [float("nan")] * 5), (74, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (75, [1.0, 2.0]),
             (76, [0.0, -0.0, 0.0, 0.0, 0.0]), (76, [0.0, 0.0, 0.0, 0.0, 0.0]), (77, [1e300, 0.0, 0.0, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), Kept(spark)).collect()
    assert {r.vec_id for r in got} == {*range(60), 76}
    assert sum(r.vec_id == 76 for r in got) == 8
    check(spark, [r for r in rows if r[0] not in (76, 77)], 5)


def test_deviations_are_exact_when_large(spark):
    rows = [(i, [2.0**20 + i, float(i * i), 1.0 + i % 3]) for i in range(40)]
    check(spark, rows, 3, 3)
    far = [(0, [2.0**43]), (1, [-(2.0**43)]), (2, [0.0])]
    got = whitening.whiten(spark.createDataFrame(far, SCHEMA), Kept(spark)).collect()
    assert {r.vec_id: r.deviation for r in got} == {0: None, 1: None, 2: 0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_without_variance_there_is_nothing(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA), Kept(spark)).collect() == []


def test_of_a_plane_two_components(spark):
    rng = np.random.default_rng(3)
    plane = rng.integers(-50, 50, (80, 2)) @ rng.integers(-3, 4, (2, 6))
    rows = [(i, (v / 256).tolist()) for i, v in enumerate(plane)]
    check(spark, rows, 6, 2)


@pytest.mark.parametrize("dim, gap", [(40, 1.3), (200, 1.05)])
def test_filtered_iteration_finds_eigenvectors_of_double_precision(dim, gap):
    rng = np.random.default_rng(4)
    values = np.sort(np.concatenate([gap ** np.arange(4, 0, -1), rng.uniform(0, 0.98, dim - 4)]))[::-1]
    basis = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    matrix = (basis * values) @ basis.T
    passes = []

    def apply(q):
        passes.append(q.shape)
        return matrix @ q

    found, vectors = whitening.leading(apply, dim, 4)
    assert np.allclose(found, values[:4], rtol=1e-13)
    assert np.allclose(np.abs(np.sum(vectors * basis[:, :4], axis=0)), 1, atol=1e-12)
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-13
    assert len(passes) < 200 and all(width <= 32 for _, width in passes)
