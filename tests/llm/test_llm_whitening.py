"""Whitening against numpy's own eigenvectors and plain sums."""

from __future__ import annotations

import numpy as np
import pytest

from fleetstate.llm import whitening
from fleetstate.llm.whitening import eigen, fit, grid, op13_embedding_whitening, polar, whiten

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def symmetric(rng, values) -> np.ndarray:
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = q * values @ q.T
    return (a + a.T) / 2


def test_polar_factor_of_shifted_matrices():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40):
        a = symmetric(rng, rng.standard_normal(n) * 10.0 ** rng.integers(-6, 3, n))
        u = polar(a)
        left, s, right = np.linalg.svd(a)
        assert np.abs(u @ u - np.eye(n)).max() < 1e-12
        assert np.abs(u @ (left * s @ left.T) - a).max() < 1e-11 * s[0]


@pytest.mark.parametrize(
    "values",
    [[3.0], [2.0, 1.0], [5.0, 5.0, 5.0, 5.0], [1e6, 1e6, 1.0, 1e-3], list(np.linspace(1, 2, 64)), [7.0] * 20 + [1.0] * 20, [4.0, 4.0 + 1e-9, 4.0 - 1e-9, 1.0], [9.0, 0.0, 0.0]],
)
def test_eigenvectors_of_spectra_with_clusters(values):
    rng = np.random.default_rng(len(values))
    for a in (symmetric(rng, np.array(values)), np.diag(values)):
        found, vectors = eigen(a)
        assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * max(values) * len(values)
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13 * len(values)
        assert np.abs(a @ vectors - vectors * found).max() <= 1e-13 * max(values) * len(values)


def test_constant_diagonal():
    a = np.full((6, 6), 0.5) + np.eye(6)
    found, vectors = eigen(a)
    assert np.allclose(found, np.linalg.eigvalsh(a)[::-1], atol=1e-13)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12


def plain(rows):
    x = np.array([np.floor(64 * np.array(v, dtype=np.float32).astype(np.float64)) + 1_000_000 for _, v in rows])
    return x, np.cov(x.T, bias=True).reshape(x.shape[1], x.shape[1])


def test_whitened_rows_equal_numpy(spark):
    rng = np.random.default_rng(6)
    mixing = rng.standard_normal((12, 12))
    rows = [(i, [float(c) for c in rng.standard_normal(12) @ mixing]) for i in range(500)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = fit(vectors)
    x, covariance = plain(rows)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    assert model.n == 500 and np.allclose(model.values, values, rtol=1e-10)
    found = {r["vec_id"]: r for r in whiten(vectors, model, 8).collect()}
    sums = x.sum(axis=0).astype(int)
    for i in range(500):
        assert found[i]["deviation"] == sum((500 * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
        want = (x[i] - sums / 500) @ directions[:, :8] / np.sqrt(values[:8])
        assert np.abs(np.abs(found[i]["whitened"]) - np.abs(want)).max() < 1e-8
    assert whitening.identity_error(vectors, model, 8) < 1e-10


def test_unusable_vectors_other_lengths_and_flat_directions(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), float(i * i), 3.0]) for i in range(10)]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [nan, 1.0, 1.0]), (54, [inf, 1.0, 1.0]), (55, [1.0]), (56, [1e30, 1.0, 1.0])]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in [*good, *bad, (None, [1.0, 1.0, 3.0])]], SCHEMA + ", x int, size string")
    model = fit(vectors)
    assert model.n == 11 and len(model.values) == 2
    found = whiten(vectors, model).collect()
    assert {r["vec_id"] for r in found} == {*range(10), None} and all(len(r["whitened"]) == 2 for r in found)
    assert grid(vectors).count() == 12
    assert fit(vectors.limit(0)) is None
    assert fit(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)) is None


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(1, [0.0]), (2, [float(1 << 40)]), (3, [1.0])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert {r["vec_id"]: r["deviation"] for r in whiten(vectors, fit(vectors)).collect()} == {1: None, 2: None, 3: None}


def test_query_over_the_given_table(spark):
    found = op13_embedding_whitening(spark, SF_DIR)
    rows = found.collect()
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, covariance = plain(table)
    values = np.linalg.eigvalsh(covariance)[::-1]
    assert len(rows) == len(table) * min(32, x.shape[1])
    assert max(r["identity_error"] for r in rows) < 1e-9
    assert all(abs(r["explained"] - values[r["component"] - 1] / np.trace(covariance)) < 1e-10 for r in rows)
    size = {r["vec_id"]: 0.0 for r in rows}
    for r in rows:
        size[r["vec_id"]] += r["whitened"] ** 2
    assert abs(np.mean(list(size.values())) - min(32, x.shape[1])) < 1e-8

    op = {(r["vec_id"], r["component"]) for r in rows}
    assert len(op) == len(rows)
