"""Whitening against a dense eigensolver."""

import numpy as np
import pytest

from shelfspark.llm import whitening
from shelfspark.llm.queries import op13_whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, x string, deviation int"


def dense(vectors, k):
    """n, sums, eigenvalues and vectors of the distinct rows, by the whole covariance."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    rows = (n * fit - sums) / n
    values, q = np.linalg.eigh(rows.T @ rows / n)
    order = np.argsort(values)[::-1][:k]
    return x, n, sums, values, values[order], q[:, order]


@pytest.mark.parametrize(("n", "d", "k"), [(900, 64, 16), (300, 150, 16), (40, 8, 16), (9, 30, 16), (500, 40, 1)])
def test_jacobi_davidson_to_double_precision(n, d, k):
    rng = np.random.default_rng(n)
    rows = np.floor(64 * rng.standard_normal((n, d)) * np.linspace(0.3, 0.1, d))
    rows -= rows.mean(axis=0)
    v = rows.T @ rows / n
    values, vectors, residuals = whitening.jacobi_davidson(lambda t: rows.T @ (rows @ t) / n, d, min(k, d))
    exact = np.sort(np.linalg.eigvalsh(v))[::-1][: min(k, d)]
    assert np.abs(values - exact).max() < 1e-13 * exact[0]
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 1e-12 * exact[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert residuals.max() < 1e-12 * exact[0]


def test_equal_eigenvalues():
    values, vectors, _ = whitening.jacobi_davidson(lambda t: 3.0 * t, 20, 4)
    assert np.allclose(values, 3) and np.allclose(vectors.T @ vectors, np.eye(4))


def test_minres_solves_each_column():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 5))
    b[:, 2] = 0
    found = whitening.minres(lambda t: a @ t, b, 200, 1e-13)
    assert np.abs(a @ found - b).max() < 1e-8


def test_query_equals_the_dense_solver(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, n, sums, all_values, values, q = dense(np.stack(table.embedding), 16)
    found = op13_whitening(spark, SF_DIR).toPandas().sort_values(["vec_id", "component"])
    assert len(found) == 16 * len(table) and set(found.n) == {n}
    mine, exact = found.whitened.to_numpy().reshape(-1, 16), (n * x - sums) / n @ q / np.sqrt(values)
    assert np.abs(mine * np.sign((mine * exact).sum(axis=0)) - exact).max() < 1e-9
    assert (found.deviation.to_numpy().reshape(-1, 16) == ((n * x - sums) ** 2).sum(axis=1)[:, None]).all()
    assert np.abs(found.explained.to_numpy()[:16] - values / all_values.sum()).max() < 1e-12
    assert found.identity_error.max() < 1e-10


def whitened(spark, rows, k=16):
    return whitening.whitened(spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA), k)


def test_rows_that_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    kept = [(1, [0.5, 1.0, -2.0]), (1, [0.5, 1.0, -2.0]), (None, [1.0, 0.25, 3.0]), (4, [0.0, 0.0, 0.1]), (5, [9.0, -1.0, 2.0])]
    gone = [(6, None), (7, [1.0, None, 2.0]), (8, [nan, 1.0, 2.0]), (9, [inf, 1.0, 2.0]), (10, []), (11, [1.0]), (12, [1e300, 0.0, 0.0])]
    table, found = whitened(spark, kept + gone)
    rows = sorted(table.collect(), key=repr)
    assert sorted((r.vec_id or -1) for r in rows) == [-1, 1, 1, 4, 5]
    x, n, sums, _, values, q = dense([v for _, v in kept], 3)
    assert found.n == n == 4 and found.sums == list(sums)
    by_id = {r.vec_id: r for r in rows}
    for (i, _), row in zip(kept, x, strict=True):
        assert by_id[i].deviation == ((n * row - sums) ** 2).sum()
        assert np.allclose(np.abs(by_id[i].whitened), np.abs((n * row - sums) / n @ q / np.sqrt(values)))


def test_a_hot_vector_counts_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(50)]
    _, once = whitened(spark, rows)
    _, often = whitened(spark, rows + [(100 + i, rows[0][1]) for i in range(500)])
    assert once.n == often.n == 50 and np.allclose(once.values, often.values) and once.sums == often.sums


def test_nothing_and_one_vector(spark):
    empty, none = whitened(spark, [])
    assert none is None and empty.count() == 0
    table, found = whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert found.n == 1 and [(r.deviation, list(r.whitened)) for r in table.collect()] == [(0, []), (0, [])]
