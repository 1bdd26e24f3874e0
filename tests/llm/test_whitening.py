"""Whitening against a plain eigendecomposition, and the polar split on matrices that are hard to split."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from subscope.llm import queries, spectral, whitening

VECTORS = "vec_id long, embedding array<float>, label int, n long, component string, v string"


@pytest.fixture
def table(spark):
    def make(rows, kind="float"):
        return spark.createDataFrame([(i, v, 1, 2, "c", "v") for i, v in rows], VECTORS.replace("float", kind)).repartition(3)

    return make


def check(rows, found):
    """`rows`: the (vec_id, vector) that take part; `found`: the result."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in map(float, v)] for _, v in rows], dtype=object)
    n, sums = len(rows), x.sum(axis=0)
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    y = np.array([[float(a) for a in row] for row in n * x - sums]) / n
    covariance = y.T @ y / n
    values = np.linalg.eigvalsh(covariance)[::-1]
    k = min(32, x.shape[1])
    assert len(found) == n * k and {r["n"] for r in found} == {n}
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] <= 1e-4
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    z = np.array([[by[i][c + 1]["whitened"] for c in range(k)] for i, _ in rows])
    assert [by[i][1]["deviation"] for i, _ in rows] == deviations.tolist()
    explained = np.array([by[rows[0][0]][c + 1]["explained"] for c in range(k)])
    assert np.allclose(explained, values[:k] / np.trace(covariance), rtol=1e-6)
    # Whatever the signs: the components that the result implies are unit eigenvectors.
    axes = np.linalg.lstsq(y, z, rcond=None)[0] * np.sqrt(values[:k])
    assert np.allclose(axes.T @ axes, np.eye(k), atol=1e-8)
    assert np.allclose(covariance @ axes, axes * values[:k], atol=1e-8 * values[0])
    assert np.abs(z.T @ z / n - np.eye(k)).max() <= 1e-8


def test_whole_table(spark, sf_dir):
    t = pq.read_table(f"{sf_dir}/embeddings.parquet")
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    check(rows, queries.op12_embedding_whitening(spark, sf_dir).collect())


@pytest.mark.parametrize("dims, kind", [(3, "float"), (40, "double")])
def test_rows_that_take_no_part(table, dims, kind):
    rng = np.random.default_rng(2)
    good = [(i, (rng.standard_normal(dims) * (1 + i % 3) + 5).astype("f4").tolist()) for i in range(120)]
    good += [(500, good[0][1])]
    bad = [(200, None), (201, [None] * dims), (202, [float("nan")] * dims), (203, [float("inf")] * dims)]
    bad += [(204, []), (205, [1.0] * (dims + 1)), (206, [1e30] * dims), (207, good[1][1][:-1] + [None])]
    check(good, whitening.whitened(table(good + bad, kind)).collect())


def test_ties_constants_and_null_ids(table):
    same = whitening.whitened(table([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert len(same) == 6
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(3, 0, None, None, None)}
    flat = whitening.whitened(table([(i, [float(i), 7.0]) for i in range(5)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in flat} == {(1, False), (2, True)}
    assert {round(r["explained"], 9) for r in flat} == {0.0, 1.0} and flat[0]["identity_error"] < 1e-9
    one = whitening.whitened(table([(4, [0.5])])).collect()
    assert [(r["vec_id"], r["deviation"], r["whitened"]) for r in one] == [(4, 0, None)]


def test_large_entries_stay_exact(table):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-2.0**50, 2.0**50), rng.random()]) for i in range(4)]
    found = {r["vec_id"]: r["deviation"] for r in whitening.whitened(table(rows, "double")).collect()}
    assert set(found.values()) == {None}
    rows = [(i, [2.0**40 + i, float(i)]) for i in range(50)]
    found = {r["vec_id"]: r["deviation"] for r in whitening.whitened(table(rows, "double")).collect()}
    x = [[64 * (2**40 + i), 64 * i] for i in range(50)]
    assert found == {i: sum((50 * x[i][j] - sum(r[j] for r in x)) ** 2 for j in (0, 1)) for i in range(50)}


def test_no_vectors(table):
    assert whitening.whitened(table([])).count() == 0
    assert whitening.whitened(table([(1, None), (2, [])])).count() == 0


def _rotated(values, rng):
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


def test_split_of_hard_matrices():
    rng = np.random.default_rng(4)
    graded = rng.standard_normal((300, 30)) * np.logspace(0, -6, 30)
    low = rng.standard_normal((3, 20))
    for m in (
        graded.T @ graded,
        low.T @ low,
        np.eye(6),
        np.zeros((4, 4)),
        np.ones((9, 9)),
        np.diag([1.0, 1, 1, 2, 2, 5]),
        _rotated([1.0] * 10 + [2.0] * 5 + [0.0] * 5, rng),
        _rotated([1.0, 1 + 1e-12, 1 - 1e-12, 3.0], rng),
        np.array([[2.0]]),
    ):
        values, axes = spectral.components(m)
        size = np.linalg.norm(m) or 1
        assert np.allclose(values, np.linalg.eigvalsh(m)[::-1], atol=1e-13 * size)
        assert np.abs(axes.T @ axes - np.eye(len(m))).max() < 1e-13
        assert np.abs(m @ axes - axes * values).max() < 1e-13 * size


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(5)
    values = np.array([3.0, 1e-9, -1e-9, -2.0, 0.5])
    q = np.linalg.qr(rng.standard_normal((5, 5)))[0]
    assert np.allclose(spectral.polar(q @ np.diag(values) @ q.T), q @ np.diag(np.sign(values)) @ q.T, atol=1e-6)
