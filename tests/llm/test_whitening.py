"""Eigenvectors and whitened rows against numpy, exact sums against Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from palisade.llm import whitening as W
from palisade.llm.queries import QUERIES


def symmetric(kind, n, seed=3):
    r = np.random.default_rng(seed)
    if kind == "random":
        a = r.standard_normal((n, n))
        return a + a.T
    if kind == "cluster":
        q, _ = np.linalg.qr(r.standard_normal((n, n)))
        values = np.r_[[5.0] * (n // 2), 5 + 1e-13, np.linspace(0, 1, n - n // 2 - 1)]
        return q @ np.diag(values) @ q.T
    if kind == "equal":
        return 3.0 * np.eye(n)
    if kind == "zero":
        return np.zeros((n, n))
    x = r.standard_normal((n, 2))
    return x @ x.T


@pytest.mark.parametrize("kind", ["random", "cluster", "equal", "zero", "low rank"])
@pytest.mark.parametrize("n", [1, 2, 3, 9, 64])
def test_principal(kind, n):
    a = symmetric(kind, n)
    a = (a + a.T) / 2
    k = min(8, n)
    values, vectors = W.principal(a, k)
    norm = max(1.0, np.abs(a).max())
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], atol=1e-12 * norm * n)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10
    assert np.abs(a @ vectors - vectors * values).max() < 1e-10 * norm * n


def test_counts_below():
    a = symmetric("random", 30)
    d, e, _ = W.tridiagonal(a)
    true = np.linalg.eigvalsh(a)
    at = np.r_[true - 1e-6, true + 1e-6, -1e9, 1e9]
    assert W.count_below(d, e * e, at).tolist() == [int((true < x).sum()) for x in at]


def test_squares_are_exact():
    small, large = np.array([[3, -4], [0, 1]]), np.array([[2**50 + 1, -(2**45)], [1, 2]])
    assert W.squares(small) == [25, 1]
    assert W.squares(large) == [(2**50 + 1) ** 2 + 2**90, 5]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, found int")


def test_rows(spark):
    r = np.random.default_rng(5)
    good = (r.standard_normal((300, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]).astype(np.float32)
    rows = [(i, v.tolist(), "clash", i) for i, v in enumerate(good)] + [
        (900, None, "x", 1), (901, [1.0, None] * 3, "x", 1), (902, [float("nan")] * 6, "x", 1),
        (903, [float("inf")] + [0.0] * 5, "x", 1), (904, [], "x", 1), (905, [1.0, 2.0], "x", 1),
        (None, good[0].tolist(), "x", 1), (7, good[7].tolist(), "x", 1),
    ]
    out = W.whiten(vectors(spark, rows).repartition(5), 4).collect()
    kept = np.r_[good, good[:1], good[7:8]].astype(float)
    x = np.floor(1024 * kept).astype(int) + 100_000
    n, total = len(x), x.sum(0)
    y = x - total / n
    true = np.linalg.eigvalsh(y.T @ y / n)[::-1]
    assert len(out) == n == 302 and {r.n for r in out} == {n}
    by_id = {r.vec_id: r for r in out}
    for i in (0, 7, 123):
        assert int(by_id[i].deviation) == sum(int(n * a - s) ** 2 for a, s in zip(x[i].tolist(), total.tolist()))
        assert by_id[i].found == i
    assert np.allclose(out[0].explained, (true / true.sum())[:4], rtol=1e-9)
    assert out[0].identity_error < 1e-9
    w = np.array([by_id[i].whitened for i in range(300)] + [by_id[None].whitened, by_id[7].whitened])
    assert np.allclose(w.T @ w / n, np.eye(4), atol=1e-9)
    # Whitened rows are the rows on unit eigenvectors, up to sign.
    _, v = np.linalg.eigh(y.T @ y / n)
    assert np.allclose(np.abs(w), np.abs(y @ v[:, ::-1][:, :4] / np.sqrt(true[:4])), atol=1e-7)


def test_odd_tables(spark):
    empty = vectors(spark, [])
    assert W.whiten(empty).count() == 0
    assert W.whiten(vectors(spark, [(1, None, "x", 1)])).count() == 0
    alone = W.whiten(vectors(spark, [(1, [1.0, 2.0], "x", 1)])).collect()
    assert [(r.vec_id, r.n, r.whitened, int(r.deviation)) for r in alone] == [(1, 1, [], 0)]
    flat = W.whiten(vectors(spark, [(i, [float(i), 1.0, float(2 * i)], "x", 1) for i in range(9)])).collect()
    assert {len(r.whitened) for r in flat} == {1} and flat[0].explained == [pytest.approx(1.0)]
    assert W.whiten(vectors(spark, [(i, [1.5], "x", 1) for i in range(4)])).select("whitened").first()[0] == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op12_whitening"].build(spark, folder).collect()
    data = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    x = np.array([[math.floor(1024 * c) + 100_000 for c in r.embedding] for r in data])
    n, total = x.shape[0], x.sum(0)
    y = x - total / n
    true, v = np.linalg.eigh(y.T @ y / n)
    true, v = true[::-1][:8], v[:, ::-1][:, :8]
    want = np.abs(y @ v / np.sqrt(true))
    at = {r.vec_id: i for i, r in enumerate(data)}
    assert len(rows) == 8 * n and {r.n for r in rows} == {n}
    assert all(abs(abs(r.whitened) - want[at[r.vec_id], r.component - 1]) < 1e-6 for r in rows)
    deviation = [sum(int(d) ** 2 for d in row) for row in (n * x - total).tolist()]
    assert all(r.deviation == deviation[at[r.vec_id]] for r in rows)
    assert max(r.identity_error for r in rows) < 1e-4
