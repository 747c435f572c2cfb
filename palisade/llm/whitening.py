"""Whitening of embeddings by their leading principal components.

Tasks add up exact integer sums, then centred products; the matrices they leave have one side a
vector dimension.  The driver makes the covariance tridiagonal by Householder reflections, finds
the leading eigenvalues by bisection on Sturm counts, their vectors by inverse iteration with
orthogonalisation inside clusters, and sends the components to the rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.common import unused
from palisade.llm.vectors import usable

COMPONENTS = 8
# Components become whole numbers floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
# Longer vectors are refused: the covariance of so many dimensions takes 128 MB.
DIMENSIONS = 4096
# Eigenvalues nearer than this share of the matrix norm are orthogonalised against one another.
CLUSTER = 1e-3
# Directions with less than this share of the variance count as none.
RANK_SHARE = 1e-12
_EPS = np.finfo(float).eps


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, reflectors) of a symmetric matrix.  Column k of the reflectors
    is the unit vector of step k, zero where the column needed none."""
    a = np.array(a, float)
    n = len(a)
    reflectors = np.zeros((n, max(0, n - 2)))
    for k in range(n - 2):
        x = a[k + 1 :, k]
        if not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * np.outer(v, w) + 2 * np.outer(w, v)
        x -= 2 * v * (v @ x)
        reflectors[k + 1 :, k] = v
    return a.diagonal().copy(), a.diagonal(-1).copy(), reflectors


def count_below(d: np.ndarray, e2: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each value of `at`: the negative
    pivots of its factorisation.  `e2` holds the squares of the off-diagonal."""
    tiny = np.finfo(float).tiny / _EPS
    floor = max(tiny, float(e2.max(initial=0)) * np.finfo(float).tiny)
    count = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i in range(len(d)):
        pivot = d[i] - at - (e2[i - 1] / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < floor, -floor, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of all of them at once."""
    n = len(d)
    reach = np.r_[np.abs(e), 0] + np.r_[0, np.abs(e)]
    low, high = float((d - reach).min()), float((d + reach).max())
    norm = max(abs(low), abs(high))
    low, high = low - 2 * _EPS * norm - 1e-300, high + 2 * _EPS * norm + 1e-300
    # The eigenvalue with `below` eigenvalues under it.
    below = n - 1 - np.arange(k)
    left, right, e2 = np.full(k, low), np.full(k, high), e * e
    for _ in range(200):
        middle = left + (right - left) / 2
        above = count_below(d, e2, middle) > below
        left, right = np.where(above, left, middle), np.where(above, middle, right)
        if np.all(right - left <= 2 * _EPS * np.maximum(np.abs(left), np.abs(right)) + _EPS * _EPS * norm):
            break
    return left + (right - left) / 2


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, floor: float) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges; zero pivots become `floor`."""
    n = len(d)
    main, upper, second = d - shift, np.r_[e, 0.0], np.zeros(n)
    lower, x = e.copy(), b.copy()
    for i in range(n - 1):
        if abs(lower[i]) > abs(main[i]):
            main[i], lower[i] = lower[i], main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(main[i]) < floor:
            main[i] = floor
        factor = lower[i] / main[i]
        main[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    if abs(main[-1]) < floor:
        main[-1] = floor
    for i in range(n - 1, -1, -1):
        total = x[i]
        if i + 1 < n:
            total -= upper[i] * x[i + 1]
        if i + 2 < n:
            total -= second[i] * x[i + 2]
        x[i] = total / main[i]
    return x


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (as columns) for falling eigenvalues, by inverse iteration.  A vector is
    kept orthogonal to those before it in its cluster."""
    n = len(d)
    reach = np.r_[np.abs(e), 0] + np.r_[0, np.abs(e)]
    norm = max(float((np.abs(d) + reach).max()), np.finfo(float).tiny)
    random = np.random.default_rng(23)
    out = np.zeros((n, len(values)))
    first, shift = 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # Shifts within a cluster are kept apart, or all would find the same vector.
        shift = value if j == first else min(value, shift - 10 * _EPS * norm)
        x = random.standard_normal(n)
        for _ in range(6):
            x = _solve(d, e, shift, x / np.linalg.norm(x), _EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            if not np.any(x):
                x = random.standard_normal(n)
        out[:, j] = x / np.linalg.norm(x)
    return out


def principal(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the k largest eigenvalues, their unit eigenvectors as columns) of a symmetric matrix."""
    d, e, reflectors = tridiagonal(a)
    values = leading_eigenvalues(d, e, min(k, len(a)))
    vectors = tridiagonal_vectors(d, e, values)
    for i in range(reflectors.shape[1] - 1, -1, -1):
        v = reflectors[:, i]
        vectors -= 2 * np.outer(v, v @ vectors)
    return values, vectors / np.linalg.norm(vectors, axis=0)


class Fit(NamedTuple):
    """What the rows are projected with."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - sums as whole numbers, x - sums / n) of whole-number rows."""
        apart = x * self.n - self.sums
        return apart, apart / self.n

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors / np.sqrt(self.values)


def _whole(batch: pa.RecordBatch, at: int, length: int) -> np.ndarray:
    """The whole-number vectors of a batch, one a row."""
    column = batch.column(at)
    flat = np.asarray(column.flatten(), np.float64).reshape(-1, length)
    return np.floor(flat * SCALE).astype(np.int64) + OFFSET


def squares(apart: np.ndarray) -> list[int]:
    """The exact sum of squares of each row of whole numbers, however large."""
    largest = int(np.abs(apart).max(initial=0))
    if largest * largest * max(1, apart.shape[1]) < 2**63:
        return (apart * apart).sum(1).tolist()
    return [sum(v * v for v in row) for row in apart.tolist()]


def _summed(parts: DataFrame, width: int, kind: type) -> np.ndarray:
    """Rows (i, values) of tasks added up by i, as one matrix; sums are taken in task order."""

    def add(key, table):
        table = table.sort_by("task")
        values = np.asarray(table["values"].combine_chunks().flatten(), kind).reshape(-1, width)
        total = values.sum(0)
        return pa.table({"i": [key[0].as_py()], "task": [0], "values": [total]}, schema=table.schema)

    found = parts.groupBy("i").applyInArrow(add, parts.schema).toArrow().sort_by("i")
    return np.asarray(found["values"].combine_chunks().flatten(), kind).reshape(found.num_rows, width)


def _partials(rows: DataFrame, of_batch, width: int, kind: str) -> DataFrame:
    """Each task's sum of the matrices that `of_batch` makes of its batches, as rows (i, task, values)."""

    def run(batches):
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(batch)
                total = part if total is None else total + part
        if total is not None:
            task = np.full(len(total), TaskContext.get().partitionId(), np.int32)
            values = pa.ListArray.from_arrays(
                np.arange(0, total.size + 1, width, dtype=np.int32), pa.array(total.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(task), values],
                names=["i", "task", "values"],
            )

    return rows.mapInArrow(run, f"i int, task int, values array<{kind}>")


def fit(rows: DataFrame, vector: str, length: int, components: int = COMPONENTS) -> Fit:
    """Sums, covariance and components of the vectors, each `length` long."""
    rows = rows.select(vector)

    def sums(batch):
        x = _whole(batch, 0, length)
        return np.r_[x.sum(0), len(x)][None, :]

    found = _summed(_partials(rows, sums, length + 1, "bigint"), length + 1, np.int64)[0]
    n, total = int(found[-1]), found[:-1]
    blank = Fit(n, total, np.zeros(0), np.zeros((length, 0)), 0.0)

    def products(batch):
        _, y = blank.centred(_whole(batch, 0, length))
        return y.T @ y

    covariance = _summed(_partials(rows, products, length, "double"), length, np.float64) / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, vectors = principal(covariance, components)
    true = values > RANK_SHARE * trace
    return Fit(n, total, values[true], vectors[:, true], trace)


def identity_error(rows: DataFrame, vector: str, length: int, model: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""
    k = len(model.values)
    if k == 0:
        return 0.0

    def moments(batch):
        _, y = model.centred(_whole(batch, 0, length))
        w = model.whitened(y)
        return np.c_[w.T @ w, w.sum(0)]

    found = _summed(_partials(rows.select(vector), moments, k + 1, "double"), k + 1, np.float64) / model.n
    mean = found[:, k]
    return float(np.abs(found[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """Add `whitened` (component int, value double) to every row with a usable vector, with
    `n`, `deviation` (decimal, exact), `explained` and `identity_error`.

    Component c becomes x = floor(1024 * c) + 100000; `whitened` is x less its mean, projected on the
    unit eigenvectors of the covariance in the order of falling eigenvalues, each over the
    root of its eigenvalue.  `explained` is an array like `whitened`: each eigenvalue's share of
    the trace.  There are at most `components`, fewer where the vectors span
    fewer directions, none where they are all equal or one alone.  `deviation` is the sum over
    dimensions of (n * x - sum)^2.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped; of vectors
    of several lengths the commonest is kept (ties: the longest).  Ids play no part, so they may
    be null or repeat; columns of the names added are replaced.  An empty table gives none.
    """
    kept = df.where(usable(vector) & (F.size(vector) > 0))
    sizes = kept.groupBy(F.size(vector).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("length")).first()
    added = "n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    names = ["n", "deviation", "whitened", "explained", "identity_error"]
    others = [c for c in df.columns if c.lower() not in names]
    if common is None:
        model, length, error = None, 0, 0.0
    else:
        length = common["length"]
        if length > DIMENSIONS:
            raise ValueError(f"vectors of {length} dimensions: at most {DIMENSIONS} are taken")
        kept = kept.where(F.size(vector) == length)
        model = fit(kept, vector, length, components)
        error = identity_error(kept, vector, length, model)

    def project(vectors):
        k = len(model.values)
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        x = _whole(pa.RecordBatch.from_arrays([vectors], names=["v"]), 0, length)
        rows = len(x)
        apart, y = model.centred(x)
        edges = np.arange(0, rows * k + 1, k, dtype=np.int32) if k else np.zeros(rows + 1, np.int32)
        share = np.tile(model.values / model.trace if k else model.values, rows)
        return pa.StructArray.from_arrays(
            [
                pa.array([model.n] * rows, pa.int64()),
                pa.array(squares(apart), pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(edges, pa.array(model.whitened(y).ravel())),
                pa.ListArray.from_arrays(edges, pa.array(share)),
                pa.array([error] * rows, pa.float64()),
            ],
            names=names,
        )

    found = unused(df, "found")
    out = kept.withColumn(found, F.arrow_udf(project, added)(F.col(vector)))
    return out.select(*[F.col(f"`{c}`") for c in others], f"{found}.*")
