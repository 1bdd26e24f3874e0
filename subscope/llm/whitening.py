"""Whitening of vectors: spectral divide and conquer on their covariance, then one broadcast matrix for all rows.

Exact integer sums of the rounded entries come first; they centre the rows, whose products are summed by task and then by
row of the covariance. That matrix (dimensions squared, whatever the number of vectors) is what the driver sees. Its
components come from polar decompositions (`spectral`), and tasks apply them to all vectors.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import ship_code
from subscope.llm.spectral import components
from subscope.llm.vectors import dimension, finite_rows

SCALE = 64
OFFSET = 1_000_000
#: Entries beyond have no long.
LARGEST = 2.0**56
COMPONENTS = 32

SUMS = "j int, total decimal(38,0), n long"
PARTS = "i int, part long, row array<double>"
WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
_MASK = (1 << 64) - 1


class Fit(NamedTuple):
    """Exact sums of the rounded vectors, and their components: `scaled` projects centred vectors to unit variance."""

    n: int
    sums: list
    values: np.ndarray
    trace: float
    scaled: np.ndarray


def _rounded(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and their entries as rounded integers."""
    kept, matrix = finite_rows(column, dims)
    fits = (np.abs(matrix) < LARGEST).all(axis=1)
    kept[np.flatnonzero(kept)[~fits]] = False
    return kept, np.floor(SCALE * matrix[fits]).astype(np.int64) + OFFSET


def _centred(x: np.ndarray, n: int, sums: list) -> np.ndarray:
    """x - sums / n; the whole part is taken off as integers, so that nothing cancels."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole) - rest


def _summed(dims: int):
    def sums(batches):
        n, total = 0, [0] * dims
        for batch in batches:
            _, x = _rounded(batch.column(0), dims)
            n += len(x)
            high, low = (x >> 24).sum(axis=0).tolist(), (x & 0xFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 24) + lo for t, h, lo in zip(total, high, low)]
        if n:
            columns = [
                pa.array(range(dims), pa.int32()),
                pa.array(map(Decimal, total), pa.decimal128(38, 0)),
                pa.array([n] * dims, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["j", "total", "n"])

    return sums


def _products(dims: int, n: int, sums: list, scaled: np.ndarray | None):
    """The rows of sum(y y') over a task's centred vectors y, or over their whitened forms and then their sum."""

    def products(batches):
        size = dims if scaled is None else scaled.shape[1]
        total = np.zeros((size + 1, size))
        for batch in batches:
            y = _centred(_rounded(batch.column(0), dims)[1], n, sums)
            y = y if scaled is None else y @ scaled
            total[:size] += y.T @ y
            total[size] += y.sum(axis=0)
        columns = [
            pa.array(range(size + 1), pa.int32()),
            pa.array([TaskContext.get().partitionId()] * (size + 1), pa.int64()),
            pa.array(list(total), pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "part", "row"])

    return products


def _added(batches):
    """The sum of each i over parts, which come in order."""
    last, total = None, None
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(2)):
            row = row.values.to_numpy()
            if i == last:
                total = total + row
                continue
            if last is not None:
                yield _one(last, total)
            last, total = i, row
    if last is not None:
        yield _one(last, total)


def _one(i, row):
    return pa.RecordBatch.from_arrays(
        [pa.array([i], pa.int32()), pa.array([0], pa.int64()), pa.array([row], pa.list_(pa.float64()))], names=["i", "part", "row"]
    )


def _covariance(vectors: DataFrame, dims: int, n: int, sums: list, scaled: np.ndarray | None = None) -> np.ndarray:
    """Divisor n. What is left of the mean after centring is rounding, and taken off too."""
    parts = vectors.mapInArrow(_products(dims, n, sums, scaled), PARTS)
    added = parts.repartition("i").sortWithinPartitions("i", "part").mapInArrow(_added, PARTS)
    rows = np.array([row["row"] for row in sorted(added.collect(), key=lambda row: row["i"])])
    mean = rows[-1] / n
    return rows[:-1] / n - np.outer(mean, mean)


def fitted(vectors: DataFrame, dims: int, most: int = COMPONENTS) -> Fit | None:
    """The fit of a one-column table of vectors; None if none takes part.

    Components whose variance is nothing but rounding have NaN in `scaled`.
    """
    sums = vectors.mapInArrow(_summed(dims), SUMS).groupBy("j").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    found = sorted(sums.collect(), key=lambda row: row["j"])
    if not found:
        return None
    n, totals = found[0]["n"], [int(row["total"]) for row in found]
    covariance = _covariance(vectors, dims, n, totals)
    values, axes = components(covariance)
    values = np.maximum(values, 0)
    k = min(most, dims)
    real = values[:k] > dims * np.finfo(np.float64).eps * max(values[0], 0)
    scaled = np.full((dims, k), np.nan)
    scaled[:, real] = axes[:, :k][:, real] / np.sqrt(values[:k][real])
    return Fit(n, totals, values, float(np.trace(covariance)), scaled)


def _deviations(x: np.ndarray, fit: Fit) -> pa.Array:
    """sum((n x - S)**2), exact; null where it has no long.

    Differences and sums that fit into a long are exact in arithmetic modulo 2**64, even where n x does not fit.
    """
    sums = np.array([s & _MASK for s in fit.sums], dtype=np.uint64).view(np.int64)
    estimate = float(fit.n) ** 2 * (_centred(x, fit.n, fit.sums) ** 2).sum(axis=1)
    exact = ((x * np.int64(fit.n) - sums) ** 2).sum(axis=1)
    out = exact.tolist()
    for i in np.flatnonzero(estimate >= 9e18).tolist():
        value = sum((fit.n * a - s) ** 2 for a, s in zip(x[i].tolist(), fit.sums))
        out[i] = value if value < 1 << 63 else None
    return pa.array(out, pa.int64())


def _whiten(dims: int, fit: Fit, identity_error: float | None):
    k = fit.scaled.shape[1]
    explained = (fit.values[:k] / fit.trace).tolist() if fit.trace > 0 else [None] * k

    def whiten(batches):
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.slice(at, 2000)
                kept, x = _rounded(part.column(1), dims)
                rows = np.repeat(np.arange(len(x)), k)
                z = (_centred(x, fit.n, fit.sums) @ fit.scaled).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).filter(pa.array(kept)).take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(z), fit.n)),
                        _deviations(x, fit).take(pa.array(rows)),
                        pa.array(z, mask=np.isnan(z)),
                        pa.array(explained * len(x), pa.float64()),
                        pa.array([identity_error] * len(z), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whiten


def whitened(df: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per vector and component (COMPONENTS at most, numbered from 1 by falling variance) its whitened coordinate.

    Vectors that are null, hold null or non-finite entries, differ from the most frequent length, or hold entries of
    LARGEST or more are left out, of the fit too. An entry c counts as floor(64 c) + 1000000. `n` is the number of
    vectors that take part, `deviation` the exact sum of (n x - S)**2 (null beyond a long), `explained` the share of
    the component in all variance (null if there is none), `identity_error` the largest entry of the covariance of the
    result less the identity, measured on all rows (null without variance).

    Components whose variance is nothing but rounding have null in `whitened` and do not enter `identity_error`.
    Repeated rows and repeated ids count and return once each, null ids too; other columns are ignored. A table
    without vectors gives no rows.
    """
    spark = df.sparkSession
    ship_code(spark)
    vectors = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    dims = dimension(vectors, "v")
    fit = fitted(vectors.select("v"), dims) if dims else None
    if fit is None:
        return spark.createDataFrame([], WHITENED)
    real = ~np.isnan(fit.scaled[0])
    error = None
    if real.any():
        own = _covariance(vectors.select("v"), dims, fit.n, fit.sums, fit.scaled[:, real])
        error = float(np.abs(own - np.eye(int(real.sum()))).max())
    return vectors.mapInArrow(_whiten(dims, fit, error), WHITENED)
