"""Principal components of wide vectors by randomised subspace iteration.

The covariance of p components has p x p numbers; here it is never formed.
From a random block of k + ``OVERSAMPLE`` directions Q, each round computes C Q
as the sum over rows of (x - mean) ((x - mean)' Q): tasks return one p x l block
each, which Spark adds up component by component, and the driver orthogonalises
the p x l result and solves an l x l problem (Rayleigh-Ritz).  It ends when
C v = lambda v holds for the wanted components to ``TOLERANCE`` of the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OVERSAMPLE = 10
ROUNDS = 200
TOLERANCE = 1e-7


class Components(NamedTuple):
    """Unit vectors (k x p), eigenvalues of the sample covariance, total
    variance, mean, and how far C v is from lambda v, over the largest lambda."""

    vectors: np.ndarray
    eigenvalues: np.ndarray
    total: float
    mean: np.ndarray
    residual: float


def _matrix(column: pa.Array, p: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != p * len(column):
        raise ValueError("rows differ in their number of components")
    return flat.reshape(len(column), p)


def _summed(blocks: DataFrame, p: int, width: int) -> np.ndarray:
    """Sum of task blocks (i, v array): rows are exploded, so that the sums
    are spread over tasks by (i, j)."""
    out = np.zeros((p, width))
    cells = blocks.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    for i, j, x in cells.collect():
        out[i, j] = x
    return out


def subspace_components(df: DataFrame, values: Column, k: int = 1, seed: int = 5) -> Components:
    """The top ``k`` components of an array<double> column (null rows are left
    out).  ``k`` is cut to the number of components a row has."""
    rows = df.select(values.alias("x")).where(F.col("x").isNotNull())
    first = rows.first()
    if first is None:
        return Components(np.zeros((0, 0)), np.zeros(0), 0.0, np.zeros(0), 0.0)
    origin = np.array(first["x"], dtype=np.float64)
    p = len(origin)
    k, width = min(k, p), min(p, k + OVERSAMPLE)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p, 3))
        for b in batches:
            x = _matrix(b.column(0), p) - origin
            total += np.stack([np.full(p, len(x)), x.sum(axis=0), (x * x).sum(axis=0)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p, dtype=np.int32)),
                                          pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    s = _summed(rows.mapInArrow(sums, "i int, v array<double>"), p, 3)
    n = s[0, 0]
    mean = origin + s[:, 1] / n
    total = float((s[:, 2] - s[:, 1] ** 2 / n).sum() / max(1.0, n - 1))
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, width)))[0]
    vectors, eigen, residual = q[:, :k].T, np.zeros(k), 0.0
    for _ in range(ROUNDS):
        shared = df.sparkSession.sparkContext.broadcast((q, mean))

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, mean = shared.value  # noqa: B023
            out = np.zeros((p, q.shape[1]))
            for b in batches:
                x = _matrix(b.column(0), p) - mean
                out += x.T @ (x @ q)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p, dtype=np.int32)),
                                              pa.array(list(out), pa.list_(pa.float64()))], names=["i", "v"])

        z = _summed(rows.mapInArrow(product, "i int, v array<double>"), p, width) / max(1.0, n - 1)
        shared.destroy()
        lam, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        order = np.argsort(-lam)[:k]
        eigen, vectors = lam[order], (q @ turn[:, order]).T
        residual = float(np.abs(z @ turn[:, order] - (q @ turn[:, order]) * eigen).max() / max(eigen[0], 1e-300))
        if residual <= TOLERANCE or eigen[0] <= 0:
            break
        q = np.linalg.qr(z)[0]
    big = np.abs(vectors).argmax(axis=1)
    vectors = vectors * np.where(vectors[np.arange(k), big] < 0, -1.0, 1.0)[:, None]
    return Components(vectors, eigen, total, mean, residual)
