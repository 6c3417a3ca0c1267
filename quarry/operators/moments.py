"""Second moments of a numeric table and the fits that need nothing else.

``moment_matrix`` is one aggregate over the data: tasks add up the products of
all pairs of columns and the sums are merged by (row, column) of the matrix, so
the driver gets the (p + 1) x (p + 1) result and never a row.  The elastic-net
sweep is then solved cell by cell on that matrix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.cleaning import _q
from quarry.operators.regression import SWEEP_ELASTIC_NET, lambda_grid
from quarry.sources.results import result_rows

#: Coordinate descent stops when no coefficient moves by more (standardised units).
TOLERANCE = 1e-12
SWEEPS = 100_000


class Moments(NamedTuple):
    """Rows, means and population covariances of the columns."""

    n: int
    mean: np.ndarray
    cov: np.ndarray


def moment_matrix(df: DataFrame, values: Column) -> Moments:
    """Moments of the components of ``values``, an array<double> column.

    Sums are taken around one row of the data, so that large means cost no
    digits.  A null or NaN component is an error, as it is for a model fit.
    """
    rows = df.select(values.alias("x"))
    first = rows.where(F.col("x").isNotNull()).first()
    if first is None:
        return Moments(0, np.zeros(0), np.zeros((0, 0)))
    origin = np.array(first["x"], dtype=np.float64)
    p = len(origin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p + 1, p + 1))
        for b in batches:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            if len(flat) != p * b.num_rows:
                raise ValueError("rows differ in their number of components")
            x = flat.reshape(b.num_rows, p) - origin
            if np.isnan(x).any():
                raise ValueError("null or NaN component")
            one = np.concatenate([np.ones((b.num_rows, 1)), x], axis=1)
            total += one.T @ one
        if total[0, 0]:
            i, j = np.triu_indices(p + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                names=["i", "j", "v"])

    sums = np.zeros((p + 1, p + 1))
    for r in rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] = sums[r["j"], r["i"]] = r["v"]
    n = sums[0, 0]
    shift = sums[0, 1:] / n
    return Moments(int(n), origin + shift, sums[1:, 1:] / n - np.outer(shift, shift))


def elastic_net(m: Moments, alpha: float, lam: float, start: np.ndarray | None = None) -> np.ndarray:
    """Standardised coefficients of the last column on the others: minimises
    b'Cb/2 - r'b + lam / sd(y) * (alpha |b| + (1 - alpha) / 2 b'b), C and r the
    correlations.  Without the absolute penalty this is one linear system,
    else coordinate descent with covariance updates.  Constant columns get 0."""
    p = len(m.mean) - 1
    sd = np.sqrt(np.maximum(np.diag(m.cov), 0.0))
    live = np.flatnonzero(sd[:p] > 1e-12 * np.maximum(1.0, np.abs(m.mean[:p])))
    b = np.zeros(p)
    if not sd[p] or not len(live):
        return b
    c = m.cov[np.ix_(live, live)] / np.outer(sd[live], sd[live])
    r = m.cov[live, p] / (sd[live] * sd[p])
    l1, l2 = lam * alpha / sd[p], lam * (1.0 - alpha) / sd[p]
    if not l1:
        b[live] = np.linalg.lstsq(c + l2 * np.eye(len(live)), r, rcond=None)[0]
        return b
    own = np.zeros(len(live)) if start is None else start[live].copy()
    left = r - c @ own  # correlations with the residual
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(own)):
            z = left[j] + own[j]
            new = np.sign(z) * max(abs(z) - l1, 0.0) / (1.0 + l2)
            if new != own[j]:
                left -= c[:, j] * (new - own[j])
                moved = max(moved, abs(new - own[j]))
                own[j] = new
        if moved < TOLERANCE:
            break
    b[live] = own
    return b


MOMENT_SWEEP_SCHEMA = T.StructType([
    T.StructField("elastic_net", T.DoubleType()), T.StructField("step", T.IntegerType()),
    T.StructField("reg_param", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("intercept", T.DoubleType()), T.StructField("r2", T.DoubleType())])


def lambda_sweep_moments(spark: SparkSession, df: DataFrame, features: Sequence[str], label: str,
                         alphas: Sequence[float] = SWEEP_ELASTIC_NET,
                         lambdas: Sequence[float] | None = None) -> DataFrame:
    """``(elastic_net, step, reg_param, coefficients, intercept, r2)`` of every
    grid cell for any number of features, from one pass over the data.

    The penalty is that of ``LinearRegression`` with its default
    standardisation; fits are taken to the optimum, where an iterative fit
    stops after its ``maxIter``.  R^2 of a constant label is null.
    """
    lambdas = list(lambdas) if lambdas is not None else lambda_grid()
    p = len(features)
    m = moment_matrix(df, F.array(*[_q(c).cast("double") for c in (*features, label)]))
    if not m.n:
        return spark.createDataFrame([], MOMENT_SWEEP_SCHEMA)
    sd = np.sqrt(np.maximum(np.diag(m.cov), 0.0))
    rows = []
    for alpha in alphas:
        b = None
        found = {}
        # From the strongest penalty down, each start is the last optimum.
        for step in sorted(range(len(lambdas)), key=lambda i: -lambdas[i]):
            b = elastic_net(m, float(alpha), float(lambdas[step]), b)
            found[step] = b
        for step, lam in enumerate(lambdas):
            slope = np.divide(found[step] * sd[p], sd[:p], out=np.zeros(p), where=sd[:p] > 0)
            var = m.cov[p, p]
            loss = var - 2.0 * slope @ m.cov[:p, p] + slope @ m.cov[:p, :p] @ slope
            rows.append((float(alpha), step, float(lam), [float(x) for x in slope],
                         float(m.mean[p] - slope @ m.mean[:p]), float(1.0 - loss / var) if var > 0 else None))
    return result_rows(spark, rows, MOMENT_SWEEP_SCHEMA)
