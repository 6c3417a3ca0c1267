"""Linear regression with elastic-net regularisation and the
regularisation sweep.

One feature: the fitted slope has a closed form in the first two moments
(population variance and covariance), matching ``LinearRegression`` with its
default standardisation, so a whole (alpha, lambda) grid costs ONE pass over
the data: an aggregate row, exploded into the grid and evaluated as column
expressions.  More features: ``LinearRegression`` per grid cell on a
persisted frame (the data is read once, each fit is distributed).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.cleaning import _q
from quarry.operators.features import assemble
from quarry.sources.results import result_rows

# The sweep the reference runs.  Elastic-net mixes, then
# lambda from 0.0 by repeated addition of 0.1 while not above 10.05.
SWEEP_ELASTIC_NET = (0.0, 0.13, 1.0)
SWEEP_LAMBDA_START, SWEEP_LAMBDA_END, SWEEP_LAMBDA_STEP = 0.0, 10.05, 0.1
MAX_ITER = 10


def lambda_grid(start: float = SWEEP_LAMBDA_START, end: float = SWEEP_LAMBDA_END,
                step: float = SWEEP_LAMBDA_STEP) -> list[float]:
    """Lambdas by accumulated addition (so the last is 9.99999999999998,
    as a running float sum gives)."""
    out, lam = [], start
    while lam <= end:
        out.append(lam)
        lam += step
    return out


def moments_frame(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, means, population variances and covariance."""
    xc, yc = _q(x).cast("double"), _q(y).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(xc).alias("mx"), F.avg(yc).alias("my"),
                  F.var_pop(xc).alias("vx"), F.var_pop(yc).alias("vy"),
                  F.covar_pop(xc, yc).alias("cxy"))


def _soft(z: Column, g: Column) -> Column:
    return F.signum(z) * F.greatest(F.abs(z) - g, F.lit(0.0))


def closed_form_cols(alpha: Column, lam: Column) -> tuple[Column, Column, Column]:
    """Slope, intercept and R^2 from the moment columns of
    :func:`moments_frame`, for elastic-net mix ``alpha`` and strength
    ``lam`` (penalty on the standardised slope, label scale folded in)."""
    vx, vy, cxy = F.col("vx"), F.col("vy"), F.col("cxy")
    xs, ys = F.sqrt(vx), F.sqrt(vy)
    slope = _soft(cxy, lam * alpha * xs) / (vx + lam * (F.lit(1.0) - alpha) * vx / ys)
    intercept = F.col("my") - slope * F.col("mx")
    r2 = F.lit(1.0) - (vy - F.lit(2.0) * slope * cxy + slope * slope * vx) / vy
    return slope, intercept, r2


def lambda_sweep_1d(df: DataFrame, x: str, y: str,
                    alphas: Sequence[float] = SWEEP_ELASTIC_NET,
                    lambdas: Sequence[float] | None = None) -> DataFrame:
    """``(elastic_net, step, reg_param, coefficient, intercept, r2)`` for
    every grid cell, from one aggregate pass."""
    lambdas = list(lambdas) if lambdas is not None else lambda_grid()
    grid = F.array(*[F.struct(F.lit(float(a)).alias("elastic_net"), F.lit(i).alias("step"),
                              F.lit(float(lam)).alias("reg_param"))
                     for a in alphas for i, lam in enumerate(lambdas)])
    cells = moments_frame(df, x, y).select("*", F.inline(grid))
    slope, intercept, r2 = closed_form_cols(F.col("elastic_net"), F.col("reg_param"))
    return cells.select("elastic_net", "step", "reg_param", slope.alias("coefficient"),
                        intercept.alias("intercept"), r2.alias("r2"))


def linear_regression_1d(df: DataFrame, x: str, y: str, reg_param: float,
                         elastic_net: float) -> DataFrame:
    """One closed-form fit: ``(coefficient, intercept, r2)``."""
    slope, intercept, r2 = closed_form_cols(F.lit(float(elastic_net)), F.lit(float(reg_param)))
    return moments_frame(df, x, y).select(slope.alias("coefficient"),
                                          intercept.alias("intercept"), r2.alias("r2"))


def linear_regression(reg_param: float = 0.0, elastic_net: float = 0.0,
                      max_iter: int = MAX_ITER) -> LinearRegression:
    """The estimator the reference configures: ``maxIter`` 10, given
    lambda and elastic-net mix, defaults otherwise."""
    return LinearRegression(maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net)


def fit_linear(df: DataFrame, features: Sequence[str], label: str, reg_param: float = 0.0,
               elastic_net: float = 0.0, max_iter: int = MAX_ITER):
    data = assemble(df.select(*[_q(c).cast("double").alias(c) for c in features],
                              _q(label).cast("double").alias("label")), list(features))
    return linear_regression(reg_param, elastic_net, max_iter).fit(data)


SWEEP_SCHEMA = T.StructType([
    T.StructField("elastic_net", T.DoubleType()), T.StructField("step", T.IntegerType()),
    T.StructField("reg_param", T.DoubleType()), T.StructField("r2", T.DoubleType())])


def lambda_sweep_ml(spark: SparkSession, df: DataFrame, features: Sequence[str], label: str,
                    alphas: Sequence[float] = SWEEP_ELASTIC_NET,
                    lambdas: Sequence[float] | None = None,
                    max_iter: int = MAX_ITER, parallelism: int = 8) -> DataFrame:
    """Grid sweep with ``LinearRegression`` per cell (any feature count).

    The assembled frame is persisted once and released at the end; cells are
    fitted from a small thread pool, and the result holds one small row per
    cell (R^2 from the training summary).
    """
    lambdas = list(lambdas) if lambdas is not None else lambda_grid()
    data = assemble(df.select(*[_q(c).cast("double").alias(c) for c in features],
                              _q(label).cast("double").alias("label")), list(features)).persist()

    def cell(at: tuple[float, int]) -> tuple:
        alpha, step = at
        model = linear_regression(lambdas[step], alpha, max_iter).fit(data)
        return (alpha, step, float(lambdas[step]), float(model.summary.r2))

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = list(pool.map(cell, [(float(a), i) for a in alphas for i in range(len(lambdas))]))
    finally:
        data.unpersist()
    return result_rows(spark, rows, SWEEP_SCHEMA)


def sweep_report(sweep: DataFrame, r2_places: int = 8) -> DataFrame:
    """Printable rows: lambda rendered with one decimal, R^2 rounded."""
    return sweep.select("elastic_net", "step",
                        F.format_string("%.1f", F.col("reg_param")).alias("lambda_text"),
                        F.round(F.col("r2"), r2_places).alias("r2"))
