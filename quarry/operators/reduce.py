"""Principal components and projection.

Two columns (the common case of a 2-D point table) use the closed form of
the 2x2 sample covariance: one aggregate of three moments, no driver-side
matrix.  More columns use ``pyspark.ml.feature.PCA`` (a distributed p x p
covariance, eigen-decomposed on the driver -- p is the feature count, not
the row count).  Components are sign-fixed so the largest-magnitude entry is
positive, which makes results comparable across engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.cleaning import _q, balanced_sum
from quarry.operators.features import assemble


def _fix_sign(v: list[float]) -> list[float]:
    big = max(range(len(v)), key=lambda i: abs(v[i]))
    return [-x for x in v] if v[big] < 0 else list(v)


def top_component_2d_frame(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``(x_loading, y_loading, eigenvalue, explained_ratio, x_mean,
    y_mean)``.

    a, b, d = var(x), cov(x, y), var(y) (sample); the top eigenvalue is
    ((a + d) + sqrt((a - d)^2 + 4 b^2)) / 2.  The eigenvector is taken as
    (lam - d, b) when a >= d and (b, lam - a) otherwise, which avoids the
    cancellation of the other form; b == 0 picks the axis of the larger
    variance.  Everything stays a Spark expression on the one-row aggregate.
    """
    m = df.agg(F.var_samp(_q(x).cast("double")).alias("a"),
               F.covar_samp(_q(x).cast("double"), _q(y).cast("double")).alias("b"),
               F.var_samp(_q(y).cast("double")).alias("d"),
               F.avg(_q(x).cast("double")).alias("x_mean"),
               F.avg(_q(y).cast("double")).alias("y_mean"))
    a, b, d = F.col("a"), F.col("b"), F.col("d")
    lam = ((a + d) + F.sqrt((a - d) * (a - d) + F.lit(4.0) * b * b)) / F.lit(2.0)
    m = m.withColumn("lam", lam)
    lam = F.col("lam")
    vx = F.when(b == 0.0, F.when(a >= d, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .when(a >= d, lam - d).otherwise(b)
    vy = F.when(b == 0.0, F.when(a >= d, F.lit(0.0)).otherwise(F.lit(1.0))) \
        .when(a >= d, b).otherwise(lam - a)
    m = m.withColumn("vx", vx).withColumn("vy", vy)
    norm = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy"))
    sign = F.when(F.abs(F.col("vx")) >= F.abs(F.col("vy")), F.signum(F.col("vx"))) \
        .otherwise(F.signum(F.col("vy")))
    return m.select(
        (sign * F.col("vx") / norm).alias("x_loading"),
        (sign * F.col("vy") / norm).alias("y_loading"),
        F.col("lam").alias("eigenvalue"),
        (F.col("lam") / (a + d)).alias("explained_ratio"),
        "x_mean", "y_mean")


def principal_components(df: DataFrame, cols: Sequence[str], k: int = 1
                         ) -> tuple[list[list[float]], list[float]]:
    """Top ``k`` components of ``cols``: (loadings as k lists of p numbers,
    explained-variance ratios).  Bounded output: k x p numbers."""
    cols = list(cols)
    if len(cols) == 2 and k == 1:
        r = top_component_2d_frame(df, cols[0], cols[1]).first()
        return [[r["x_loading"], r["y_loading"]]], [r["explained_ratio"]]
    vec = assemble(df.select(*[_q(c).cast("double").alias(c) for c in cols],
                             F.lit(0.0).alias("label")), cols)
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(vec)
    pc = model.pc.toArray()
    comps = [_fix_sign([float(pc[i, j]) for i in range(len(cols))]) for j in range(k)]
    return comps, [float(v) for v in model.explainedVariance.toArray()]


def projection_expr(cols: Sequence[str], loadings: Sequence[float],
                    means: Sequence[float] | None = None) -> Column:
    """sum_i (x_i - mean_i) * w_i as one JVM expression."""
    terms = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        if means is not None:
            x = x - F.lit(float(means[i]))
        terms.append(x * F.lit(float(loadings[i])))
    return balanced_sum(terms)


def project(df: DataFrame, cols: Sequence[str], components: Sequence[Sequence[float]],
            means: Sequence[float] | None = None, keep: Sequence[str] = (),
            prefix: str = "pc") -> DataFrame:
    """Project (optionally centred) rows on each component:
    ``(*keep, pc1, pc2, ...)``."""
    return df.select(*[_q(c) for c in keep],
                     *[projection_expr(cols, w, means).alias(f"{prefix}{j + 1}")
                       for j, w in enumerate(components)])


def pca_project(df: DataFrame, cols: Sequence[str], k: int = 1,
                keep: Sequence[str] = ()) -> DataFrame:
    """Centre, find the top ``k`` components, project.  Bounded driver
    round trips: one aggregate row for two columns; p means and k x p
    loadings otherwise."""
    cols = list(cols)
    if len(cols) == 2 and k == 1:
        # means, moments and the component from one aggregate
        r = top_component_2d_frame(df, cols[0], cols[1]).first()
        return project(df, cols, [[r["x_loading"], r["y_loading"]]],
                       [r["x_mean"], r["y_mean"]], keep)
    row = df.agg(*[F.avg(_q(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    means = [row[f"m{i}"] for i in range(len(cols))]
    comps, _ = principal_components(df, cols, k)
    return project(df, cols, comps, means, keep)


def pca_project_vectors(df: DataFrame, vector_col: str, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, pc1 .. pck)`` for a vector column of any length: centre, find
    the top ``k`` components, project.  The mean vector and the k loadings are
    what reaches the driver; rows stay one vector column."""
    mean = df.agg(Summarizer.mean(F.col(vector_col)).alias("m")).first()["m"]
    model = PCA(k=k, inputCol=vector_col, outputCol="__pc").fit(df)
    pc = model.pc.toArray()
    out = []
    for j in range(k):
        loadings = [float(x) for x in pc[:, j]]
        sign = 1.0 if _fix_sign(loadings) == loadings else -1.0
        shift = sign * sum(w * float(m) for w, m in zip(loadings, mean, strict=True))
        out.append((vector_to_array(F.col("__pc"))[j] * F.lit(sign) - F.lit(shift)).alias(f"pc{j + 1}"))
    return model.transform(df).select(*[_q(c) for c in keep], *out)
