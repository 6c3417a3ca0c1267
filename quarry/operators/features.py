"""Feature preparation: label handling, class pairs, deterministic splits,
kernel expansion, min-max scaling, centring, vector assembly.

Statistics (min, max, mean) come from one aggregate over all columns; the
transform is then a single projection with literal constants, which stays
inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.cleaning import NUMERIC_TYPES, _q

# The kernel expansion applied to each feature x, in order:
# x * (1 / sqrt(3)), x^2, x^3.
KERNEL_SCALE = 1.0 / math.sqrt(3.0)


# --- labels and class pairs -------------------------------------------------

def shift_label(df: DataFrame, label_col: str = "label", by: float = 1.0) -> DataFrame:
    """Classes 1..k -> 0..k-1."""
    return df.withColumn(label_col, _q(label_col) - F.lit(float(by)))


def class_pair_subset(df: DataFrame, keep: tuple[float, float],
                      label_col: str = "label") -> DataFrame:
    """Rows of the two classes in ``keep`` (the others filtered out)."""
    return df.filter(_q(label_col).isin(float(keep[0]), float(keep[1])))


def explode_pairs(df: DataFrame, pairs: Sequence[tuple[str, tuple[float, float]]],
                  label_col: str = "label") -> DataFrame:
    """Every row once per named class pair it belongs to (column ``pair``):
    all subsets of :func:`class_pair_subset` from one scan."""
    names = F.array_compact(F.array(*[
        F.when(_q(label_col).isin(float(a), float(b)), F.lit(name)) for name, (a, b) in pairs]))
    return df.withColumn("pair", F.explode(names))


def relabel_pair(df: DataFrame, positive: float, label_col: str = "label") -> DataFrame:
    """Two-class subset -> {0, 1}: ``positive`` becomes 1.0, the other 0.0."""
    return df.withColumn(label_col, F.when(_q(label_col) == F.lit(float(positive)), F.lit(1.0))
                         .otherwise(F.lit(0.0)))


# --- deterministic splits ---------------------------------------------------

#: Hash values of a split: the first 32 bits of an md5.
SPLIT_RANGE = 1 << 32


def split_bounds(weights: Sequence[float]) -> list[int]:
    """Upper hash bounds of all parts but the last."""
    total, upper, out = float(sum(weights)), 0.0, []
    for w in weights[:-1]:
        upper += w
        out.append(round(upper / total * SPLIT_RANGE))
    return out


def row_key(cols: Sequence[str], salt: int | str | None = None) -> Column:
    """A text key from key columns (``|``-joined), optionally salted."""
    parts = [_q(c).cast("string") for c in cols]
    if salt is not None:
        parts.append(F.lit(str(salt)))
    return F.concat_ws("|", *parts)


def split_column(key: Column, weights: Sequence[float], names: Sequence[str]) -> Column:
    """Name of the split each row falls in: its 32-bit hash (the first digits
    of ``md5(key)``, compared as hex digits, which sort as their numbers do)
    against the cumulative weights, so a share of any size gets its rows.

    Unlike ``randomSplit`` a split by it depends only on the row's key, not on
    partitioning or ordering, so a lost partition recomputes to the same
    rows and an independent engine can reproduce the split.
    """
    h = F.md5(key.cast("string"))
    expr = None
    for bound, name in zip(split_bounds(weights), names[:-1], strict=True):
        cond = h < F.lit(f"{bound:08x}" if bound < SPLIT_RANGE else "g")
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def hash_split(df: DataFrame, weights: Sequence[float], key: Column) -> list[DataFrame]:
    """``randomSplit`` replacement: one filtered DataFrame per weight."""
    names = [str(i) for i in range(len(weights))]
    tagged = df.withColumn("__split__", split_column(key, weights, names))
    return [tagged.filter(F.col("__split__") == n).drop("__split__") for n in names]


# --- kernel expansion -------------------------------------------------------

def kernel_terms(x, number: Callable = F.lit) -> list:
    """Of a column, or with ``number=float`` of an array of numbers."""
    return [x * number(KERNEL_SCALE), x * x, x * x * x]


def kernel_expand(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                  prefix: str = "k") -> DataFrame:
    """Each feature -> (x/sqrt(3), x^2, x^3), per feature in order; output
    columns ``{prefix}{i}`` for ``i`` in ``0 .. 3*len(cols)-1``."""
    out = [_q(c) for c in keep]
    i = 0
    for c in cols:
        for term in kernel_terms(_q(c).cast("double")):
            out.append(term.alias(f"{prefix}{i}"))
            i += 1
    return df.select(*out)


# --- min-max and centring ---------------------------------------------------

def min_max_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Per column (min, max), one aggregate job."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(_q(c).cast("double")).alias(f"lo{i}"),
                 F.max(_q(c).cast("double")).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def min_max_expr(x: Column, lo: float | None, hi: float | None) -> Column:
    """(x - min) / (max - min); a constant column gives 0.0."""
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(0.0))
    return (x - F.lit(float(lo))) / F.lit(float(hi) - float(lo))


def min_max_normalize(df: DataFrame, cols: Sequence[str],
                      stats: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """Scale ``cols`` to [0, 1] using this frame's own min and max (pass
    ``stats`` from another frame, e.g. the training set, to reuse them)."""
    stats = stats if stats is not None else min_max_stats(df, cols)
    todo = set(cols)
    return df.select(*[
        (min_max_expr(_q(c).cast("double"), *stats[c]) if c in todo else _q(c)).alias(c)
        for c in df.columns])


def feature_min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long table ``(column_name, min, max)`` from one aggregate."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(_q(c).cast("double")).alias(f"lo{i}"),
                 F.max(_q(c).cast("double")).alias(f"hi{i}")]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"lo{i}").alias("min"),
                 F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)])))


# --- the same on one vector column --------------------------------------------
# Statistics come from one ``Summarizer`` aggregate and rows are transformed by
# one higher-order expression, so the plan does not grow with the features.

def vector_stats(df: DataFrame, vector_col: str, *metrics: str) -> dict[str, list[float]]:
    """``min``, ``max`` and/or ``mean`` per component; empty lists without rows."""
    if df.isEmpty():
        return {m: [] for m in metrics}
    found = df.agg(Summarizer.metrics(*metrics).summary(_q(vector_col)).alias("s")).first()["s"]
    return {m: [float(x) for x in found[m]] for m in metrics}


def _zipped(x: Column, by: Sequence[Sequence[float]], f) -> Column:
    """Component i of ``x`` with the i-th of each list in ``by``."""
    params = [F.array(*[F.lit(float(v)) for v in values]) for values in by]
    return F.transform(x, lambda v, i: f(v, *[F.get(p, i) for p in params]))


def min_max_normalize_vector(df: DataFrame, vector_col: str = "features",
                             stats: dict[str, list[float]] | None = None) -> DataFrame:
    """The vector column scaled to [0, 1] per component; constant ones give 0.0."""
    stats = stats if stats is not None else vector_stats(df, vector_col, "min", "max")
    spans = [hi - lo for lo, hi in zip(stats["min"], stats["max"], strict=True)]
    scaled = _zipped(vector_to_array(_q(vector_col)), (stats["min"], spans),
                     lambda v, lo, span: F.when(span == 0.0, F.lit(0.0)).otherwise((v - lo) / span))
    return df.withColumn(vector_col, array_to_vector(scaled))


def mean_center_vector(df: DataFrame, vector_col: str = "features",
                       means: list[float] | None = None) -> DataFrame:
    """The vector column less its mean."""
    means = means if means is not None else vector_stats(df, vector_col, "mean")["mean"]
    return df.withColumn(vector_col, array_to_vector(_zipped(
        vector_to_array(_q(vector_col)), (means,), lambda v, m: v - m)))


def kernel_expand_vector(df: DataFrame, vector_col: str = "features") -> DataFrame:
    """Each component -> (x/sqrt(3), x^2, x^3), in order."""
    terms = F.flatten(F.transform(vector_to_array(_q(vector_col)), lambda v: F.array(*kernel_terms(v))))
    return df.withColumn(vector_col, array_to_vector(terms))


def column_means_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long table ``(column_name, mean)`` from one aggregate."""
    wide = df.agg(*[F.avg(_q(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean"))
        for i, c in enumerate(cols)])))


def mean_center(df: DataFrame, cols: Sequence[str],
                means: dict[str, float | None] | None = None) -> DataFrame:
    """Subtract each column's mean (one aggregate, then a projection)."""
    if means is None:
        row = df.agg(*[F.avg(_q(c).cast("double")).alias(f"m{i}")
                       for i, c in enumerate(cols)]).first()
        means = {c: row[f"m{i}"] for i, c in enumerate(cols)}
    todo = set(cols)
    return df.select(*[
        ((_q(c).cast("double") - F.lit(means[c])) if c in todo else _q(c)).alias(c)
        for c in df.columns])


# --- assembly ---------------------------------------------------------------

def to_double_or_zero(df: DataFrame, c: str, booleans: bool = True) -> Column:
    """Numeric -> double, null -> 0.0, text -> 0.0; booleans -> 0/1 when
    ``booleans`` (else 0.0)."""
    dt = df.schema[c].dataType
    if isinstance(dt, NUMERIC_TYPES):
        return F.coalesce(_q(c).cast("double"), F.lit(0.0))
    if isinstance(dt, T.BooleanType) and booleans:
        return F.coalesce(_q(c).cast("double"), F.lit(0.0))
    return F.lit(0.0)


def numeric_frame(df: DataFrame, label_col: str, feature_cols: Sequence[str] | None = None,
                  booleans: bool = True) -> DataFrame:
    """``(label, *features)`` as doubles with nulls and text as 0.0."""
    feats = list(feature_cols) if feature_cols is not None else [
        c for c in df.columns if c != label_col]
    return df.select(to_double_or_zero(df, label_col, booleans).alias("label"),
                     *[to_double_or_zero(df, c, booleans).alias(c) for c in feats])


def assemble(df: DataFrame, feature_cols: Sequence[str], label_col: str = "label",
             out_col: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``(label, features)`` with a dense vector of ``feature_cols``."""
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out_col,
                         handleInvalid="error")
    return va.transform(df).select(*[_q(c) for c in keep], _q(label_col).alias("label"),
                                   F.col(out_col))


def assemble_features(df: DataFrame, label_col: str, feature_cols: Sequence[str] | None = None,
                      booleans: bool = True) -> DataFrame:
    """Row -> (label, dense vector of every other column), nulls and text
    as 0.0."""
    frame = numeric_frame(df, label_col, feature_cols, booleans)
    return assemble(frame, [c for c in frame.columns if c != "label"])


def unpack_vector(df: DataFrame, vec_col: str, n: int, prefix: str = "f",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Vector column -> ``n`` double columns ``{prefix}0..``."""
    arr = vector_to_array(F.col(vec_col))
    return df.select(*[_q(c) for c in keep],
                     *[arr[i].alias(f"{prefix}{i}") for i in range(n)])
