"""Exact order statistics and exact most frequent values without a global
sort or a shuffle of all values.

``exact_quantiles`` narrows a bracket around each wanted rank.  A mergeable
quantile sketch of bounded size proposes the bracket, counts check it, and what
is left is sketched again, so each round divides the rows in the bracket by
thousands; when few are left they are gathered.  Every round is one aggregate
for all columns and quantiles together.

``certified_top_k`` finds candidates with a mergeable heavy-hitter sketch,
counts them exactly in a second pass, and returns them only if the sketch's
error proves that nothing else can belong to the first ``k``; otherwise the
exact plan (count everything) answers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.cleaning import _q, columns_by_type
from quarry.operators.text import top_words, word_count
from quarry.sources.results import result_rows

QUARTILES = (0.25, 0.5, 0.75)
#: Accuracy of the sketch: a rank is right within rows / accuracy.
SKETCH_ACCURACY = 10_000
#: At most this many values of a bracket are gathered (per column and quantile).
GATHERED = 10_000


def _rank(n: int, q: float) -> int:
    """1-based rank of the discrete quantile: the first value with at least
    the share ``q`` of the rows up to it."""
    return max(1, n - math.floor(n - q * n))


def exact_quantiles(df: DataFrame, cols: Sequence[str] | None = None,
                    quantiles: Sequence[float] = QUARTILES, gathered: int = GATHERED,
                    accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """``(column_name, quantile, value)``: exact discrete quantiles of the
    filled values of numeric columns (null where a column has none).  NaN is
    above all numbers."""
    cols = list(cols) if cols is not None else columns_by_type(df, "numeric")
    value = {c: _q(c).cast("double") for c in cols}
    counts = df.agg(*[F.count(value[c]).alias(f"n{i}") for i, c in enumerate(cols)]).first() if cols else None
    targets = {(c, q): _rank(counts[f"n{i}"], q) for i, c in enumerate(cols) for q in quantiles if counts[f"n{i}"]}
    # Open targets: bracket (both ends inside), rows below it and rows in it.
    open_ = {k: (None, None, 0, counts[f"n{cols.index(k[0])}"]) for k in targets}
    found: dict[tuple[str, float], float] = {}

    def inside(key: tuple[str, float]) -> Column:
        lo, hi, _, _ = open_[key]
        x = value[key[0]]
        return x if lo is None else F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), x)

    while open_:
        few = [k for k, (_, _, _, m) in open_.items() if m <= gathered]
        if few:
            row = df.agg(*[F.sort_array(F.collect_list(inside(k))).alias(f"v{i}") for i, k in enumerate(few)]).first()
            for i, k in enumerate(few):
                found[k] = row[f"v{i}"][targets[k] - open_[k][2] - 1]
                del open_[k]
        todo = list(open_)
        if not todo:
            break
        aggs = []
        for i, k in enumerate(todo):
            _, _, below, m = open_[k]
            at, slack = (targets[k] - below) / m, 2.0 / accuracy
            aggs.append(F.percentile_approx(inside(k), [max(0.0, at - slack), min(1.0, at + slack)], accuracy)
                        .alias(f"p{i}"))
        proposed = df.agg(*aggs).first()
        aggs = []
        for i, k in enumerate(todo):
            x, (lo, hi) = inside(k), map(F.lit, proposed[f"p{i}"])
            aggs += [F.count_if(x < lo).alias(f"a{i}"), F.count_if(x == lo).alias(f"b{i}"),
                     F.count_if((x > lo) & (x < hi)).alias(f"c{i}"), F.count_if(x == hi).alias(f"d{i}"),
                     F.min(F.when(x > lo, x)).alias(f"lo{i}"), F.max(F.when(x < hi, x)).alias(f"hi{i}"),
                     F.min(x).alias(f"first{i}"), F.max(x).alias(f"last{i}")]
        row = df.agg(*aggs).first()
        for i, k in enumerate(todo):
            lo, hi = proposed[f"p{i}"]
            _, _, below, m = open_[k]
            left = targets[k] - below  # rank within the old bracket
            a, b, c, d = (row[f"{x}{i}"] for x in "abcd")
            if left <= a:  # below the proposal (the sketch was wrong)
                open_[k] = (row[f"first{i}"], _before(lo), below, a)
            elif left <= a + b:
                found[k] = lo
            elif left <= a + b + c:  # strictly between the ends
                open_[k] = (row[f"lo{i}"], row[f"hi{i}"], below + a + b, c)
            elif left <= a + b + c + (d if lo != hi else 0):
                found[k] = hi
            else:  # above it
                above = a + b + c + (d if lo != hi else 0)
                open_[k] = (_after(hi), row[f"last{i}"], below + above, m - above)
            if k in found:
                del open_[k]
    schema = T.StructType([T.StructField("column_name", T.StringType()), T.StructField("quantile", T.DoubleType()),
                           T.StructField("value", T.DoubleType())])
    return result_rows(df.sparkSession, [(c, float(q), found.get((c, q))) for c in cols for q in quantiles], schema)


def _before(x: float) -> float:
    return math.nextafter(x, -math.inf)


def _after(x: float) -> float:
    return math.nan if math.isinf(x) or math.isnan(x) else math.nextafter(x, math.inf)


# --- most frequent values -----------------------------------------------------

#: Values a task's sketch tracks; an untracked value stands at most
#: ``SKETCH_ERROR / TRACKED`` of all rows (the bound of frequent-items sketches).
TRACKED = 16_384
SKETCH_ERROR = 3.5


def certified_top_k(values: DataFrame, k: int = 500, col: str = "word", count_col: str = "cnt",
                    tracked: int = TRACKED, on_exact: Callable[[], None] | None = None) -> DataFrame:
    """The ``k`` most frequent values with their counts, ties by the value.

    Pass one sketches (one bounded sketch a task, merged on one row); pass two
    counts the sketch's candidates.  A value outside of them has at most the
    smallest candidate's estimate or the sketch's error; if the k-th count is
    larger, the answer is proven.  If not (flat counts), everything is counted.
    ``on_exact`` is called when that happens.
    """
    wanted = min(tracked, 4 * k)
    sketch = values.where(_q(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{col}`, {wanted}, {tracked})").alias("items")).first()
    items = [(r["item"], r["count"]) for r in sketch["items"]]
    error = SKETCH_ERROR / tracked * sketch["n"]
    if len(items) == wanted:  # others may be tracked, up to the last estimate
        error = max(error, items[-1][1])
    elif sum(c for _, c in items) == sketch["n"]:
        error = 0  # every value is a candidate, with its exact count
    nulls = values.where(_q(col).isNull()).limit(1).count()
    if items and not nulls:
        candidates = values.where(_q(col).isin([v for v, _ in items]))
        top = top_words(word_count(candidates, col, count_col), k, col, count_col)
        rows = [tuple(r) for r in top.collect()]
        if error == 0 or (len(rows) == k and rows[-1][1] > error):
            kind = values.schema[col].dataType
            return result_rows(values.sparkSession, rows, T.StructType([
                T.StructField(col, kind), T.StructField(count_col, T.LongType())]))
    if on_exact:
        on_exact()
    return top_words(word_count(values, col, count_col), k, col, count_col)
