"""Model evaluation as aggregates over ``(prediction | score, label)``.

Every metric is a global or small-keyed aggregate with map-side partial
aggregation, so a class holding a third of the rows costs one partial row
per task, not a hot shuffle partition.  Class-wise metrics over a known
class list are one aggregate of ``count_if`` columns, turned into rows with
``inline`` -- no join, no shuffle of data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.cleaning import _q


def _c(c: str | Column) -> Column:
    return _q(c) if isinstance(c, str) else c


# --- counts -----------------------------------------------------------------

def label_distribution(df: DataFrame, label_col: str = "label",
                       classes: Sequence[float] | None = None) -> DataFrame:
    """``(label, n)``.  With ``classes`` every listed class appears (0 when
    absent) and other labels are ignored; without, the classes present."""
    if classes is None:
        return df.groupBy(_q(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    wide = df.agg(*[F.count_if(_q(label_col) == F.lit(float(k))).alias(f"n{i}")
                    for i, k in enumerate(classes)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(float(k)).alias("label"), F.col(f"n{i}").alias("n"))
        for i, k in enumerate(classes)])))


def margin_correct(score: str | Column, label: str | Column) -> Column:
    """A raw margin is right when negative for class 0 or positive for
    class 1; a margin of exactly 0.0 is wrong for both."""
    s, y = _c(score), _c(label)
    return ((s < 0.0) & (y == 0.0)) | ((s > 0.0) & (y == 1.0))


def correct_incorrect(df: DataFrame, ok: str | Column) -> DataFrame:
    """``(correct, incorrect)`` counts of a boolean column, one aggregate."""
    o = _c(ok)
    return df.agg(F.count_if(o).alias("correct"), F.count_if(~o).alias("incorrect"))


def confusion_exprs(prediction: str | Column = "prediction",
                    label: str | Column = "label") -> list[Column]:
    """Aggregate expressions: fp=(1,0), tn=(0,0), tp=(1,1), fn=(0,1) as
    (prediction, label) cells, plus accuracy and AUC of hard predictions."""
    p, y = _c(prediction), _c(label)
    fp = F.count_if((p == 1.0) & (y == 0.0))
    tn = F.count_if((p == 0.0) & (y == 0.0))
    tp = F.count_if((p == 1.0) & (y == 1.0))
    fn = F.count_if((p == 0.0) & (y == 1.0))
    return [fp.alias("fp"), tn.alias("tn"), tp.alias("tp"), fn.alias("fn")]


def hard_auc_expr() -> Column:
    """Area under ROC of 0/1 predictions, from confusion cells already
    aggregated as columns ``fp tn tp fn``: (TPR + TNR) / 2; null when a
    class is absent."""
    pos = F.col("tp") + F.col("fn")
    neg = F.col("tn") + F.col("fp")
    return F.when((pos > 0) & (neg > 0),
                  (F.col("tp") / pos + F.col("tn") / neg) / F.lit(2.0))


def confusion_counts(df: DataFrame, prediction: str = "prediction",
                     label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """``(*by, fp, tn, tp, fn, accuracy, auc)`` in one aggregate."""
    base = (df.groupBy(*[_q(c) for c in by]) if by else df.groupBy()).agg(
        *confusion_exprs(prediction, label))
    total = F.col("fp") + F.col("tn") + F.col("tp") + F.col("fn")
    return base.select(
        *[_q(c) for c in by], "fp", "tn", "tp", "fn",
        F.when(total > 0, (F.col("tp") + F.col("tn")) / total).alias("accuracy"),
        hard_auc_expr().alias("auc"))


def confusion_by_model(df: DataFrame, predictions: Sequence[tuple[str, str]],
                       label: str = "label", name_col: str = "test", count: str | None = None) -> DataFrame:
    """Confusion cells, accuracy and hard-prediction AUC for several
    prediction columns of the same rows, in ONE aggregate: ``predictions``
    is ``[(model name, prediction column), ...]``; one output row per model.
    A row of ``df`` stands for as many as its column ``count`` says."""
    y = _q(label)
    aggs = []

    def number(cond: Column) -> Column:
        return F.count_if(cond) if count is None else F.coalesce(F.sum(F.when(cond, _q(count))), F.lit(0).cast("long"))

    for i, (_, col) in enumerate(predictions):
        p = _q(col)
        aggs += [number((p == 1.0) & (y == 0.0)).alias(f"fp{i}"),
                 number((p == 0.0) & (y == 0.0)).alias(f"tn{i}"),
                 number((p == 1.0) & (y == 1.0)).alias(f"tp{i}"),
                 number((p == 0.0) & (y == 1.0)).alias(f"fn{i}")]
    wide = df.agg(*aggs)
    cells = wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias(name_col), F.col(f"fp{i}").alias("fp"),
                 F.col(f"tn{i}").alias("tn"), F.col(f"tp{i}").alias("tp"),
                 F.col(f"fn{i}").alias("fn"))
        for i, (name, _) in enumerate(predictions)])))
    total = F.col("fp") + F.col("tn") + F.col("tp") + F.col("fn")
    return cells.select(
        name_col, "fp", "tn", "tp", "fn",
        F.when(total > 0, (F.col("tp") + F.col("tn")) / total).alias("accuracy"),
        hard_auc_expr().alias("auc"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows with prediction == label."""
    return df.agg(F.avg((_q(prediction) == _q(label)).cast("double")).alias("accuracy"))


# --- class-wise precision ---------------------------------------------------

def class_stats(df: DataFrame, classes: Sequence[float], prediction: str = "prediction",
                label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """``(*by, label, n_label, n_predicted, tp, precision, rows, hits)`` per
    class of ``classes`` (and group of ``by``) from one aggregate; precision
    is 0.0 for a class never predicted; ``hits`` counts prediction == label
    over all rows of the group."""
    p, y = _q(prediction), _q(label)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(p == y).alias("hits")]
    for i, k in enumerate(classes):
        k = F.lit(float(k))
        aggs += [F.count_if(y == k).alias(f"l{i}"), F.count_if(p == k).alias(f"p{i}"),
                 F.count_if((p == k) & (y == k)).alias(f"t{i}")]
    keys = [_q(c) for c in by]
    wide = (df.groupBy(*keys) if keys else df.groupBy()).agg(*aggs)
    rows = wide.select(*keys, "rows", "hits", F.inline(F.array(*[
        F.struct(F.lit(float(k)).alias("label"), F.col(f"l{i}").alias("n_label"),
                 F.col(f"p{i}").alias("n_predicted"), F.col(f"t{i}").alias("tp"))
        for i, k in enumerate(classes)])))
    return rows.select(
        *keys, "label", "n_label", "n_predicted", "tp",
        F.when(F.col("n_predicted") > 0, F.col("tp") / F.col("n_predicted"))
        .otherwise(F.lit(0.0)).alias("precision"),
        "rows", "hits")


def multiclass_summary(df: DataFrame, classes: Sequence[float], prediction: str = "prediction",
                       label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """``(*by, rows, accuracy, weighted_precision)``: one aggregate over the
    data, then a second over ``len(classes)`` rows per group."""
    s = class_stats(df, classes, prediction, label, by)
    keys = [_q(c) for c in by]
    return (s.groupBy(*keys) if keys else s.groupBy()).agg(
        F.first("rows").alias("rows"),
        (F.first("hits") / F.first("rows")).alias("accuracy"),
        F.sum(F.col("n_label") / F.col("rows") * F.col("precision")).alias("weighted_precision"))


def precision_by_class(df: DataFrame, classes: Sequence[float], prediction: str = "prediction",
                       label: str = "label") -> DataFrame:
    return class_stats(df, classes, prediction, label).select("label", "precision")


def weighted_precision(df: DataFrame, classes: Sequence[float] | None = None,
                       prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Sum over label classes of (class share of rows) x precision(class).

    Without ``classes`` the classes are the labels present, however many:
    counts by (label, prediction) cell, then by label and by prediction."""
    if classes is not None:
        s = class_stats(df, list(classes), prediction, label)
        return s.agg(F.sum(F.col("n_label") / F.col("rows") * F.col("precision"))
                      .alias("weighted_precision"))
    # Each cell counts for its label and for its predicted class.
    cells = df.groupBy(_q(label).cast("double").alias("y"), _q(prediction).cast("double").alias("p")) \
        .agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("y").alias("k"), F.col("n").alias("n_label"), F.lit(0).cast("long").alias("n_pred"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("n_label"), F.col("n").alias("n_pred"),
                 F.lit(0).cast("long").alias("tp")))))
    by_class = sides.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n_label", "n_pred", "tp")])
    share = F.when(F.col("k").isNotNull() & (F.col("n_pred") > 0),
                   F.col("n_label") * F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    return by_class.agg((F.sum(share) / F.sum("n_label")).alias("weighted_precision"))


def weighted_precision_manual(df: DataFrame, classes: Sequence[float],
                              prediction: str = "prediction", label: str = "label") -> DataFrame:
    """The same number recomputed from its parts: the class distribution
    joined to the per-class precision (both ``len(classes)`` rows)."""
    dist = label_distribution(df, label, classes)
    prec = class_stats(df, classes, prediction, label).select("label", "precision", "rows")
    joined = dist.join(prec, "label")
    return joined.agg(F.sum(F.col("n") / F.col("rows") * F.col("precision"))
                      .alias("weighted_precision"))


# --- area under ROC from scores ---------------------------------------------

def auc_roc(df: DataFrame, score: str = "score", label: str = "label",
            ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve of raw scores (no binning).

    AUC = sum over distinct scores s of pos(s) * (2 * neg_below(s) + neg(s))
    / (2 * P * N).  Rows are first counted per distinct score (a hot score is
    one row from then on), the per-score table is range-partitioned into
    ``ranges`` (default: the session's shuffle partitions), ``neg_below`` is a
    running sum inside a range plus the sum of the ranges before it (one row
    per range).  Sums stay integral (decimal), so the result does not depend
    on partitioning.  Null when either class is absent.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pts = df.select(_q(score).cast("double").alias("s"), _q(label).cast("double").alias("y")) \
        .filter(F.col("s").isNotNull() & F.col("y").isNotNull())
    per = score_ranges(pts.groupBy("s").agg(F.count_if(F.col("y") == 1.0).alias("p"),
                                            F.count_if(F.col("y") != 1.0).alias("n")), ranges)
    dec = "decimal(38,0)"
    inside = Window.partitionBy("bk").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per.withColumn("below", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    term = F.col("p").cast(dec) * (F.lit(2).cast(dec) * F.col("below").cast(dec)
                                   + F.col("n").cast(dec))
    by_range = ranked.groupBy("bk").agg(F.sum(term).alias("num"), F.sum("p").alias("bp"),
                                        F.sum("n").alias("bn"))
    before = Window.orderBy("bk").rowsBetween(Window.unboundedPreceding, -1)
    cross = by_range.withColumn("off", F.coalesce(F.sum("bn").over(before), F.lit(0)))
    total = cross.agg(
        (F.sum("num") + F.lit(2).cast(dec) * F.sum(F.col("bp").cast(dec) * F.col("off").cast(dec)))
        .alias("num"), F.sum("bp").alias("P"), F.sum("bn").alias("N"))
    return total.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0),
               F.col("num").cast("double") / (F.lit(2.0) * F.col("P").cast("double")
                                              * F.col("N").cast("double")))
        .alias("auc"))


def score_ranges(per_score: DataFrame, ranges: int) -> DataFrame:
    """``per_score`` (one row per score ``s``) with the number ``bk`` of its
    range; ranges follow the order of the scores."""
    return per_score.repartitionByRange(ranges, "s").withColumn("bk", F.spark_partition_id())


def auc_hard(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Area under ROC when the score is a 0/1 prediction: (TPR + TNR) / 2."""
    return df.agg(*confusion_exprs(prediction, label)).select(hard_auc_expr().alias("auc"))
