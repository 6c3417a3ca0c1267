"""Evaluation-metric queries over rule-based predictions on lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import metrics as M
from quarry.plans.fixtures import CLASSES_7, POINTS_SQL, points
from quarry.plans.registry import query

W = "WITH " + POINTS_SQL + "\n"
R = 10  # decimals kept for ratios compared across engines


def _r(c: str) -> F.Column:
    return F.round(F.col(c), R).alias(c)


@query("label_distribution", W + "\nUNION ALL\n".join(
    f"SELECT {k}::DOUBLE AS label, CAST(count_if(class_label = {k}) AS BIGINT) AS n FROM points"
    for k in CLASSES_7))
def q_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.label_distribution(points(spark, sf_dir), "class_label", CLASSES_7)


MARGIN_SQL = "((score < 0 AND label = 0) OR (score > 0 AND label = 1))"


@query("margin_correct", W + f"SELECT score, label, {MARGIN_SQL} AS correct FROM points")
def q_margin_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = points(spark, sf_dir)
    return p.select("score", "label", M.margin_correct("score", "label").alias("correct"))


@query("correct_incorrect", W + f"SELECT CAST(count_if({MARGIN_SQL}) AS BIGINT) AS correct, "
       f"CAST(count_if(NOT {MARGIN_SQL}) AS BIGINT) AS incorrect FROM points")
def q_correct_incorrect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.correct_incorrect(points(spark, sf_dir), M.margin_correct("score", "label"))


CONFUSION_SQL = W + """, c AS (
  SELECT CAST(count_if(prediction = 1 AND label = 0) AS BIGINT) AS fp,
         CAST(count_if(prediction = 0 AND label = 0) AS BIGINT) AS tn,
         CAST(count_if(prediction = 1 AND label = 1) AS BIGINT) AS tp,
         CAST(count_if(prediction = 0 AND label = 1) AS BIGINT) AS fn FROM points)
SELECT fp, tn, tp, fn,
  round(CASE WHEN fp + tn + tp + fn > 0 THEN (tp + tn) / (fp + tn + tp + fn) END, 10) AS accuracy,
  round(CASE WHEN tp + fn > 0 AND tn + fp > 0
        THEN (tp / (tp + fn) + tn / (tn + fp)) / 2.0::DOUBLE END, 10) AS auc
FROM c"""


@query("confusion_counts", CONFUSION_SQL)
def q_confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = M.confusion_counts(points(spark, sf_dir))
    return c.select("fp", "tn", "tp", "fn", _r("accuracy"), _r("auc"))


@query("auc_hard", W + """, c AS (
  SELECT count_if(prediction = 1 AND label = 0) AS fp, count_if(prediction = 0 AND label = 0) AS tn,
         count_if(prediction = 1 AND label = 1) AS tp, count_if(prediction = 0 AND label = 1) AS fn
  FROM points)
SELECT round(CASE WHEN tp + fn > 0 AND tn + fp > 0
       THEN (tp / (tp + fn) + tn / (tn + fp)) / 2.0::DOUBLE END, 10) AS auc FROM c""")
def q_auc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.auc_hard(points(spark, sf_dir)).select(_r("auc"))


@query("auc_roc", W + """, s AS (
  SELECT score, count_if(label = 1) AS p, count_if(label <> 1) AS n FROM points GROUP BY score),
c AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN
  CAST(sum(p * (2 * below + n)) AS DOUBLE) / (2.0::DOUBLE * CAST(sum(p) AS DOUBLE)
  * CAST(sum(n) AS DOUBLE)) END, 10) AS auc FROM c""")
def q_auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.auc_roc(points(spark, sf_dir), "score", "label").select(_r("auc"))


@query("accuracy", W + "SELECT round(avg(CASE WHEN class_prediction = class_label THEN 1.0 "
       "ELSE 0.0 END)::DOUBLE, 10) AS accuracy FROM points")
def q_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.accuracy(points(spark, sf_dir), "class_prediction", "class_label").select(
        _r("accuracy"))


def _precision_sql(k: float) -> str:
    return (f"CASE WHEN count_if(class_prediction = {k}) > 0 THEN "
            f"count_if(class_prediction = {k} AND class_label = {k}) "
            f"/ count_if(class_prediction = {k}) ELSE 0.0::DOUBLE END")


PRECISION_SQL = W + ", pc AS (" + "\nUNION ALL\n".join(
    f"SELECT {k}::DOUBLE AS label, count_if(class_label = {k}) AS n_label, count(*) AS n_rows, "
    f"{_precision_sql(k)} AS precision FROM points" for k in CLASSES_7) + ")\n"


@query("precision_by_class", PRECISION_SQL + "SELECT label, round(precision, 10) AS precision "
       "FROM pc")
def q_precision_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = M.precision_by_class(points(spark, sf_dir), CLASSES_7, "class_prediction", "class_label")
    return p.select("label", _r("precision"))


WEIGHTED_SQL = PRECISION_SQL + ("SELECT round(sum(n_label / n_rows * precision), 10) "
                                "AS weighted_precision FROM pc")


@query("weighted_precision", WEIGHTED_SQL)
def q_weighted_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = M.weighted_precision(points(spark, sf_dir), None, "class_prediction", "class_label")
    return w.select(_r("weighted_precision"))


@query("weighted_precision_manual", WEIGHTED_SQL)
def q_weighted_precision_manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = M.weighted_precision_manual(points(spark, sf_dir), CLASSES_7, "class_prediction",
                                    "class_label")
    return w.select(_r("weighted_precision"))
