"""Metrics against hand counts and against Spark ML's evaluators."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import metrics as M


def _pairs(spark, rows, names="prediction double, label double"):
    return spark.createDataFrame(rows, names)


def test_confusion_cells_and_hard_auc(spark):
    df = _pairs(spark, [(1.0, 0.0), (1.0, 1.0), (1.0, 1.0), (0.0, 0.0), (0.0, 1.0)])
    r = M.confusion_counts(df).first()
    assert (r["fp"], r["tn"], r["tp"], r["fn"]) == (1, 1, 2, 1)
    assert r["fp"] + r["tn"] + r["tp"] + r["fn"] == df.count()
    assert r["accuracy"] == pytest.approx(3 / 5)
    assert r["auc"] == pytest.approx((2 / 3 + 1 / 2) / 2)


def test_one_class_only_auc_is_null(spark):
    df = _pairs(spark, [(1.0, 1.0), (0.0, 1.0)])
    assert M.auc_hard(df).first()["auc"] is None
    scored = spark.createDataFrame([(0.3, 1.0), (0.1, 1.0)], "score double, label double")
    assert M.auc_roc(scored).first()["auc"] is None


def test_margin_zero_is_wrong_for_both_classes(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (2.0, 1.0), (2.0, 0.0)],
                               "score double, label double")
    r = M.correct_incorrect(df, M.margin_correct("score", "label")).first()
    assert (r["correct"], r["incorrect"]) == (2, 3)


def test_precision_class_never_predicted_and_absent(spark):
    # class 2 never predicted -> 0.0; class 3 absent from labels and predictions
    df = _pairs(spark, [(0.0, 0.0), (0.0, 2.0), (1.0, 1.0), (1.0, 0.0)])
    got = {r["label"]: r["precision"] for r in
           M.precision_by_class(df, [0.0, 1.0, 2.0, 3.0]).collect()}
    assert got == {0.0: 0.5, 1.0: 0.5, 2.0: 0.0, 3.0: 0.0}
    dist = {r["label"]: r["n"] for r in M.label_distribution(df, "label", [0.0, 1.0, 2.0, 3.0])
            .collect()}
    assert dist == {0.0: 2, 1.0: 1, 2.0: 1, 3.0: 0}


def test_weighted_precision_matches_evaluator(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randrange(4)), float(rnd.randrange(3))) for _ in range(500)]
    df = _pairs(spark, rows)
    lib = MulticlassClassificationEvaluator(metricName="weightedPrecision").evaluate(df)
    ours = M.weighted_precision(df).first()["weighted_precision"]
    manual = M.weighted_precision_manual(df, [0.0, 1.0, 2.0]).first()["weighted_precision"]
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert ours == pytest.approx(lib, abs=1e-12)
    assert manual == pytest.approx(lib, abs=1e-12)
    assert M.accuracy(df).first()["accuracy"] == pytest.approx(acc, abs=1e-12)
    s = M.multiclass_summary(df, [0.0, 1.0, 2.0]).first()
    assert s["accuracy"] == pytest.approx(acc) and s["weighted_precision"] == pytest.approx(lib)


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_auc_roc_matches_unbinned_evaluator_with_ties(spark, buckets):
    rnd = random.Random(buckets)
    rows = [(float(rnd.randrange(40)) / 4.0, float(rnd.random() < 0.4)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "score double, label double")
    raw = df.select(array_to_vector(F.array(-F.col("score"), F.col("score"))).alias("raw"),
                    "label")
    lib = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(raw)
    ours = M.auc_roc(df, ranges=buckets).first()["auc"]
    assert ours == pytest.approx(lib, abs=1e-12)


def test_auc_hard_equals_score_auc_of_predictions(spark):
    rnd = random.Random(9)
    rows = [(float(rnd.random() < 0.5), float(rnd.random() < 0.3)) for _ in range(800)]
    df = _pairs(spark, rows)
    a = M.auc_hard(df).first()["auc"]
    b = M.auc_roc(df.withColumnRenamed("prediction", "score")).first()["auc"]
    assert a == pytest.approx(b, abs=1e-12)


def test_weighted_precision_without_a_class_list_has_no_limit(spark):
    rnd = random.Random(4)
    rows = [(float(rnd.randrange(11000)), float(rnd.randrange(11000))) for _ in range(30000)]
    rows += [(float(k), float(k)) for k in range(11000)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    predicted, right, labels = {}, {}, {}
    for p, y in rows:
        predicted[p] = predicted.get(p, 0) + 1
        labels[y] = labels.get(y, 0) + 1
        right[y] = right.get(y, 0) + (p == y)
    want = sum(n / len(rows) * right[k] / predicted[k] for k, n in labels.items() if k in predicted)
    assert M.weighted_precision(df).first()[0] == pytest.approx(want, abs=1e-12)
