"""Model invariants: forest vote, prediction domain, confusion totals,
determinism, and the driver contract."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import features as FE
from quarry.operators import metrics as M
from quarry.operators import models as ML
from quarry.operators import trials as TR
from tests.conftest import SF001


@pytest.fixture(scope="module")
def flags_frame(spark):
    from quarry.plans.fixtures import flags
    return flags(spark, SF001, keys=False)


def test_forest_vote_ties_go_to_class_zero(spark, flags_frame):
    data = FE.relabel_pair(FE.class_pair_subset(flags_frame, (0.0, 2.0)), 2.0)
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vec = FE.assemble(data, feats).persist()
    model = ML.random_forest().fit(vec)
    voted = ML.forest_vote(model, vec)
    per_tree = vec
    for i, t in enumerate(model.trees):
        per_tree = ML.predict(t, per_tree, f"t{i}")
    ones = sum(F.col(f"t{i}") for i in range(len(model.trees)))
    expect = per_tree.select(F.when(ones * 2 > len(model.trees), 1.0).otherwise(0.0).alias("e"))
    got = [r["prediction"] for r in voted.select("prediction").collect()]
    assert got == [r["e"] for r in expect.collect()]
    assert set(got) <= {0.0, 1.0}
    vec.unpersist()


def test_svm_margin_and_prediction_agree(spark, flags_frame):
    data = FE.relabel_pair(FE.class_pair_subset(flags_frame, (0.0, 2.0)), 2.0)
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vec = FE.min_max_normalize(data, feats)
    vec = FE.assemble(vec, feats)
    model = ML.linear_svm().fit(vec)
    both = ML.predict(model, ML.svm_margin(model, vec))
    bad = both.filter((F.col("score") > 0) != (F.col("prediction") == 1.0)).count()
    assert bad == 0


def test_trial_is_deterministic_and_counts_add_up(spark):
    from quarry.plans.models import trial_frame
    frame = trial_frame(spark, SF001).persist()
    feats = [c for c in frame.columns if c not in ("label", TR.ROW)]
    a = TR.run_trial(spark, frame, feats, 1, parallelism=4)
    b = TR.run_trial(spark, frame, feats, 1, parallelism=2)
    assert a == b
    tests = [r[1] for r in a]
    assert tests == [n for n, _ in TR.RAW_MODELS] + [n for n, _ in TR.NORMALIZED_MODELS]
    n_test = frame.filter(TR.trial_side(1) == "test").count()
    for r in a:
        assert r[2] + r[3] + r[4] + r[5] == n_test
    frame.unpersist()


def test_repeated_rows_are_split_and_all_models_run(spark):
    # Two distinct rows, many copies: the row id splits the copies.
    rows = spark.createDataFrame([(float(i % 2), 1.0, 2.0) for i in range(400)],
                                 "label double, a double, b double")
    frame = TR.with_row_id(spark, rows)
    got = TR.repeated_holdout(spark, frame, iterations=2).collect()
    assert len(got) == 16
    for it in (1, 2):
        n = {r.fp + r.tn + r.tp + r.fn for r in got if r.iteration == it}
        assert len(n) == 1 and 100 < n.pop() < 220


def test_an_empty_side_is_an_error(spark):
    frame = TR.with_row_id(spark, spark.createDataFrame([(1.0, 2.0)], "label double, a double"))
    with pytest.raises(ValueError, match="no rows"):
        TR.run_trial(spark, frame, ["a"], 1)


def test_holdout_tree_metrics(spark):
    from quarry.plans.fixtures import CLASSES_7
    from quarry.plans.models import _tree_holdout
    model, tagged = _tree_holdout(spark, SF001)
    scored = ML.predict(model, tagged)
    preds = {r[0] for r in scored.select("prediction").distinct().collect()}
    assert preds <= set(CLASSES_7)
    s = M.multiclass_summary(scored, CLASSES_7, by=["split"]).collect()
    assert sorted(r["split"] for r in s) == ["cv", "test", "train"]
    assert sum(r["rows"] for r in s) == tagged.count()


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["word", "cnt"]
    assert 0 < df.count() <= 500
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


@pytest.fixture(scope="module")
def binary_sets(spark):
    """Cleaned clinical table (sf0.001), one 60/40 split, as DataFrames with
    vectors and as mllib LabeledPoint RDDs (tests only)."""
    from pyspark.mllib.linalg import Vectors as OldVectors
    from pyspark.mllib.regression import LabeledPoint

    from quarry.plans.models import trial_frame
    frame = trial_frame(spark, SF001)
    feats = [c for c in frame.columns if c not in ("label", TR.ROW)]
    side = TR.trial_side(1) == "train"
    train = FE.assemble(frame.filter(side), feats).coalesce(1).persist()
    test = FE.assemble(frame.filter(~side), feats).coalesce(1).persist()

    def to_rdd(df):
        return df.rdd.map(lambda r: LabeledPoint(r["label"], OldVectors.dense(r["features"].toArray())))

    yield train, test, to_rdd(train).cache(), to_rdd(test)
    train.unpersist()
    test.unpersist()


def _ml_preds(model, test):
    return [r["prediction"] for r in ML.score(model, test).select("prediction").collect()]


def test_tree_matches_mllib(spark, binary_sets):
    from pyspark.mllib.tree import DecisionTree
    train, test, train_rdd, test_rdd = binary_sets
    old = DecisionTree.trainClassifier(train_rdd, 2, {}, impurity="gini", maxDepth=4, maxBins=100)
    want = old.predict(test_rdd.map(lambda p: p.features)).collect()
    got = _ml_preds(ML.decision_tree().fit(train), test)
    assert got == want


def test_forest_vote_matches_mllib(spark, binary_sets):
    from pyspark.mllib.tree import RandomForest
    train, test, train_rdd, test_rdd = binary_sets
    old = RandomForest.trainClassifier(train_rdd, 2, {}, 2, featureSubsetStrategy="auto",
                                       impurity="gini", maxDepth=5, maxBins=32, seed=11)
    want = old.predict(test_rdd.map(lambda p: p.features)).collect()
    got = _ml_preds(ML.random_forest().fit(train), test)
    assert got == want


def test_logistic_regression_matches_mllib(spark, binary_sets):
    from pyspark.mllib.classification import LogisticRegressionWithLBFGS
    train, test, train_rdd, test_rdd = binary_sets
    old = LogisticRegressionWithLBFGS.train(train_rdd)
    new = ML.logistic_regression().fit(train)
    assert list(new.coefficients) == pytest.approx(list(old.weights), rel=1e-4, abs=1e-6)
    want = old.predict(test_rdd.map(lambda p: p.features)).collect()
    got = _ml_preds(new, test)
    assert sum(a != b for a, b in zip(got, want)) <= len(want) // 200


def test_boosting_matches_mllib(spark, binary_sets):
    from pyspark.mllib.tree import GradientBoostedTrees
    train, test, train_rdd, test_rdd = binary_sets
    old = GradientBoostedTrees.trainClassifier(train_rdd, {}, loss="logLoss", numIterations=10,
                                               learningRate=0.1, maxDepth=5, maxBins=32)
    want = old.predict(test_rdd.map(lambda p: p.features)).collect()
    got = _ml_preds(ML.gradient_boosted_trees().fit(train), test)
    assert sum(a != b for a, b in zip(got, want)) <= len(want) // 200


def test_models_beat_majority_on_separable_target(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    data = li.select((F.col("l_quantity") > 25).cast("double").alias("label"),
                     "l_quantity", "l_discount", "l_tax")
    feats = ["l_quantity", "l_discount", "l_tax"]
    scaled = FE.assemble(FE.min_max_normalize(data, feats), feats).persist()
    majority = max(scaled.agg(F.avg("label")).first()[0],
                   1 - scaled.agg(F.avg("label")).first()[0])
    for make in (ML.decision_tree, ML.logistic_regression, ML.random_forest,
                 ML.gradient_boosted_trees, ML.linear_svm):
        model = make().fit(scaled)
        acc = M.accuracy(ML.score(model, scaled)).first()["accuracy"]
        assert acc > majority + 0.1, (make.__name__, acc, majority)
    scaled.unpersist()
