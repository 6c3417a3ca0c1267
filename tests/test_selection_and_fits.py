"""Exact quantiles, certified top-k, moment-matrix sweep, gradient-descent SVM,
tree tables, subspace PCA, vector-column transforms, bucketed semi join and the
trial ledger."""

import collections
import math
import random
import threading

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarry.operators import cleaning as C
from quarry.operators import features as FE
from quarry.operators import models as ML
from quarry.operators import moments as MO
from quarry.operators import regression as RG
from quarry.operators import selection as SE
from quarry.operators import subspace as SU
from quarry.operators import tree_fits as TF
from quarry.operators import trees as TB
from quarry.operators import trials as TR
from quarry.session import clear_shared
from tests.conftest import SF001, plan_text

# --- quantiles ----------------------------------------------------------------


def disc(values, q):
    values = sorted(v for v in values if v is not None)
    return values[max(1, len(values) - math.floor(len(values) - q * len(values))) - 1] if values else None


@pytest.mark.parametrize("gathered,accuracy", [(10_000, 10_000), (3, 60)])
def test_exact_quantiles_with_ties_nulls_and_tails(spark, gathered, accuracy):
    rng = random.Random(gathered)
    n = 700
    cols = {"ties": [float(rng.randint(0, 3)) for _ in range(n)], "flat": [5.0] * n,
            "halves": [0.0] * (n // 2) + [1.0] * (n // 2),
            "tail": [10.0 ** rng.randint(-300, 300) * rng.choice([-1, 1]) for _ in range(n)],
            "holes": [None if rng.random() < 0.6 else rng.gauss(0, 1) for _ in range(n)],
            "none": [None] * n, "one": [None] * (n - 1) + [2.5],
            "inf": [float("inf") if i % 3 else float(i) for i in range(n)]}
    rows = list(zip(*cols.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {(r.column_name, r.quantile): r.value
           for r in SE.exact_quantiles(df, quantiles=(0.0, 0.25, 0.5, 0.75, 0.999, 1.0), gathered=gathered,
                                       accuracy=accuracy).collect()}
    assert got == {(c, q): disc(v, q) for c, v in cols.items() for q in (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)}


def test_exact_quantiles_of_integers_and_nothing(spark):
    df = spark.range(0, 1001).selectExpr("id", "cast(id as string) t")
    assert [r.value for r in SE.exact_quantiles(df, ["id"], gathered=2, accuracy=20).collect()] == [250.0, 500.0, 750.0]
    assert [r.value for r in SE.exact_quantiles(df.limit(0), ["id"]).collect()] == [None] * 3
    assert SE.exact_quantiles(df.select("t")).count() == 0


# --- most frequent values ------------------------------------------------------

def test_certified_top_k_equals_full_count(spark):
    rng = random.Random(3)
    words = [f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(20_000)] + [None, ""]
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(6)
    want = sorted(((w, n) for w, n in collections.Counter(words).items()), key=lambda x: (-x[1], x[0] or ""))
    exact = []
    got = SE.certified_top_k(df.where("word is not null"), 20, on_exact=lambda: exact.append(1))
    assert [tuple(r) for r in got.orderBy(F.desc("cnt"), "word").collect()] == [x for x in want if x[0] is not None][:20]
    assert not exact
    nulls = SE.certified_top_k(df, 20, on_exact=lambda: exact.append(1))
    assert exact and sorted(nulls.collect()) == sorted(SE.top_words(SE.word_count(df), 20).collect())


def test_flat_counts_are_counted_in_full(spark):
    df = spark.range(0, 5000).select(F.concat(F.lit("v"), F.col("id") % 2500).alias("word"))
    exact = []
    got = SE.certified_top_k(df, 10, tracked=64, on_exact=lambda: exact.append(1)).collect()
    assert exact and sorted(map(tuple, got)) == sorted(map(tuple, SE.top_words(SE.word_count(df), 10).collect()))
    assert SE.certified_top_k(df.limit(0), 10).count() == 0


def test_certified_top_k_shuffles_few_rows(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select(F.explode(F.split("text", " ")).alias("word"))
    exact = []
    got = SE.certified_top_k(df, 5, on_exact=lambda: exact.append(1))
    assert not exact and "Exchange" not in plan_text(got)  # the answer itself


# --- moment matrix -------------------------------------------------------------

def test_moment_matrix_with_large_means(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4)) + np.array([1e9, -5.0, 0.0, 1e6])
    df = spark.createDataFrame(x.tolist(), ["a", "b", "c", "d"]).repartition(7)
    m = MO.moment_matrix(df, F.array("a", "b", "c", "d"))
    assert m.n == 500 and np.allclose(m.mean, x.mean(axis=0), rtol=1e-12)
    assert np.allclose(m.cov, np.cov(x.T, bias=True), rtol=1e-6, atol=1e-9)


def test_sweep_equals_ml_fits(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 5)) @ rng.normal(size=(5, 5))
    y = x @ np.array([1.0, -2.0, 0.0, 0.5, 3.0]) + rng.normal(size=400)
    df = spark.createDataFrame(np.c_[x, y].tolist(), [*"abcde", "y"])
    lambdas = [0.0, 0.3, 2.0]
    got = MO.lambda_sweep_moments(spark, df, list("abcde"), "y", (0.0, 0.5, 1.0), lambdas).collect()
    vec = FE.assemble(df, list("abcde"), "y")
    for r in got:
        model = RG.linear_regression(r.reg_param, r.elastic_net, 5000).setTol(1e-13).fit(vec)
        assert r.coefficients == pytest.approx(list(model.coefficients), abs=1e-4)
        assert r.r2 == pytest.approx(model.summary.r2, abs=1e-6)
        assert r.intercept == pytest.approx(model.intercept, abs=1e-3)


def test_sweep_of_two_hundred_features_satisfies_its_conditions(spark):
    """At the optimum the correlation with the residual is the penalty's slope
    where a coefficient is not zero, and no larger than it elsewhere."""
    rng = np.random.default_rng(5)
    p, n = 200, 600
    x = rng.normal(size=(n, p)) * rng.uniform(0.1, 10, size=p)
    y = x[:, :10] @ rng.normal(size=10) + rng.normal(size=n)
    names = [f"f{i}" for i in range(p)]
    df = spark.createDataFrame(np.c_[x, y].tolist(), [*names, "y"])
    alpha, lambdas = 0.13, [0.1, 1.0, 5.0]
    sx, sy = x.std(axis=0), y.std()
    for r in MO.lambda_sweep_moments(spark, df, names, "y", (alpha,), lambdas).collect():
        b = np.array(r.coefficients) * sx / sy
        z, t = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
        g = z.T @ (t - z @ b) / n - r.reg_param * (1 - alpha) / sy * b
        l1 = r.reg_param * alpha / sy
        assert np.all(np.abs(g[b != 0] - l1 * np.sign(b[b != 0])) < 1e-8) and np.all(np.abs(g[b == 0]) <= l1 + 1e-8)
        resid = y - x @ np.array(r.coefficients) - r.intercept
        assert r.r2 == pytest.approx(1 - (resid @ resid) / ((y - y.mean()) @ (y - y.mean())), abs=1e-9)


def test_sweep_edges(spark):
    df = spark.createDataFrame([(1.0, 7.0, 3.0), (2.0, 7.0, 3.0)], "a double, k double, y double")
    rows = MO.lambda_sweep_moments(spark, df, ["a", "k"], "y", (0.0, 1.0), [0.0, 1.0]).collect()
    assert all(r.coefficients == [0.0, 0.0] and r.r2 is None for r in rows)
    fit = MO.lambda_sweep_moments(spark, df, ["k", "y"], "a", (0.0,), [0.0]).collect()[0]
    assert fit.coefficients == [0.0, 0.0] and fit.r2 == 0.0
    assert MO.lambda_sweep_moments(spark, df.limit(0), ["a"], "y").count() == 0
    with pytest.raises(Exception, match="null or NaN"):
        MO.moment_matrix(spark.createDataFrame([(1.0, None)], "a double, b double"), F.array("a", "b"))


# --- gradient-descent SVM --------------------------------------------------------

def plain_svm(x, y, steps=100, reg=0.01):
    w = np.zeros(x.shape[1])
    s = 2 * y - 1
    for t in range(1, steps + 1):
        wrong = s * (x @ w) < 1
        g = -(s[wrong, None] * x[wrong]).sum(axis=0) / len(x)
        new = w * (1 - reg / math.sqrt(t)) - g / math.sqrt(t)
        small = np.linalg.norm(new - w) < 0.001 * max(np.linalg.norm(new), 1.0)
        w = new
        if small and t > 1:
            break
    return w


def test_svm_by_gradient_descent(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(size=(800, 3))
    y = (x @ np.array([1.0, -1.0, 0.2]) > 0.05).astype(float)
    df = spark.createDataFrame(np.c_[y, x].tolist(), "label double, a double, b double, c double").repartition(4)
    vec = FE.assemble(df, ["a", "b", "c"])
    model = ML.svm_sgd().fit(vec)
    w = plain_svm(x, y)
    assert model.weights == pytest.approx(list(w), abs=1e-9)
    both = ML.predict(model, ML.svm_margin(model, vec.withColumn("x", vector_to_array("features")))).collect()
    for r in both:
        assert r.score == pytest.approx(float(np.dot(w, r.x)), abs=1e-9)
        assert r.prediction == float(r.score > 0)


def test_pair_tests_share_their_steps_and_match_plain_descent(spark):
    """All four models come from one cached copy of the rows; each equals
    gradient descent on its own scaled rows."""
    rng = np.random.default_rng(3)
    rows = [(float(k % 3), *map(float, rng.random(2) * [5.0, 900.0] + k % 3)) for k in range(300)]
    df = spark.createDataFrame(rows, "label double, a double, b double").repartition(3)
    cached = len(spark.sparkContext._jsc.getPersistentRDDs())
    fits = TR.fit_pairs(df, TR.pair_tests())
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == cached
    data = np.array(rows)
    for f in fits:
        own = data[np.isin(data[:, 0], f.keep)]
        x = own[:, 1:]
        if f.expand:
            x = np.concatenate([np.stack([c / math.sqrt(3.0), c * c, c ** 3], axis=1) for c in x.T], axis=1)
        x = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
        s = np.where(own[:, 0] == f.pos, 1.0, -1.0)
        w = np.zeros(x.shape[1])
        for it in range(1, ML.SVM_ITERATIONS + 1):
            step = ML.SVM_STEP / math.sqrt(it)
            new = w * (1 - step * ML.SVM_REG) - step * (np.where(s * (x @ w) < 1, -s, 0.0) @ x) / len(x)
            moved, w = np.linalg.norm(new - w), new
            if it > 1 and moved < ML.SVM_TOLERANCE * max(np.linalg.norm(w), 1.0):
                break
        assert f.train_rows == len(own)
        assert f.weights == pytest.approx(w.tolist(), abs=1e-6)


def test_svm_takes_only_labels_zero_and_one(spark):
    df = FE.assemble(spark.createDataFrame([(0.0, 1.0), (2.0, 3.0)], "label double, a double"), ["a"])
    with pytest.raises(ValueError, match="0 and 1"):
        ML.svm_sgd().fit(df)
    with pytest.raises(ValueError, match="no rows"):
        ML.svm_sgd().fit(df.limit(0))


# --- trees -----------------------------------------------------------------------

def test_compiled_tree_equals_transform(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    data = li.select(((F.col("l_quantity") * 3 + F.col("l_discount") * 100).cast("int") % 3).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in feats])
    vec = FE.assemble(data, feats, keep=feats)
    model = ML.decision_tree().fit(vec)
    nodes = TB.tree_nodes(spark, model, feats)
    scored = ML.predict(model, vec).withColumn("own", TB.compile_tree(nodes))
    assert scored.where("own <> prediction or own is null").count() == 0
    rows = {r["id"]: r for r in nodes.collect()}
    assert len(rows) == model.numNodes and sum(r.parent is None for r in rows.values()) == 1
    for r in rows.values():
        assert sum(r.counts) == r.n_rows
        assert r.impurity == pytest.approx(1 - sum((c / r.n_rows) ** 2 for c in r.counts))
        own = [x for x in rows.values() if x.parent == r.id]
        assert len(own) == (2 if r.feature else 0)
        if own:
            assert sum(x.n_rows for x in own) == r.n_rows
            assert r.gain == pytest.approx(r.impurity - sum(x.n_rows / r.n_rows * x.impurity for x in own))
    one = FE.assemble(data.withColumn("label", F.lit(0.0)), feats, keep=feats)
    leaf = TB.tree_nodes(spark, ML.decision_tree().fit(one), feats)
    assert leaf.count() == 1 and one.select(TB.compile_tree(leaf).alias("p")).distinct().collect()[0].p == 0.0


# --- subspace PCA -------------------------------------------------------------------

@pytest.mark.parametrize("p,k", [(40, 3), (3, 2), (1, 1)])
def test_subspace_components_equal_eigenvectors(spark, p, k):
    rng = np.random.default_rng(p)
    x = rng.normal(size=(300, p)) * np.linspace(5, 1, p) ** 2 + 1e4
    df = spark.createDataFrame([(row,) for row in x.tolist()] + [(None,)], "v array<double>").repartition(3)
    c = SU.subspace_components(df, F.col("v"), k)
    lam, vec = np.linalg.eigh(np.atleast_2d(np.cov(x.T)))
    assert c.eigenvalues == pytest.approx(lam[::-1][:k], rel=1e-6)
    assert c.total == pytest.approx(lam.sum(), rel=1e-6) and c.residual < 1e-6
    for j in range(k):
        assert abs(c.vectors[j] @ vec[:, -1 - j]) == pytest.approx(1.0, abs=1e-6)
    assert len(SU.subspace_components(df.limit(0), F.col("v"), 1).eigenvalues) == 0


# --- vector columns ------------------------------------------------------------------

def test_vector_transforms_equal_the_column_forms(spark):
    feats = ["a", "b", "c"]
    rows = [(float(i), float(i * i - 7), 4.0, float(i % 2)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double")
    vec = FE.assemble(df, feats)

    def values(frame):
        return sorted(tuple(round(x, 9) for x in r[0]) for r in frame.select(vector_to_array("features")).collect())

    assert values(FE.min_max_normalize_vector(vec)) == values(FE.assemble(FE.min_max_normalize(df, feats), feats))
    assert values(FE.mean_center_vector(vec)) == values(FE.assemble(FE.mean_center(df, feats), feats))
    exp = FE.kernel_expand(df, feats, keep=("label",))
    assert values(FE.kernel_expand_vector(vec)) == values(FE.assemble(exp, [c for c in exp.columns if c != "label"]))
    assert FE.vector_stats(vec.limit(0), "features", "min") == {"min": []}


def test_five_thousand_features_plan_flat(spark):
    wide = spark.range(20).select(array_to_vector(F.transform(
        F.sequence(F.lit(1), F.lit(5000)), lambda i: (i * F.col("id")).cast("double"))).alias("features"))
    out = FE.mean_center_vector(FE.min_max_normalize_vector(wide))
    assert plan_text(out, "simple").count("Project") <= 3 and plan_text(out, "simple").count("Exchange") == 0
    x = np.array([r[0] for r in out.select(vector_to_array("features")).collect()])
    assert x.shape == (20, 5000) and np.abs(x.mean(axis=0)).max() < 1e-9 and np.allclose(x.max(axis=0), 0.5)


# --- bucketed semi join -----------------------------------------------------------------

def test_bucketed_semi_join_without_exchange(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for i in range(3000):
        key = 7 if i % 3 == 0 else None if i % 10 == 1 else rng.randint(0, 900)  # a hot id, null ids
        cells = [None if rng.random() < 0.55 else rng.random() for _ in range(5)]
        rows.append((key, *cells))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double")
    stored = C.write_bucketed(df, "id", 4, str(tmp_path / "b"), "quarry_test_bucketed")
    try:
        got = C.semi_join_bucketed(stored, "id")
        plan = plan_text(got)
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted(map(repr, got.collect())) == sorted(map(repr, C.semi_join_healthy_ids(df, "id").collect()))
        sick = stored.where("id is null and a is null and b is null and c is null")
        assert C.semi_join_bucketed(sick, "id").count() == 0
    finally:
        spark.sql("DROP TABLE quarry_test_bucketed")


# --- trial ledger -----------------------------------------------------------------------

def test_ledger_resumes_and_keeps_settings_apart(spark, monkeypatch):
    rows = spark.createDataFrame([(float((i * 7) % 10 > 4), float(i % 10), float(i % 7)) for i in range(300)],
                                 "label double, a double, b double")
    frame = TR.with_row_id(spark, rows)
    clear_shared(spark, "trial_ledger", "test")
    monkeypatch.setattr(TR, "RAW_MODELS", TR.RAW_MODELS[:1])
    monkeypatch.setattr(TR, "NORMALIZED_MODELS", ())
    run, done = TR.run_trial, []

    def counted(spark_, frame_, feats, it, *rest):
        if it == 3 and "failed" not in done:
            done.append("failed")
            raise RuntimeError("driver lost")
        done.append(it)
        return run(spark_, frame_, feats, it, *rest)

    monkeypatch.setattr(TR, "run_trial", counted)
    with pytest.raises(RuntimeError):
        TR.ledger_holdout(spark, lambda: frame, "test", 4)
    first = [d for d in done if d != "failed"]
    assert first[:2] == [1, 2]
    got = TR.ledger_holdout(spark, lambda: frame, "test", 4)
    assert got.count() == 4
    again = [d for d in done if d != "failed"][len(first):]
    assert set(again) == {1, 2, 3, 4} - set(first)  # none is run twice
    before = len(done)
    same = TR.ledger_holdout(spark, lambda: pytest.fail("rows are not needed"), "test", 4)
    assert len(done) == before and sorted(same.collect()) == sorted(got.collect())
    assert sorted(TR.repeated_holdout(spark, frame, 4).collect()) == sorted(got.collect())
    before = len(done)
    TR.ledger_holdout(spark, lambda: frame, "test", 1, train_share=0.5)
    assert len(done) == before + 1
    assert TR.settings_digest() != TR.settings_digest(normalize_mode="train")
    one, other = (((("SVM", lambda reg=reg: ML.SvmSgd(reg=reg)),)) for reg in (0.01, 0.5))
    assert TR.settings_digest(models=one) != TR.settings_digest(models=other)


def _trial_rows(spark, n=300):
    rows = spark.createDataFrame([(float((i * 7) % 10 > 4), float(i % 10), float(i % 7)) for i in range(n)],
                                 "label double, a double, b double")
    return TR.with_row_id(spark, rows)


def test_svm_steps_of_all_trials_are_one_job(spark):
    frame, feats = _trial_rows(spark), ["a", "b"]
    sc = spark.sparkContext
    sc.setJobGroup("trial-svms", "trial-svms")
    try:
        with TR.trial_table(frame, feats, [1, 2, 3, 4]) as shared:
            jobs = len(sc.statusTracker().getJobIdsForGroup("trial-svms"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= ML.SVM_ITERATIONS + 20  # not that many a trial
    assert {it for it, _ in shared.fitted} == {1, 2, 3, 4}
    for it in (1, 2, 3, 4):
        train = frame.filter(TR.trial_side(it) == "train")
        lo_hi = {c: shared.stats[it]["train"][c] for c in feats}
        assert lo_hi == FE.min_max_stats(train, feats)
        alone = ML.svm_sgd().fit(FE.assemble(FE.min_max_normalize(train.drop(TR.ROW), feats, lo_hi), feats))
        assert shared.fitted[it, "Support Vector Machine"].weights == pytest.approx(alone.weights, abs=1e-12)


def test_trials_read_their_rows_once(spark, monkeypatch):
    monkeypatch.setattr(TR, "RAW_MODELS", TR.RAW_MODELS[:1])
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    rows = _trial_rows(spark)
    frame = spark.createDataFrame(rows.rdd.map(seen), rows.schema)
    monkeypatch.setattr(TR, "NORMALIZED_MODELS", ())
    assert TR.repeated_holdout(spark, frame, 3).count() == 3
    assert read.value == 300


class _Tree:
    """A decision tree that calls ``seen`` with the rows it is to be fitted on."""

    def __init__(self, seen):
        self.seen, self.tree = seen, ML.decision_tree()

    def setFeaturesCol(self, name):
        self.tree.setFeaturesCol(name)
        return self

    def fit(self, df):
        self.seen(df)
        return self.tree.fit(df)


def test_small_trials_are_one_task_and_overlap(spark, monkeypatch):
    tasks, three = [], threading.Barrier(3)

    def seen(df):
        tasks.append(df.rdd.getNumPartitions())
        three.wait(60)  # for the two other trials

    monkeypatch.setattr(TR, "RAW_MODELS", (("Decision Tree", lambda: _Tree(seen)),))
    monkeypatch.setattr(TR, "NORMALIZED_MODELS", ())
    frame = _trial_rows(spark).repartition(7).localCheckpoint()
    want = {(it, frame.filter(TR.trial_side(it) == "test").count()) for it in (1, 2, 3)}
    got = TR.repeated_holdout(spark, frame, 3, concurrent_trials=1, rows_at_once=10_000).collect()
    assert tasks == [1, 1, 1]
    assert {(r.iteration, r.fp + r.tn + r.tp + r.fn) for r in got} == want
    monkeypatch.setattr(TR, "ROWS_PER_TASK", 100)
    tasks.clear()
    TR.repeated_holdout(spark, frame, 3, concurrent_trials=3)
    assert tasks == [2, 2, 2]


@pytest.mark.parametrize("rows, asked, limit, want", [
    (100, 2, 0, 2), (100, 2, 150, 2), (100, 1, 350, 3), (10**9, 2, 4_000_000, 2), (1, 2, 10**9, None)])
def test_trials_at_once(spark, rows, asked, limit, want):
    shared = TR.TrialTable(None, {}, {1: rows, 2: rows // 2}, {}, None)
    assert TR.trials_at_once(spark, shared, asked, limit) == (want or max(2, spark.sparkContext.defaultParallelism))


def test_svms_train_while_other_models_do(spark, monkeypatch):
    other, fit_blocks, first = threading.Event(), ML.SvmSgd.fit_blocks, []

    def waiting(self, *args):
        first.append(other.wait(60))
        return fit_blocks(self, *args)

    monkeypatch.setattr(ML.SvmSgd, "fit_blocks", waiting)
    monkeypatch.setattr(TR, "RAW_MODELS", (("Decision Tree", lambda: _Tree(lambda df: other.set())),))
    monkeypatch.setattr(TR, "NORMALIZED_MODELS", TR.NORMALIZED_MODELS[-1:])
    assert TR.repeated_holdout(spark, _trial_rows(spark), 2).count() == 4
    assert first == [True]


def test_sides_of_many_trials(spark):
    frame = _trial_rows(spark, 200)
    its = list(range(1, 2 * TR.SIDE_BITS + 3))
    sided = TR.with_sides(frame, ["a"], its, 0.6)
    n = [F.count_if(TR.on_train(k)) for k in range(len(its))]
    want = [F.count_if(TR.trial_side(it) == "train") for it in its]
    assert list(sided.agg(*n).first()) == list(frame.agg(*want).first())
    block = ML.number_blocks(sided).collect()
    got = [sum(TR.side_view(1, k, True)(b)[1].shape[1] for b in block) for k in range(len(its))]
    assert got == list(sided.agg(*n).first())


@pytest.mark.parametrize("share", [0.0, 1e-9, 0.3, 0.6, 1.0])
def test_split_by_hex_digits_is_the_split_by_numbers(spark, share):
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"))
    number = F.conv(F.substring(F.md5("k"), 1, 8), 16, 10).cast("bigint")
    bound = FE.split_bounds((share, 1 - share))[0]
    side = FE.split_column(F.col("k"), (share, 1 - share), ("a", "b"))
    assert rows.filter((number < bound) != (side == "a")).count() == 0


# --- models of many trials fitted together ------------------------------------------------

def _noisy_rows(spark, n=1500):
    """Rows of few values per feature, so that Spark ML too takes every value as a split."""
    rng = np.random.default_rng(21)
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 30, n) * 7.5 + 900, rng.integers(-4, 5, n), np.full(n, 3)]).astype(float)
    y = (x[0] * 10 + x[2] * x[1] / 300 + rng.normal(size=n) * 25 > 60).astype(float)
    return TR.with_row_id(spark, spark.createDataFrame(np.c_[y, x.T].tolist(), "label double, a double, b double, c double, k double")
                          .repartition(3))


@pytest.fixture
def few_steps(monkeypatch):
    monkeypatch.setattr(ML, "GBT_ITERATIONS", 3)
    monkeypatch.setattr(TR, "NORMALIZED_MODELS", TR.NORMALIZED_MODELS[:-1])  # the SVM has tests of its own


def test_models_fitted_together_equal_those_of_spark_ml(spark, few_steps):
    frame, feats = _noisy_rows(spark), ["a", "b", "c", "k"]
    with TR.trial_table(frame, feats, [1, 2]) as shared:
        for it in (1, 2):
            train = shared.rows.filter(shared.on_train[it])
            both = TR._with_feature_vectors(train, feats, shared.stats[it]["train"]).persist()
            for name, make, col in TR._line_up():
                if "Forest" in name:  # whose draws differ
                    continue
                want, got = make().setFeaturesCol(col).fit(both), shared.model(it, name, make, 4)
                scored = ML.predict(got, ML.predict(want, both, "want"), "got", col)
                if "Regression" in name:
                    assert got.weights == pytest.approx(list(want.coefficients), abs=2e-3 * max(map(abs, got.weights)))
                    assert got.weights[3] == 0.0  # of one value
                else:
                    assert scored.filter("want <> got").count() == 0, (it, name)
            both.unpersist()


def test_a_level_of_all_trees_is_one_job(spark, few_steps):
    """Three boosted trees of depth five, forests and trees of eight trials:
    fifteen levels, where each trial had jobs of its own."""
    frame, feats, sc = _noisy_rows(spark), ["a", "b", "c", "k"], spark.sparkContext
    sc.setJobGroup("all-trials", "all-trials")
    try:
        with TR.trial_table(frame, feats, range(1, 9)) as shared:
            for it in range(1, 9):
                assert shared.counts(it).sum() + shared.train_rows[it] == 1500
            jobs = len(sc.statusTracker().getJobIdsForGroup("all-trials"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 75  # Newton steps, ranges and counts too


def test_trees_do_not_depend_on_partitions_or_the_other_trials(spark, monkeypatch, few_steps):
    frame, feats = _noisy_rows(spark, 700).persist(), ["a", "b", "c", "k"]
    monkeypatch.setattr(TR, "NORMALIZED_MODELS", TR.NORMALIZED_MODELS[1:2])

    def results(df, iterations):
        with TR.trial_table(df, feats, iterations) as shared:
            return [r for it in iterations for r in TR.run_trial(spark, df, feats, it, shared=shared)]

    want = results(frame, [1, 2])
    assert len(want) == 10
    assert results(frame.repartition(2), [2]) == want[5:]
    monkeypatch.setattr(TR, "TREE_ROWS_AT_ONCE", 1)  # a group a trial
    assert results(frame, [1, 2]) == want


def test_shared_counts_equal_the_predictions_of_each_row(spark, few_steps):
    frame, feats = _noisy_rows(spark, 600), ["a", "b", "c", "k"]
    with TR.trial_table(frame, feats, [5]) as shared:
        got = TR.run_trial(spark, frame, feats, 5, shared=shared)
        test = TR._own_predictions(shared, feats, 5, TR._line_up(), shared.stats[5], 2)
        rows = TR.M.confusion_by_model(test, [(name, f"__p{i}") for i, (name, _, _) in enumerate(TR._line_up())]).collect()
    assert [r[1:6] for r in got] == [(r.test, r.fp, r.tn, r.tp, r.fn) for r in rows]


def test_ranges_of_many_values_hold_about_equally_many_rows(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.lognormal(3, 4, 30_000) * rng.choice([-1, 1], 30_000), np.full(3_000, 7.25)])
    blocks = spark.sparkContext.parallelize([np.stack([x[k::5] * 0, x[k::5], np.arange(6600.0) % 9]) for k in range(5)], 3)
    many, few = TF.value_ranges(blocks, 2)
    assert list(few.high) == list(range(9)) and len(many.high) <= TF.RANGES
    code = many.high.searchsorted(x)
    assert np.all(x <= many.high[code]) and np.all(x > many.low[code])
    n = np.bincount(code)
    assert (n > 200).sum() == 1 and len(many.high) > TF.RANGES // 2
    own = TF.cuts([many], n[None], 32)
    shares = np.bincount(own.bin_of[0][code])
    assert len(shares) >= 28 and shares[shares < 3000].max() < 1500


def test_newton_steps_end_on_classes_a_line_separates(spark):
    x = np.array([[-2.0, 1.0], [-1.0, 1.0], [1.0, 1.0], [2.0, 1.0]] * 20)
    block = np.concatenate([(x[:, :1] > 0).astype(float), x, np.ones((80, 1))], axis=1).T
    points = spark.sparkContext.parallelize([block], 1)
    w, = ML.fit_logistic_blocks(points, [ML.SideView(2, 3, 0, True, None)], 100, 1e-6)
    assert np.isfinite(w).all() and w[0] > 5 and w[1] == 0.0
