"""Classifier factories with the reference's settings, prediction and the
two-tree majority vote.  Training is Spark ML's own distributed code, but for
the SVM's gradient steps; the library fixes parameters and adds the few scoring
rules that differ.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.tree_fits import TreesModel

# Model settings of the reference.
TREE_IMPURITY, TREE_DEPTH, TREE_BINS = "gini", 4, 100
FOREST_TREES, FOREST_STRATEGY, FOREST_DEPTH, FOREST_BINS, FOREST_SEED = 2, "auto", 5, 32, 11
GBT_ITERATIONS, GBT_DEPTH = 10, 5
SVM_ITERATIONS, SVM_REG = 100, 0.01
SVM_STEP, SVM_TOLERANCE = 1.0, 0.001


def decision_tree() -> DecisionTreeClassifier:
    """Gini, depth 4, 100 bins, all features continuous."""
    return DecisionTreeClassifier(impurity=TREE_IMPURITY, maxDepth=TREE_DEPTH, maxBins=TREE_BINS)


def logistic_regression() -> LogisticRegression:
    """L-BFGS, no regularisation, no intercept."""
    return LogisticRegression(regParam=0.0, fitIntercept=False, maxIter=100, tol=1e-6)


def random_forest() -> RandomForestClassifier:
    """Two gini trees, depth 5, 32 bins, seed 11, 'auto' feature subsets."""
    return RandomForestClassifier(numTrees=FOREST_TREES, featureSubsetStrategy=FOREST_STRATEGY,
                                  impurity="gini", maxDepth=FOREST_DEPTH,
                                  maxBins=FOREST_BINS, seed=FOREST_SEED)


def gradient_boosted_trees() -> GBTClassifier:
    """Log-loss boosting, 10 iterations, depth 5."""
    return GBTClassifier(maxIter=GBT_ITERATIONS, maxDepth=GBT_DEPTH)


def linear_svm() -> LinearSVC:
    """Hinge loss, L2 0.01, no intercept, 100 iterations; meant for min-max
    scaled features (on raw ones the largest feature decides alone)."""
    return LinearSVC(maxIter=SVM_ITERATIONS, regParam=SVM_REG, fitIntercept=False,
                     standardization=False)


class SvmSgd:
    """Linear SVM by gradient descent on all rows: hinge loss, L2 0.01, step
    1 / sqrt(t), 100 steps from zero weights, no intercept; it ends early when
    a step moves the weights by less than a thousandth.  Full batches make it
    deterministic.

    Rows are packed once into blocks of numbers (:func:`number_blocks`), which
    are cached; a step is one job with one small row of sums a task.
    """

    def __init__(self, iterations: int = SVM_ITERATIONS, reg: float = SVM_REG, step: float = SVM_STEP,
                 tolerance: float = SVM_TOLERANCE, features_col: str = "features"):
        self.settings = {"iterations": iterations, "regParam": reg, "step": step, "convergenceTol": tolerance}
        self.features_col = features_col

    def setFeaturesCol(self, name: str) -> SvmSgd:
        self.features_col = name
        return self

    def fit(self, df: DataFrame) -> SvmSgdModel:
        points = number_blocks(df.select("label", vector_to_array(self.features_col))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights, = self.fit_blocks(points, [label_and_features])
        finally:
            points.unpersist()
        return SvmSgdModel(weights, self.features_col)

    def fit_blocks(self, points: RDD, views: Sequence[Callable], found: Sequence[tuple] | None = None
                   ) -> list[list[float]]:
        """Weights of several models on the same blocks, each step one job for
        all: ``views`` give a block's signs (1, -1, or 0 for a row that is not
        the model's) and features for each.  ``found`` is what
        :func:`block_stats` gives for them, if it is known."""
        found = found or block_stats(points, views)
        for n, other, _, _ in found:
            if not n:
                raise ValueError("no rows to train on")
            if other:
                raise ValueError("labels must be 0 and 1")
        weights = [np.zeros(len(lo)) for _, _, lo, _ in found]
        left = list(range(len(views)))
        for it in range(1, self.settings["iterations"] + 1):
            sums = points.map(hinge_sums([(views[k], weights[k]) for k in left])).reduce(add_each)
            step = self.settings["step"] / math.sqrt(it)
            for k, g in zip(list(left), sums, strict=True):
                w = weights[k] * (1.0 - step * self.settings["regParam"]) - step * g / found[k][0]
                moved, weights[k] = np.linalg.norm(w - weights[k]), w
                if it > 1 and moved < self.settings["convergenceTol"] * max(np.linalg.norm(w), 1.0):
                    left.remove(k)
            if not left:
                break
        return [[float(v) for v in w] for w in weights]


def number_blocks(df: DataFrame) -> RDD:
    """Rows of a label and features (number columns, or one array) as arrays
    of doubles, a line per column and a batch of rows each.  Nulls and NaN are
    errors.  Blocks of few partitions are dealt to all cores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cols = [(c.flatten() if pa.types.is_list(c.type) else c).to_numpy(zero_copy_only=False)
                    .astype(float).reshape(b.num_rows, -1).T for c in b.columns]
            block = np.concatenate(cols)
            if np.isnan(block).any():
                raise ValueError("null or NaN among labels or features")
            yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()]), pa.array([b.num_rows])], names=["block", "n"])

    blocks = df.mapInArrow(run, "block binary, n long").rdd.map(lambda r: np.frombuffer(r[0]).reshape(-1, r[1]))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(cores) if blocks.getNumPartitions() < cores else blocks


def label_and_features(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The view of all rows; NaN is the sign of a label that is not 0 or 1."""
    y = block[0]
    return np.where((y == 0.0) | (y == 1.0), 2.0 * y - 1.0, np.nan), block[1:]


def block_stats(points: RDD, views: Sequence[Callable]) -> list[tuple]:
    """(rows, rows with an unknown label, minima, maxima) per view."""
    def one(block: np.ndarray) -> list[tuple]:
        out = []
        for view in views:
            sign, x = view(block)
            x = x[:, sign != 0.0]
            out.append((x.shape[1], int(np.isnan(sign).sum()), x.min(axis=1, initial=np.inf),
                        x.max(axis=1, initial=-np.inf)))
        return out

    def both(a: list[tuple], b: list[tuple]) -> list[tuple]:
        return [(n + m, c + d, np.minimum(lo, le), np.maximum(hi, he))
                for (n, c, lo, hi), (m, d, le, he) in zip(a, b, strict=True)]

    if points.isEmpty():
        raise ValueError("no rows to train on")
    return points.map(one).reduce(both)


class SideView(NamedTuple):
    """The view of the rows whose ``bit`` in the block's line ``word`` is set
    (or not, if not ``train``); their features are scaled by ``ends``, (minima,
    maxima)."""

    n_feats: int
    word: int
    bit: int
    train: bool
    ends: tuple | None

    def __call__(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero((block[self.word].astype(np.int64) >> self.bit & 1) == self.train)
        sign, x = label_and_features(block[:1 + self.n_feats].take(rows, axis=1))
        return sign, x if self.ends is None else scaled(x, *self.ends)


def scaled(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(x - min) / (max - min); a constant column gives 0.0."""
    span = hi - lo
    out = x - lo[:, None]
    out /= np.where(span == 0.0, 1.0, span)[:, None]
    out[span == 0.0] = 0.0
    return out


#: Rows that models on sides of the same rows go over at a time: what they need
#: for each row and model then stays in a core's cache.
ROWS_TOGETHER = 2_000


class _Together:
    """Sums of several models on sides of the same rows.  Rows are brought to
    one scale, that of the first model; the others' scales go into the weights
    and sums, so that all models share the passes over a block."""

    def __init__(self, models: Sequence[tuple[SideView, np.ndarray]]):
        self.views = [v for v, _ in models]
        ends = [v.ends or (np.zeros(v.n_feats), np.ones(v.n_feats)) for v in self.views]
        self.base = ends[0][0]
        self.width = np.where(ends[0][1] > ends[0][0], ends[0][1] - ends[0][0], 1.0)
        self.lo = np.stack([(lo - self.base) / self.width for lo, _ in ends])
        span = np.stack([(hi - lo) / self.width for lo, hi in ends])
        self.span = np.where(span == 0.0, np.inf, span)  # of no weight, as all its values are 0
        weights = np.stack([w for _, w in models]) / self.span
        self.weights = np.concatenate([weights, -(weights * self.lo).sum(axis=1)[:, None]], axis=1)
        words = sorted({v.word for v in self.views})
        self.words, self.train = words, np.array([v.train for v in self.views])
        self.bits = np.array([64 * words.index(v.word) + v.bit for v in self.views])

    def chunks(self, block: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per some rows: features and a one, all times the row's sign; by rows
        and models, which rows are whose, and margins times the sign."""
        for start in range(0, block.shape[1], ROWS_TOGETHER):
            part = block[:, start:start + ROWS_TOGETHER]
            sign, x = label_and_features(part[:1 + self.views[0].n_feats])
            x = np.concatenate([(x - self.base[:, None]) / self.width[:, None], np.ones((1, len(sign)))])
            x *= sign
            sides = np.ascontiguousarray(part[self.words].T.astype("<i8")).view(np.uint8)
            own = np.unpackbits(sides, axis=1, bitorder="little").take(self.bits, axis=1) == self.train
            yield x, own, x.T @ self.weights.T

    def first(self, sums: np.ndarray) -> np.ndarray:
        """Per model, from sums of raw features and a one, those of its features."""
        return (sums[:, :-1] - sums[:, -1:] * self.lo) / self.span

    def second(self, sums: np.ndarray) -> np.ndarray:
        """The same from sums of products of two features or the one."""
        once, total = sums[:, :-1, -1], sums[:, -1, -1]
        cross = once[:, :, None] * self.lo[:, None, :]
        out = sums[:, :-1, :-1] + total[:, None, None] * self.lo[:, :, None] * self.lo[:, None, :]
        return (out - cross - cross.transpose(0, 2, 1)) / self.span[:, :, None] / self.span[:, None, :]


def _on_sides(models: Sequence[tuple]) -> bool:
    return all(isinstance(v, SideView) and v.n_feats == models[0][0].n_feats for v, _ in models)


def hinge_sums(models: Sequence[tuple[Callable, np.ndarray]]) -> Callable:
    """The hinge loss's gradients, summed over a block, of (view, weights)."""
    if _on_sides(models):
        together = _Together(models)

        def run_together(block: np.ndarray) -> list[np.ndarray]:
            sums = sum((((margin < 1.0) & own).astype(float).T @ x.T for x, own, margin in together.chunks(block)), 0.0)
            return list(-together.first(sums))

        return run_together

    def run(block: np.ndarray) -> list[np.ndarray]:
        out = []
        for view, w in models:
            sign, x = view(block)
            # einsum starts no threads beside the other tasks, as matrix products do.
            pull = np.where(sign * np.einsum("p,pn->n", w, x) < 1.0, -sign, 0.0)
            out.append(np.einsum("pn,n->p", x, pull))
        return out

    return run


def add_each(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b, strict=True)]


#: Features up to which a logistic regression is fitted with second derivatives.
NEWTON_FEATURES = 100


def takes_newton(model, n_feats: int) -> bool:
    """Whether :func:`fit_logistic_blocks` fits what the Spark ML estimator does."""
    return (type(model) is LogisticRegression and n_feats <= NEWTON_FEATURES and model.getRegParam() == 0.0
            and not model.getFitIntercept() and model.getThreshold() == 0.5 and not model.isDefined("weightCol"))


def logistic_sums(models: Sequence[tuple[SideView, np.ndarray]]) -> Callable:
    """Loss, its first and its second derivatives, summed over a block, of
    (view, weights)."""
    together = _Together(models)
    p = together.views[0].n_feats + 1
    i, j = np.triu_indices(p)

    def run(block: np.ndarray) -> list[np.ndarray]:
        loss, first, upper = 0.0, 0.0, 0.0
        for x, own, margin in together.chunks(block):
            e = np.exp(-np.abs(margin))
            wrong = np.where(margin > 0.0, e, 1.0) / (1.0 + e) * own  # the chance of the other class
            loss = loss + ((np.log(1.0 + e) - np.minimum(margin, 0.0)) * own).sum(axis=0)
            first = first - wrong.T @ x.T
            upper = upper + (wrong * (1.0 - wrong)).T @ (x[i] * x[j]).T
        both = np.empty((len(together.views), p, p))
        both[:, i, j] = both[:, j, i] = upper
        second = together.second(both).reshape(len(both), -1)
        return list(np.concatenate([loss[:, None], together.first(first), second], axis=1))

    return run


def fit_logistic_blocks(points: RDD, views: Sequence[SideView], iterations: int, tolerance: float,
                        found: Sequence[tuple] | None = None) -> list[list[float]]:
    """Weights of several logistic regressions without penalty and intercept on
    the same blocks, by Newton steps (halved where the loss would grow), each
    one job for all.  Columns of one value get no weight, as in Spark ML.
    ``found`` is what :func:`block_stats` gives for the views, if it is known."""
    found = found or block_stats(points, views)
    for n, other, _, _ in found:
        if not n:
            raise ValueError("no rows to train on")
        if other:
            raise ValueError("labels must be 0 and 1")
    best = [(np.inf, np.zeros(len(lo))) for _, _, lo, _ in found]  # loss and weights so far
    steps = [np.zeros(len(lo)) for _, _, lo, _ in found]
    left = list(range(len(views)))
    for _ in range(iterations):
        sums = points.map(logistic_sums([(views[k], best[k][1] + steps[k]) for k in left])).reduce(add_each)
        for k, s in zip(list(left), sums, strict=True):
            n, _, lo, hi = found[k]
            loss, used = s[0] / n, np.flatnonzero(hi > lo)
            if not loss <= best[k][0]:
                steps[k] = steps[k] / 2.0
                if np.abs(steps[k]).max() <= 1e-12 * np.abs(best[k][1]).max():
                    left.remove(k)
                continue
            p = len(lo)
            best[k] = (loss, best[k][1] + steps[k])
            if not len(used):
                left.remove(k)
                continue
            first, second = s[1:1 + p][used] / n, s[1 + p:].reshape(p, p)[np.ix_(used, used)] / n
            size = np.sqrt(np.diag(second).clip(1e-300))
            steps[k] = np.zeros(p)
            steps[k][used] = -np.linalg.lstsq(second / np.outer(size, size), first / size, rcond=1e-12)[0] / size
            # Steps are quadratic near the optimum: this one leaves far less than the tolerance.
            if loss < tolerance or -first @ steps[k][used] <= tolerance ** 2 * loss:
                left.remove(k)
        if not left:
            break
    return [[float(v) for v in w] for _, w in best]


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def margin_sql(weights: Sequence[float], cols: Sequence[str]) -> str:
    """The inner product of weights and columns."""
    return " + ".join(f"({float(v)!r}D) * {_quoted(c)}" for v, c in zip(weights, cols, strict=True))


class SvmSgdModel:
    """Weights; the margin is their inner product with the features."""

    def __init__(self, weights: list[float], features_col: str):
        self.weights, self.features_col = weights, features_col

    def classes(self, x: np.ndarray) -> np.ndarray:
        """0.0 or 1.0 per row of ``x``, features by rows."""
        return (np.einsum("p,pn->n", np.array(self.weights), x) > 0.0).astype(float)

    def margin(self, features_col: str | None = None) -> Column:
        x = vector_to_array(features_col or self.features_col)
        w = F.array(*[F.lit(v) for v in self.weights])
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)


class LogisticModel(SvmSgdModel):
    """Weights of a logistic regression without intercept: class 1 where the
    margin is positive, the chance above one half."""


def svm_sgd() -> SvmSgd:
    """The SVM as the reference trains it; meant for min-max scaled features."""
    return SvmSgd()


def predict(model, df: DataFrame, out: str = "prediction",
            features_col: str | None = None) -> DataFrame:
    """``df`` plus the model's hard prediction (only that column is added);
    ``features_col`` reads the features from another vector column."""
    if isinstance(model, SvmSgdModel):
        return df.withColumn(out, (model.margin(features_col) > 0.0).cast("double"))
    if isinstance(model, TreesModel):
        return df.withColumn(out, model.prediction(features_col or "features"))
    params = {"predictionCol": out}
    if features_col is not None:
        params["featuresCol"] = features_col
    for p in ("rawPredictionCol", "probabilityCol"):
        if model.hasParam(p):
            params[p] = ""
    m = model.copy({model.getParam(k): v for k, v in params.items()})
    return m.transform(df)


def svm_margin(model, df: DataFrame, out: str = "score") -> DataFrame:
    """``df`` plus the raw margin w.x (threshold cleared)."""
    if isinstance(model, SvmSgdModel):
        return df.withColumn(out, model.margin())
    m = model.copy({model.getParam("rawPredictionCol"): "__raw",
                    model.getParam("predictionCol"): ""})
    return m.transform(df).withColumn(out, vector_to_array(F.col("__raw"))[1]).drop("__raw")


def forest_vote(model, df: DataFrame, out: str = "prediction",
                features_col: str | None = None) -> DataFrame:
    """Majority vote of the forest's trees, ties to class 0 (the averaged
    probability of ``RandomForestClassificationModel`` can break a two-tree
    tie the other way)."""
    cur = df
    names = []
    for i, tree in enumerate(model.trees):
        name = f"__tree{i}"
        cur = predict(tree, cur, name, features_col or model.getFeaturesCol())
        names.append(name)
    ones = sum((F.col(n) == 1.0).cast("int") for n in names)
    return cur.withColumn(out, F.when(ones * 2 > len(names), F.lit(1.0)).otherwise(F.lit(0.0))) \
        .drop(*names)


def score(model, df: DataFrame, out: str = "prediction",
          features_col: str | None = None) -> DataFrame:
    """Hard predictions, with the forest vote for random forests."""
    if hasattr(model, "trees") and model.__class__.__name__.startswith("RandomForest"):
        return forest_vote(model, df, out, features_col)
    return predict(model, df, out, features_col)
