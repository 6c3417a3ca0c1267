"""Holdout evaluation, pairwise SVM tests and repeated trials.

Splits compare a hash of the row's id (column ``__row``) and the trial number
with the shares, so a lost partition recomputes to exactly the same rows and
equal rows are split like any others.  The rows are cached once with their
side in every trial; minima, maxima and the steps of every fit (of an SVM, a
logistic regression, or a level of trees) are one job for all trials: Spark ML
fits a model in some ten to sixty jobs, each a pass over one trial's rows.  For
models that only Spark ML fits, the training side is persisted while they train
and released afterwards, in as many tasks as its rows need.  The
prepared input is checkpointed once (reliable checkpoint in the cluster's
shared checkpoint folder) so that retries do not replay the cleaning plan.
All models of one trial are scored in ONE aggregate job over the union of
their predictions, grouped by model name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from quarry.operators import metrics as M
from quarry.operators import models as ML
from quarry.operators import tree_fits as TF
from quarry.operators.cleaning import ROW, _q
from quarry.operators.features import (assemble, class_pair_subset, kernel_expand, kernel_terms,
                                       min_max_expr, min_max_normalize, relabel_pair, split_column)
from quarry.session import complete, ensure_checkpoint_dir, shared_dir
from quarry.sources.results import result_rows

# The trial line-up (test names as the reference prints them)
# and its split.
RAW_MODELS: tuple[tuple[str, Callable], ...] = (
    ("Decision Tree", ML.decision_tree),
    ("Logistic Regression", ML.logistic_regression),
    ("Random Forest", ML.random_forest),
    ("Gradient Boosted Tree", ML.gradient_boosted_trees),
)
NORMALIZED_MODELS: tuple[tuple[str, Callable], ...] = (
    ("Logistic Regression - Norm", ML.logistic_regression),
    ("Random Forest - Norm", ML.random_forest),
    ("Gradient Boosted Tree - Norm", ML.gradient_boosted_trees),
    ("Support Vector Machine", ML.svm_sgd),
)
TRIAL_TRAIN_SHARE = 0.6
TRIAL_ITERATIONS = 30

TRIAL_SCHEMA = T.StructType([
    T.StructField("iteration", T.IntegerType()), T.StructField("test", T.StringType()),
    T.StructField("fp", T.LongType()), T.StructField("tn", T.LongType()),
    T.StructField("tp", T.LongType()), T.StructField("fn", T.LongType()),
    T.StructField("accuracy", T.DoubleType()), T.StructField("auc", T.DoubleType())])


def trial_side(iteration: int | str, train_share: float = TRIAL_TRAIN_SHARE) -> Column:
    """``train`` or ``test`` by the row id ``__row`` and the trial number."""
    return split_column(F.concat_ws("|", F.col(ROW), F.lit(str(iteration))),
                        (train_share, 1 - train_share), ("train", "test"))


def with_row_id(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Rows without an id of their own get a number; written with the rows to
    the shared checkpoint folder, it stays the same for every later read."""
    ensure_checkpoint_dir(spark)
    return df.withColumn(ROW, F.monotonically_increasing_id().cast("string")).checkpoint(eager=True)


#: Sides in one number: as many bits as a double holds exactly, and some less.
SIDE_BITS = 48


def with_sides(frame: DataFrame, feats: Sequence[str], iterations: Sequence[int],
               train_share: float) -> DataFrame:
    """``(label, *feats, __sides0, ..., __hash)``: the bits of the sides, in the
    order of ``iterations``, are 1 where the row is on the training side; the
    hash is that of the row's id, as many bits of it."""
    bits = [F.when(trial_side(it, train_share) == "train", F.lit(1 << (k % SIDE_BITS)).cast("long"))
            .otherwise(F.lit(0).cast("long")) for k, it in enumerate(iterations)]
    return frame.select("label", *[_q(c) for c in feats], *[
        reduce(add, bits[k:k + SIDE_BITS]).alias(f"__sides{k // SIDE_BITS}")
        for k in range(0, len(bits), SIDE_BITS)],
        F.xxhash64(ROW).bitwiseAND(F.lit((1 << SIDE_BITS) - 1).cast("long")).alias("__hash"))


def on_train(k: int) -> Column:
    """Whether a row of :func:`with_sides` is on the k-th training side."""
    return F.shiftright(F.col(f"__sides{k // SIDE_BITS}"), k % SIDE_BITS).bitwiseAND(F.lit(1).cast("long")) == 1


def side_view(n_feats: int, k: int, train: bool, ends: tuple | None = None) -> Callable:
    """The view of one side of the k-th trial in blocks of :func:`with_sides`:
    signs and features of its rows only, scaled by ``ends``, (minima, maxima)."""
    return ML.SideView(n_feats, 1 + n_feats + k // SIDE_BITS, k % SIDE_BITS, train, ends)


#: How models are fitted, as part of a result's key: changed with the code.
FIT_VERSION = 2

#: Training rows of a task: a task's start is little beside a pass over them.
ROWS_PER_TASK = 250_000


#: Training rows, counted once a trial, whose trees are grown together: boosting
#: keeps a number a row and model between its trees.
TREE_ROWS_AT_ONCE = 100_000_000


class TrialTable(NamedTuple):
    """What trials share: the cached rows; per trial its training side and the
    rows on it, (min, max) per feature of each side that has rows, and the
    models fitted for many trials at once, while the trials fit the others:
    linear ones for all, trees (and the test rows' classes) per trial."""

    rows: DataFrame
    on_train: dict[int, Column]
    train_rows: dict[int, int]
    stats: dict[int, dict[str, dict]]
    fitting: Future
    growing: dict[int, Future] | None = None

    @property
    def fitted(self) -> dict[tuple[int, str], ML.SvmSgdModel]:
        """The linear models fitted for all trials at once, when they are."""
        return self.fitting.result()

    def model(self, iteration: int, name: str, make: Callable, n_feats: int):
        """The fitted model, or None if it is not one of those shared."""
        kind = _shared(make(), n_feats)
        if kind is None:
            return None
        return self.fitted[iteration, name] if kind == "linear" else self.growing[iteration].result()[0][iteration, name]

    def counts(self, iteration: int) -> np.ndarray | None:
        """:func:`class_counts` of a trial of shared models only."""
        return self.growing[iteration].result()[1].get(iteration)


@contextmanager
def trial_table(frame: DataFrame, feats: Sequence[str], iterations: Sequence[int],
                train_share: float = TRIAL_TRAIN_SHARE, normalize_mode: str = "per_set") -> Iterator[TrialTable]:
    """The :class:`TrialTable` of ``iterations``, while it is needed.  One job
    gives every side's minima and maxima, and a step of a fit is one job for
    all trials that have rows on both sides."""
    # Rows are dealt evenly to all cores: every later job takes as long as its largest task.
    cores = frame.sparkSession.sparkContext.defaultParallelism
    dealt = frame.repartition(-(-max(1, frame.rdd.getNumPartitions()) // cores) * cores)
    rows = with_sides(dealt, feats, iterations, train_share).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points = ML.number_blocks(rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sides = [(k, it, side) for k, it in enumerate(iterations) for side in ("train", "test")]
            found = ML.block_stats(points, [side_view(len(feats), k, side == "train") for k, _, side in sides])
            stats: dict[int, dict[str, dict]] = {it: {} for it in iterations}
            train_rows = {it: n for (_, it, side), (n, *_) in zip(sides, found, strict=True) if side == "train"}
            ends = {}
            for (_, it, side), (n, _, lo, hi) in zip(sides, found, strict=True):
                if n:
                    stats[it][side] = {c: (float(a), float(b)) for c, a, b in zip(feats, lo, hi, strict=True)}
                    if side == "train":
                        ends[it] = (lo, hi)
            train_stats = {it: f for (_, it, side), f in zip(sides, found, strict=True) if side == "train"}
            places = {it: k for k, it in enumerate(iterations) if len(stats[it]) == 2}
            spark = frame.sparkSession

            def fit_linear() -> dict[tuple[int, str], ML.SvmSgdModel]:
                return _fit_linear(points, len(feats), places, train_stats)

            coded: list = []

            def fit_trees(own: Sequence[int]) -> tuple[dict[tuple[int, str], TF.TreesModel], dict[int, np.ndarray]]:
                models = {}
                if specs := _tree_specs(len(feats)):
                    if not coded:
                        ranges = TF.value_ranges(points, len(feats))
                        coded.append((TF.in_ranges(points, ranges).persist(StorageLevel.MEMORY_AND_DISK), ranges))
                    models = _fit_trees(*coded[0], specs, {it: places[it] for it in own}, train_rows, ends)
                if any(_shared(make(), len(feats)) is None for _, make, _ in _line_up()):
                    return models, {}
                every = fitting.result() | models
                scaled_by = "train" if normalize_mode == "train" else "test"
                return models, class_counts(points, len(feats), {it: (
                    places[it], stats[it][scaled_by], [(col, every[it, name]) for name, _, col in _line_up()]) for it in own})

            with ThreadPoolExecutor(1) as linear, ThreadPoolExecutor(1) as trees:
                fitting = linear.submit(inheritable_thread_target(spark)(fit_linear))
                growing = {}
                most = max(1, TREE_ROWS_AT_ONCE // max([1, *train_rows.values()]))
                for i in range(0, len(places), most):
                    own = list(places)[i:i + most]
                    growing |= dict.fromkeys(own, trees.submit(inheritable_thread_target(spark)(fit_trees), own))
                try:
                    yield TrialTable(rows, {it: on_train(k) for k, it in enumerate(iterations)}, train_rows, stats,
                                     fitting, growing)
                finally:
                    trees.shutdown(cancel_futures=True)
                    for blocks, _ in coded:
                        blocks.unpersist()
        finally:
            points.unpersist()
    finally:
        rows.unpersist()


def _fit_linear(points: RDD, n_feats: int, places: dict[int, int], stats: dict[int, tuple]
                ) -> dict[tuple[int, str], ML.SvmSgdModel]:
    """The linear models of the trials at ``places`` of the sides; ``stats``
    are :func:`~quarry.operators.models.block_stats` of their raw features."""
    fitted = {}
    found = [stats[it] for it in places]
    for name, make, col in _line_up():
        model = make()
        views = [side_view(n_feats, k, True, stats[it][2:] if col == "norm_features" else None) for it, k in places.items()]
        if views and isinstance(model, ML.SvmSgd):
            kind, weights = ML.SvmSgdModel, model.fit_blocks(points, views, found)
        elif views and ML.takes_newton(model, n_feats):
            kind, weights = ML.LogisticModel, ML.fit_logistic_blocks(
                points, views, model.getMaxIter(), model.getTol(), found)
        else:
            continue
        fitted |= {(it, name): kind(w, col) for it, w in zip(places, weights, strict=True)}
    return fitted


def _shared(model, n_feats: int) -> str | None:
    """How a model is fitted for many trials at once, if it is."""
    if isinstance(model, ML.SvmSgd) or ML.takes_newton(model, n_feats):
        return "linear"
    return "trees" if TF.tree_spec(model, n_feats) else None


def _tree_specs(n_feats: int) -> dict[str, TF.TreeSpec]:
    specs = {name: TF.tree_spec(make(), n_feats) for name, make, _ in _line_up()}
    return {name: spec for name, spec in specs.items() if spec}


def _fit_trees(coded: RDD, ranges: Sequence[TF.Ranges], specs: dict[str, TF.TreeSpec], places: dict[int, int],
               train_rows: dict[int, int], ends: dict[int, tuple]) -> dict[tuple[int, str], TF.TreesModel]:
    """The trees of the trials at ``places`` of the sides.  Their training sees
    the order of values only, which scaling keeps."""
    trials = [TF.Trial(it, k // SIDE_BITS, k % SIDE_BITS, train_rows[it]) for it, k in places.items()]
    models = TF.fit_trees(coded, ranges, trials, specs)
    scaled = {name for name, _, col in _line_up() if col == "norm_features"}
    return {(it, name): m.scaled(*ends[it]) if name in scaled else m for (it, name), m in models.items()}


def _line_up() -> list[tuple[str, Callable, str]]:
    """(name, model, column of its features) of a trial's models."""
    return [(*m, "features") for m in RAW_MODELS] + [(*m, "norm_features") for m in NORMALIZED_MODELS]


def _with_feature_vectors(df: DataFrame, feats: Sequence[str], stats: dict | None) -> DataFrame:
    """``(label, features, norm_features)``: the raw feature vector and, when
    ``stats`` is given, the min-max scaled one, side by side on each row."""
    cols = [F.col("label"), *[_q(c) for c in feats]]
    if stats is not None:
        cols += [min_max_expr(_q(c), *stats[c]).alias(f"__n_{c}") for c in feats]
    wide = df.select(*cols)
    vec = VectorAssembler(inputCols=list(feats), outputCol="features", handleInvalid="error")
    out = vec.transform(wide)
    keep = ["label", "features"]
    if stats is not None:
        nvec = VectorAssembler(inputCols=[f"__n_{c}" for c in feats], outputCol="norm_features",
                               handleInvalid="error")
        out = nvec.transform(out)
        keep.append("norm_features")
    return out.select(*keep)


def class_counts(points: RDD, n_feats: int, trials: dict[int, tuple[int, dict, Sequence[tuple]]]) -> dict[int, np.ndarray]:
    """Per trial, (place of its sides, the test side's (min, max) per feature,
    (column of its features, model) of its models), the test rows of each label
    and classes: bit 0 of the place is the label, bit i + 1 the class by model i."""
    def sums(block: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for it, (k, ends, models) in trials.items():
            sign, x = side_view(n_feats, k, False)(block)
            lo, hi = np.array(list(ends.values())).T
            x = {"features": x, "norm_features": ML.scaled(x, lo, hi)}
            code = (sign > 0.0).astype(np.int64)
            for i, (col, model) in enumerate(models, 1):
                code += model.classes(x[col]).astype(np.int64) << i
            yield it, np.bincount(code, minlength=2 ** (1 + len(models)))

    return TF.sums_by_key(points, sums, len(trials)).collectAsMap()


def _own_predictions(shared: TrialTable, feats: Sequence[str], iteration: int, jobs: Sequence[tuple], stats: dict,
                     parallelism: int) -> DataFrame:
    """The test side with the predictions ``__p0``, ... of its models, those
    that are not shared fitted on the training side."""
    side = shared.on_train[iteration]
    tasks = -(-shared.train_rows[iteration] // ROWS_PER_TASK)
    train = _with_feature_vectors(shared.rows.filter(side).coalesce(tasks), feats, stats["train"]).persist()
    try:
        def fit(job):
            name, make, col = job
            return shared.model(iteration, name, make, len(feats)) or make().setFeaturesCol(col).fit(train)

        # Boosting first: its trees follow one another, so it takes longest.
        queue = sorted(range(len(jobs)), key=lambda i: jobs[i][1] is not ML.gradient_boosted_trees)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = dict(zip(queue, pool.map(lambda i: fit(jobs[i]), queue), strict=True))
    finally:
        train.unpersist()
    test = _with_feature_vectors(shared.rows.filter(~side), feats, stats["test"])
    for i, (_, _, col) in enumerate(jobs):
        test = ML.score(fitted[i], test, f"__p{i}", col)
    return test


def run_trial(spark: SparkSession, frame: DataFrame, feats: Sequence[str], iteration: int,
              train_share: float = TRIAL_TRAIN_SHARE, normalize_mode: str = "per_set",
              parallelism: int = 4, shared: TrialTable | None = None) -> list[tuple]:
    """One 60/40 holdout: fit every model, score all in one pass.

    ``shared`` is what :func:`trial_table` gives for several trials of
    ``frame``; a trial without it makes its own.  For models that are not
    shared the training side is persisted ONCE with both feature vectors (raw
    and min-max scaled); the test side is not cached: every model's prediction
    is added to the same rows and one aggregate counts all confusion cells.
    A side without rows is an error, never a shorter result.
    """
    if shared is None:
        with trial_table(frame, feats, [iteration], train_share, normalize_mode) as own:
            return run_trial(spark, frame, feats, iteration, train_share, normalize_mode, parallelism, own)
    stats = dict(shared.stats[iteration])
    if normalize_mode == "train":
        stats["test"] = stats.get("train")
    missing = [s for s in ("train", "test") if not shared.stats[iteration].get(s)]
    if missing:
        raise ValueError(f"trial {iteration}: no rows on the {' and '.join(missing)} side")
    jobs = _line_up()
    preds = [(name, f"__p{i}") for i, (name, _, _) in enumerate(jobs)]
    counts = shared.counts(iteration) if all(_shared(make(), len(feats)) for _, make, _ in jobs) else None
    if counts is not None:
        code = np.flatnonzero(counts)
        test = spark.createDataFrame(pa.table({
            "label": (code & 1).astype(float), "__n": counts[code],
            **{p: (code >> i & 1).astype(float) for i, (_, p) in enumerate(preds, 1)}}))
    else:
        test = _own_predictions(shared, feats, iteration, jobs, stats, parallelism)
    rows = M.confusion_by_model(test, preds, count="__n" if counts is not None else None).collect()
    order = {name: i for i, (name, _, _) in enumerate(jobs)}
    rows = sorted(rows, key=lambda r: order[r["test"]])
    return [(int(iteration), r["test"], int(r["fp"]), int(r["tn"]), int(r["tp"]), int(r["fn"]),
             r["accuracy"], r["auc"]) for r in rows]


def trials_at_once(spark: SparkSession, shared: TrialTable, concurrent_trials: int, rows_at_once: int) -> int:
    """``concurrent_trials``, or more (up to one a core) while their training
    sides have together no more than ``rows_at_once`` rows."""
    fit_in = rows_at_once // max([1, *shared.train_rows.values()])
    return max(1, concurrent_trials, min(fit_in, spark.sparkContext.defaultParallelism))


def repeated_holdout(spark: SparkSession, frame: DataFrame, iterations: int = TRIAL_ITERATIONS,
                     train_share: float = TRIAL_TRAIN_SHARE, normalize_mode: str = "per_set",
                     parallelism: int = 4, concurrent_trials: int = 1, rows_at_once: int = 0) -> DataFrame:
    """``(iteration, test, fp, tn, tp, fn, accuracy, auc)`` for every trial
    and model.  ``frame`` is ``(__row, label, *double features)``, read and
    cached once for all trials.

    ``concurrent_trials`` trials run at once (each caches its own training
    side while it runs): small fits are bound by job latency and overlapping
    keeps the cores busy; on large data keep 1 so that one training side is
    cached at a time.  Trials of few rows overlap more, see :func:`trials_at_once`.
    """
    feats = [c for c in frame.columns if c not in ("label", ROW)]

    numbers = range(1, iterations + 1)
    with trial_table(frame, feats, numbers, train_share, normalize_mode) as shared:
        def one(it: int) -> list[tuple]:
            return run_trial(spark, frame, feats, it, train_share, normalize_mode, parallelism, shared)

        with ThreadPoolExecutor(trials_at_once(spark, shared, concurrent_trials, rows_at_once)) as pool:
            parts = list(pool.map(one, numbers))
    return result_rows(spark, [r for part in parts for r in part], TRIAL_SCHEMA)


def settings_digest(train_share: float = TRIAL_TRAIN_SHARE, normalize_mode: str = "per_set",
                    models: Sequence[tuple[str, Callable]] = (*RAW_MODELS, *NORMALIZED_MODELS)) -> str:
    """Digest of all that a trial's result depends on beside its rows: the
    split, the scaling and every parameter of every model."""
    def params(make: Callable) -> list:
        m = make()
        if hasattr(m, "extractParamMap"):
            return [type(m).__name__, *sorted((p.name, str(v)) for p, v in m.extractParamMap().items()
                                              if not p.name.endswith("Col"))]
        return [type(m).__name__, *sorted((k, str(v)) for k, v in m.settings.items())]

    what = [FIT_VERSION, train_share, normalize_mode, [(name, params(make)) for name, make in models]]
    return hashlib.sha1(repr(what).encode()).hexdigest()[:16]


def ledger_holdout(spark: SparkSession, frame: Callable[[], DataFrame], version: str,
                   iterations: int = TRIAL_ITERATIONS, train_share: float = TRIAL_TRAIN_SHARE,
                   normalize_mode: str = "per_set", parallelism: int = 4,
                   concurrent_trials: int = 1, rows_at_once: int = 0) -> DataFrame:
    """:func:`repeated_holdout` with a ledger in the shared folder, a folder
    per ``version`` of the rows, settings and trial.  A trial is written when
    it is done (Spark's success marker says so), and only trials that are not
    there are run, so a failed driver loses the trials under way and no other
    (a rerun makes the :func:`trial_table` of the missing trials again).
    ``frame`` makes the rows, if any trial is missing."""
    base = shared_dir(spark, "trial_ledger", version, settings_digest(train_share, normalize_mode))
    paths = {it: f"{base}/iteration-{it}" for it in range(1, iterations + 1)}
    missing = [it for it, path in paths.items() if not complete(spark, path)]
    if missing:
        rows = frame()
        feats = [c for c in rows.columns if c not in ("label", ROW)]

        with trial_table(rows, feats, missing, train_share, normalize_mode) as shared:
            def one(it: int) -> None:
                trial = run_trial(spark, rows, feats, it, train_share, normalize_mode, parallelism, shared)
                result_rows(spark, trial, TRIAL_SCHEMA).write.mode("overwrite").parquet(paths[it])

            with ThreadPoolExecutor(trials_at_once(spark, shared, concurrent_trials, rows_at_once)) as pool:
                list(pool.map(one, missing))
    return spark.read.schema(TRIAL_SCHEMA).parquet(*paths.values())


def trial_averages(trials: DataFrame) -> DataFrame:
    """Mean of each measure per model over the trials."""
    return trials.groupBy("test").agg(
        F.count(F.lit(1)).alias("trials"), F.avg("fp").alias("avg_fp"),
        F.avg("tn").alias("avg_tn"), F.avg("tp").alias("avg_tp"), F.avg("fn").alias("avg_fn"),
        F.avg("accuracy").alias("avg_accuracy"), F.avg("auc").alias("avg_auc"))


# --- pairwise linear SVM (three classes) ------------------------------------

# The pair tests -- (name, classes kept, class mapped to 1.0).
PAIR_TESTS = (
    ("[Labels 0 and 1]", (0.0, 1.0), 1.0),
    ("[Labels 0 and 2]", (0.0, 2.0), 2.0),
    ("[Labels 1 and 2]", (1.0, 2.0), 1.0),
)
EXPANDED_TEST = "[Kernel Expanded Labels 1 and 2]"
PAIR_SPLIT_SEED = 14

PAIR_SCHEMA = T.StructType([
    T.StructField("pair", T.StringType()), T.StructField("train_rows", T.LongType()),
    T.StructField("test_rows", T.LongType()), T.StructField("correct", T.LongType()),
    T.StructField("incorrect", T.LongType()), T.StructField("auc", T.DoubleType())])


def svm_sides(data: DataFrame, feats: Sequence[str], seed: int = PAIR_SPLIT_SEED
              ) -> tuple[DataFrame, DataFrame]:
    """``(label, *feats)`` of both sides of a 60/40 split by row id."""
    sided = data.select(ROW, "label", *[_q(c) for c in feats]).withColumn("__side", trial_side(seed))
    return tuple(sided.filter(F.col("__side") == side).drop(ROW, "__side") for side in ("train", "test"))


def pair_view(keep: tuple[float, float], pos: float, expand: bool, ends: tuple | None = None) -> Callable:
    """The view of a class pair in blocks of a label and features: signs of the
    pair's rows and features, kernel-expanded if ``expand`` and scaled by
    ``ends``, (minima, maxima)."""
    neg = keep[0] if keep[1] == pos else keep[1]

    def view(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sign = (block[0] == pos).astype(float) - (block[0] == neg)
        x = block[1:]
        if expand:
            x = np.stack(kernel_terms(x, float), axis=1).reshape(-1, len(sign))
        return sign, x if ends is None else ML.scaled(x, *ends)

    return view


class PairFit(NamedTuple):
    """A pair test's model: its rows, min and max per column, and weights."""

    name: str
    keep: tuple[float, float]
    pos: float
    expand: bool
    train_rows: int
    ends: tuple
    weights: list[float]


def fit_pairs(train: DataFrame, tests: Sequence[tuple]) -> list[PairFit]:
    """The SVMs of ``tests``, (name, classes kept, class mapped to 1.0,
    kernel-expanded), on the training side ``(label, *features)``.  Its rows
    are packed and cached once for all tests, and a step is one job for all."""
    points = ML.number_blocks(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = ML.block_stats(points, [pair_view(*t[1:]) for t in tests])
        ends = [(lo, hi) for _, _, lo, hi in stats]
        weights = ML.svm_sgd().fit_blocks(points, [pair_view(*t[1:], e) for t, e in zip(tests, ends, strict=True)])
    finally:
        points.unpersist()
    return [PairFit(*t, n, e, w) for t, (n, *_), e, w in zip(tests, stats, ends, weights, strict=True)]


def pair_scored(test: DataFrame, feats: Sequence[str], fit: PairFit) -> DataFrame:
    """``(score, label)``: raw margins of the pair's rows on the test side."""
    rows = relabel_pair(class_pair_subset(test, fit.keep), fit.pos)
    if fit.expand:
        rows = kernel_expand(rows, feats, keep=("label",))
    cols = [c for c in rows.columns if c != "label"]
    stats = {c: (float(lo), float(hi)) for c, lo, hi in zip(cols, *fit.ends, strict=True)}
    return min_max_normalize(rows, cols, stats).select(
        F.expr(ML.margin_sql(fit.weights, cols)).alias("score"), "label")


def pair_result(test: DataFrame, feats: Sequence[str], fit: PairFit) -> tuple:
    """``(name, train_rows, test_rows, correct, incorrect, auc)``."""
    scored = pair_scored(test, feats, fit).persist()
    try:
        ci = M.correct_incorrect(scored, M.margin_correct("score", "label")).first()
        auc = M.auc_roc(scored, "score", "label").first()["auc"]
    finally:
        scored.unpersist()
    return (fit.name, fit.train_rows, int(ci["correct"] + ci["incorrect"]), int(ci["correct"]),
            int(ci["incorrect"]), auc)


def pair_tests(expand: bool = True) -> list[tuple]:
    """The three class-pair tests, plus the kernel-expanded pair 1/2."""
    return [(*t, False) for t in PAIR_TESTS] + ([(EXPANDED_TEST, (1.0, 2.0), 1.0, True)] if expand else [])


def pairwise_svm(spark: SparkSession, data: DataFrame, feats: Sequence[str],
                 expand: bool = True, parallelism: int = 4) -> DataFrame:
    """Hits and AUC of the pair tests of :func:`pair_tests`."""
    train, test = svm_sides(data, feats)
    fits = fit_pairs(train, pair_tests(expand))
    test = test.persist()  # split once for all pairs
    try:
        test.count()
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = list(pool.map(lambda f: pair_result(test, feats, f), fits))
    finally:
        test.unpersist()
    return result_rows(spark, rows, PAIR_SCHEMA)


WEIGHTS_SCHEMA = T.StructType([T.StructField("pair", T.StringType()), T.StructField("feature", T.StringType()),
                               T.StructField("weight", T.DoubleType())])


def pairwise_svm_weights(spark: SparkSession, data: DataFrame, feats: Sequence[str],
                         expand: bool = True) -> DataFrame:
    """``(pair, feature, weight)`` of the pair tests' models."""
    rows = []
    for f in fit_pairs(svm_sides(data, feats)[0], pair_tests(expand)):
        cols = [f"k{i}" for i in range(len(f.weights))] if f.expand else feats
        rows += [(f.name, c, w) for c, w in zip(cols, f.weights, strict=True)]
    return result_rows(spark, rows, WEIGHTS_SCHEMA)


# --- single holdout of a multiclass tree -----------------------------------

def fit_holdout_tree(data: DataFrame, feats: Sequence[str], salt: str = "holdout"):
    """Train the depth-4 gini tree on the train part of an 80/10/10 split by
    row id; returns (model, frame with features and split)."""
    side = split_column(F.concat_ws("|", F.col(ROW), F.lit(salt)), (80, 10, 10),
                        ("train", "cv", "test"))
    tagged = assemble(data.withColumn("split", side).select("split", "label", *feats), feats,
                      keep=("split",))
    train = tagged.filter(F.col("split") == "train").persist()
    try:
        model = ML.decision_tree().fit(train)
    finally:
        train.unpersist()
    return model, tagged
