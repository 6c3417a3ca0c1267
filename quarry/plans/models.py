"""Model-training queries: trees, logistic regression, forest, boosting,
linear SVM, holdout metrics and repeated trials.

A trained model is not SQL-expressible, so the queries that report one have
no oracle.  The ``*_checks`` queries report what SQL can derive from the same
data (rows and positives of each split, class sizes) next to whether the model
beats the majority class; ``logistic_moments`` compares a condition that holds
at the optimum.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import features as FE
from quarry.operators import metrics as M
from quarry.operators import models as ML
from quarry.operators import trees as TB
from quarry.operators import trials as TR
from quarry.operators.cleaning import ROW, drop_unlabeled
from quarry.plans.cleaning import FILL_SQL, HEALTHY_SQL, PREPARED_COLS, TEXT_SQL, prepared
from quarry.plans.fixtures import (CLASSES_7, FORMAT_VERSION, FLAG_FEATURES, FLAG_LABEL_SQL, LINE_KEYS,
                                   SEVEN_CLASS_SQL, flags, named_class_lines,
                                   numeric_class_lines, seven_class)
from quarry.plans.registry import query
from quarry.session import table_version
from quarry.sources import delimited as DL
from quarry.sources.tables import table
from quarry.sources.text import read_text_lines

#: Trials at once in the registered query (each caches its training side).
CONCURRENT_TRIALS = 2
#: More of them while their training sides have together at most so many rows.
TRIAL_ROWS_AT_ONCE = 4_000_000


def trial_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned clinical table as ``(__row, label, *double features)``."""
    rows = prepared(spark, sf_dir, keep_row=True)
    feats = [c for c in rows.columns if c not in ("exam_result", ROW)]
    return rows.select(F.col(ROW), FE.to_double_or_zero(rows, "exam_result").alias("label"),
                       *[FE.to_double_or_zero(rows, c).alias(c) for c in feats])


def _features(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in ("label", ROW)]


def _numeric_class_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_text_lines(spark, numeric_class_lines(spark, sf_dir))
    return TR.with_row_id(spark, DL.parse_last_label(lines, n_features=4))


def _tree_holdout(spark: SparkSession, sf_dir: str):
    data = _numeric_class_points(spark, sf_dir)
    return TR.fit_holdout_tree(data, _features(data))


@query("decision_tree_multiclass")
def q_decision_tree_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-class tree: per-class precision on the cv and test splits."""
    model, tagged = _tree_holdout(spark, sf_dir)
    scored = ML.predict(model, tagged.filter(F.col("split") != "train"))
    return M.class_stats(scored, CLASSES_7, by=["split"])


@query("holdout_metrics")
def q_holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-class tree: rows, accuracy and weighted precision on the cv
    and test splits (one aggregate grouped by split)."""
    model, tagged = _tree_holdout(spark, sf_dir)
    scored = ML.predict(model, tagged.filter(F.col("split") != "train"))
    return M.multiclass_summary(scored, CLASSES_7, by=["split"])


@query("holdout_checks", f"SELECT {SEVEN_CLASS_SQL}::DOUBLE AS label, count(*)::BIGINT AS n_label, "
       "TRUE AS better FROM lineitem GROUP BY 1")
def q_holdout_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class: its rows over all three splits, and whether the tree's test
    accuracy beats the share of the largest class."""
    model, tagged = _tree_holdout(spark, sf_dir)
    stats = M.class_stats(ML.predict(model, tagged), CLASSES_7, by=["split"])
    test = stats.filter(F.col("split") == "test").agg(
        (F.first("hits") / F.first("rows") > F.max("n_label") / F.first("rows")).alias("better")).first()
    return (stats.groupBy("label").agg(F.sum("n_label").alias("n_label")).filter("n_label > 0")
            .withColumn("better", F.lit(bool(test["better"]))))


# --- a tree's nodes -----------------------------------------------------------
# Features of few values, so that every boundary between two values is a split.
TREE_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")
_SEVEN = range(7)


def _gini_sql(prefix: str, n: str) -> str:
    return "(1.0::DOUBLE - " + " - ".join(f"({prefix}{k} / {n}) * ({prefix}{k} / {n})" for k in _SEVEN) + ")"


def _tree_sql(depth: int = ML.TREE_DEPTH) -> str:
    """The greedy gini tree, level by level, from the counts per value and
    class; then sibling leaves of one prediction are merged, deepest first."""
    c = ", ".join(f"count_if(y = {k}) AS c{k}" for k in _SEVEN)
    feats = ", ".join(f"{f}::DOUBLE AS x{i}" for i, f in enumerate(TREE_FEATURES))
    values = "\n  UNION ALL\n  ".join(f"SELECT DISTINCT {i} AS f, x{i} AS v FROM base" for i in range(4))
    pred = "list_position(counts, list_max(counts)) - 1"
    out = [f"""WITH base AS MATERIALIZED (SELECT {SEVEN_CLASS_SQL}::INTEGER AS y, {feats} FROM lineitem),
bounds AS (SELECT f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2.0::DOUBLE AS threshold FROM (
  {values})),
rows0 AS MATERIALIZED (SELECT '' AS path, * FROM base)"""]
    for d in range(depth + 1):
        out.append(f"""node{d} AS MATERIALIZED (
  SELECT path, n, [{", ".join(f"c{k}" for k in _SEVEN)}] AS counts, {_gini_sql("c", "n")} AS impurity
  FROM (SELECT path, count(*) AS n, {c} FROM rows{d} GROUP BY path))""")
        if d == depth:
            break
        cells = "\n  UNION ALL\n  ".join(
            f"SELECT path, {i} AS f, x{i} AS v, {c} FROM rows{d} GROUP BY path, x{i}" for i in range(4))
        left = ", ".join(f"sum(c{k}) OVER w AS a{k}" for k in _SEVEN)
        both = ", ".join(f"(sum(c{k}) OVER (PARTITION BY path, f)) - (sum(c{k}) OVER w) AS b{k}" for k in _SEVEN)
        na, nb = ("(" + " + ".join(f"{x}{k}" for k in _SEVEN) + ")" for x in "ab")
        out.append(f"""best{d} AS MATERIALIZED (
  SELECT * FROM (
    SELECT path, f, threshold, gain, row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, v) AS r FROM (
      SELECT s.path, s.f, s.v, threshold, impurity - na / (na + nb) * {_gini_sql("a", "na")}
        - nb / (na + nb) * {_gini_sql("b", "nb")} AS gain
      FROM (SELECT *, {na} AS na, {nb} AS nb FROM (
        SELECT path, f, v, {left}, {both} FROM ({cells})
        WINDOW w AS (PARTITION BY path, f ORDER BY v))) s
      JOIN node{d} USING (path) JOIN bounds b ON b.f = s.f AND b.v = s.v WHERE nb > 0))
  WHERE r = 1 AND gain > 0),
rows{d + 1} AS MATERIALIZED (
  SELECT path || CASE WHEN [x0, x1, x2, x3][f + 1] <= threshold THEN 'L' ELSE 'R' END AS path, y, x0, x1, x2, x3
  FROM rows{d} JOIN best{d} USING (path))""")
    every = "\n  UNION ALL\n  ".join(
        f"SELECT path, n, counts, impurity, {pred} AS p, " + (
            f"f, threshold, gain FROM node{d} LEFT JOIN best{d} USING (path)" if d < depth else
            f"NULL::INTEGER AS f, NULL::DOUBLE AS threshold, NULL::DOUBLE AS gain FROM node{d}")
        for d in range(depth + 1))
    out.append(f"tree{depth} AS MATERIALIZED ({every})")
    for d in reversed(range(depth)):
        out.append(f"""merged{d} AS (
  SELECT t.path FROM tree{d + 1} t JOIN tree{d + 1} a ON a.path = t.path || 'L' JOIN tree{d + 1} b ON b.path = t.path || 'R'
  WHERE len(t.path) = {d} AND a.f IS NULL AND b.f IS NULL AND a.p = b.p),
tree{d} AS MATERIALIZED (
  SELECT path, n, counts, impurity, p, CASE WHEN path NOT IN (FROM merged{d}) THEN f END AS f,
    CASE WHEN path NOT IN (FROM merged{d}) THEN threshold END AS threshold,
    CASE WHEN path NOT IN (FROM merged{d}) THEN gain END AS gain
  FROM tree{d + 1} WHERE NOT (len(path) = {d + 1} AND path[:{d}] IN (FROM merged{d})))""")
    names = ", ".join(f"'{f}'" for f in TREE_FEATURES)
    return ",\n".join(out) + f"""
SELECT path, [{names}][f + 1] AS feature, threshold, round(gain, 6) + 0.0 AS gain, round(impurity, 6) + 0.0 AS impurity,
  p::DOUBLE AS prediction, n::BIGINT AS n_rows, array_to_string(counts, ',') AS counts FROM tree0"""


def seven_class_tree(spark: SparkSession, sf_dir: str):
    """(model, rows with features) of the seven-class tree on all lines."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select((seven_class() - 1).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(c) for c in TREE_FEATURES])
    vectors = FE.assemble(rows, TREE_FEATURES, keep=TREE_FEATURES)
    return ML.decision_tree().fit(vectors), vectors


@query("tree_nodes", _tree_sql())
def q_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the seven-class tree: split, gain, gini, rows per class."""
    model, _ = seven_class_tree(spark, sf_dir)
    nodes = TB.node_paths(TB.tree_nodes(spark, model, TREE_FEATURES))
    return nodes.select("path", "feature", "threshold", F.round("gain", 6).alias("gain"),
                        F.round("impurity", 6).alias("impurity"), "prediction", "n_rows",
                        F.concat_ws(",", F.transform("counts", lambda x: x.cast("string"))).alias("counts"))


@query("tree_compiled", f"""SELECT count(*) AS n_rows, count(*) AS agreeing FROM lineitem""")
def q_tree_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on which the tree as one column expression agrees with the model."""
    model, vectors = seven_class_tree(spark, sf_dir)
    own = TB.compile_tree(TB.tree_nodes(spark, model, TREE_FEATURES))
    scored = ML.predict(model, vectors).withColumn("own", own)
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("own") == F.col("prediction")).alias("agreeing"))


def _binary_split(frame: DataFrame, scaled: bool) -> tuple[DataFrame, DataFrame]:
    """Trial 1's sides of the cleaned table as (label, features)."""
    frame = frame.withColumn("__side", TR.trial_side(1))
    feats = [c for c in _features(frame) if c != "__side"]
    train, test = (frame.filter(F.col("__side") == s) for s in ("train", "test"))
    if scaled:
        stats = FE.min_max_stats(train, feats)
        train, test = (FE.min_max_normalize(d.select("label", *feats), feats, stats)
                       for d in (train, test))
    return FE.assemble(train, feats), FE.assemble(test, feats)


# The binary models and whether they take min-max scaled features.
BINARY_MODELS = (
    ("Decision Tree", ML.decision_tree, False),
    ("Logistic Regression", ML.logistic_regression, False),
    ("Random Forest", ML.random_forest, False),
    ("Gradient Boosted Tree", ML.gradient_boosted_trees, False),
    ("Support Vector Machine", ML.svm_sgd, True),
)


def _binary_holdouts(spark: SparkSession, sf_dir: str, models: Sequence[tuple[str, Callable, bool]]) -> DataFrame:
    """One 60/40 holdout (trial 1's split) of each model on the cleaned table,
    which is prepared once; models of equally scaled features share the cached
    training side."""
    frame = trial_frame(spark, sf_dir)
    cells = []
    for scaled in sorted({m[2] for m in models}):
        train, test = _binary_split(frame, scaled)
        own = [(name, make) for name, make, s in models if s == scaled]
        cached = any(make is not ML.svm_sgd for _, make in own)  # which caches its own blocks
        if cached:
            train = train.persist()
        try:
            fitted = [(name, make().fit(train)) for name, make in own]
        finally:
            if cached:
                train.unpersist()
        for i, (_, model) in enumerate(fitted):
            test = ML.score(model, test, f"__p{i}", "features")
        cells.append(M.confusion_by_model(test, [(name, f"__p{i}") for i, (name, _) in enumerate(fitted)]))
    return reduce(DataFrame.unionByName, cells)


def _binary_holdout(spark: SparkSession, sf_dir: str, name: str, make: Callable, scaled: bool) -> DataFrame:
    return _binary_holdouts(spark, sf_dir, [(name, make, scaled)])


@query("decision_tree_binary")
def q_decision_tree_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary_holdout(spark, sf_dir, *BINARY_MODELS[0])


@query("logistic_regression")
def q_logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary_holdout(spark, sf_dir, *BINARY_MODELS[1])


@query("random_forest")
def q_random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary_holdout(spark, sf_dir, *BINARY_MODELS[2])


@query("gradient_boosted_trees")
def q_gradient_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary_holdout(spark, sf_dir, *BINARY_MODELS[3])


def _hash_sql(key: str) -> str:
    return f"('0x' || substr(md5({key}), 1, 8))::BIGINT"


B60, = FE.split_bounds((60, 40))
_ROW_SQL = "concat_ws('|', patient_id, linenumber)"
_LR_FEATS = tuple(c for c in PREPARED_COLS if c != "exam_result")
_LR_VALUE = {c: (f"coalesce({c}, m_{c})" if c in ("quantity", "price", "discount", "tax")
                 else TEXT_SQL.format(c=f"coalesce({c}, m_{c})") if c.endswith("_test") else c)
             for c in _LR_FEATS}


def _svm_sql(name: str, rows: str, p: int) -> str:
    """CTEs of one SVM: ``rows`` gives (side, y, x1..xp); they are scaled by
    the train side's minimum and maximum, ``{name}_w`` are the weights of every
    step and ``{name}_scored`` the margins of the test side."""
    i = range(1, p + 1)
    scaled = ", ".join(f"CASE WHEN hi{k} = lo{k} THEN 0.0::DOUBLE ELSE (x{k} - lo{k}) / (hi{k} - lo{k}) END AS x{k}"
                       for k in i)
    dot = " + ".join(f"w{k} * x{k}" for k in i)
    step = f"({ML.SVM_STEP}::DOUBLE / sqrt(it + 1))"
    norm = lambda xs: "sqrt(" + " + ".join(f"({x}) * ({x})" for x in xs) + ")"
    ended = (f"it > 0 AND {norm(f'n{k} - w{k}' for k in i)} < {ML.SVM_TOLERANCE} * "
             f"greatest({norm(f'n{k}' for k in i)}, 1.0::DOUBLE)")
    return f"""{name}_rows AS MATERIALIZED ({rows}),
{name}_ends AS MATERIALIZED (SELECT {", ".join(f"min(x{k}) AS lo{k}, max(x{k}) AS hi{k}" for k in i)}
  FROM {name}_rows WHERE side = 'train'),
{name}_scaled AS MATERIALIZED (SELECT side, y, {scaled} FROM {name}_rows, {name}_ends),
{name}_train AS MATERIALIZED (SELECT 2.0::DOUBLE * y - 1.0::DOUBLE AS s, * FROM {name}_scaled WHERE side = 'train'),
{name}_w AS (
  SELECT 0 AS it, false AS ended, {", ".join(f"0.0::DOUBLE AS w{k}" for k in i)}
  UNION ALL
  SELECT it + 1, {ended}, {", ".join(f"n{k}" for k in i)} FROM (
    SELECT it, {", ".join(f"w{k}" for k in i)}, {", ".join(
        f"w{k} * (1.0::DOUBLE - {step} * {ML.SVM_REG}::DOUBLE) - {step} * g{k} / n AS n{k}" for k in i)} FROM (
      SELECT it, {", ".join(f"w{k}" for k in i)}, count(*) AS n, {", ".join(
          f"sum(CASE WHEN s * ({dot}) < 1.0::DOUBLE THEN -s * x{k} ELSE 0.0::DOUBLE END) AS g{k}" for k in i)}
      FROM {name}_w, {name}_train WHERE it < {ML.SVM_ITERATIONS} AND NOT ended
      GROUP BY it, {", ".join(f"w{k}" for k in i)}))),
{name}_last AS (SELECT * FROM {name}_w ORDER BY it DESC LIMIT 1),
{name}_scored AS (SELECT y, {dot} AS score FROM {name}_scaled, {name}_last WHERE side = 'test')"""


@query("linear_svm", FILL_SQL.replace("WITH", "WITH RECURSIVE", 1) + ",\n" + _svm_sql("svm", f"""
  SELECT CASE WHEN {_hash_sql(_ROW_SQL + " || '|1'")} < {B60} THEN 'train' ELSE 'test' END AS side,
    exam_result::DOUBLE AS y, {", ".join(f"{v} AS x{i}" for i, v in enumerate(_LR_VALUE.values(), 1))}
  FROM healthy, st""", len(_LR_FEATS)) + """,
cells AS (SELECT count_if(score > 0 AND y = 0) AS fp, count_if(score <= 0 AND y = 0) AS tn,
  count_if(score > 0 AND y = 1) AS tp, count_if(score <= 0 AND y = 1) AS fn FROM svm_scored)
SELECT 'Support Vector Machine' AS test, *, (tp + tn) / (fp + tn + tp + fn) AS accuracy,
  (tp / (tp + fn) + tn / (tn + fp)) / 2.0::DOUBLE AS auc FROM cells""")
def q_linear_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary_holdout(spark, sf_dir, *BINARY_MODELS[4])


@query("binary_model_checks", HEALTHY_SQL + f""", t AS (
  SELECT count(*) AS n, count_if(exam_result = 1) AS p FROM healthy
  WHERE {_hash_sql(_ROW_SQL + " || '|1'")} >= {B60})
SELECT test, n::BIGINT AS test_rows, p::BIGINT AS positives,
  greatest(p, n - p) / n AS majority_share, TRUE AS better, TRUE AS both_classes
FROM t, (VALUES {", ".join(f"('{m[0]}')" for m in BINARY_MODELS)}) v(test)""")
def q_binary_model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each binary model on trial 1's split: rows and positives of the test
    side (from its confusion cells), and whether it beats the majority class
    and predicts both classes."""
    cells = _binary_holdouts(spark, sf_dir, BINARY_MODELS)
    n, pos = F.col("fp") + F.col("tn") + F.col("tp") + F.col("fn"), F.col("tp") + F.col("fn")
    share = F.greatest(pos, n - pos) / n
    return cells.select("test", n.alias("test_rows"), pos.alias("positives"),
                        share.alias("majority_share"), (F.col("accuracy") > share).alias("better"),
                        ((F.col("fp") + F.col("tp") > 0) & (F.col("tn") + F.col("fn") > 0))
                        .alias("both_classes"))


@query("logistic_moments", FILL_SQL + f""", train AS (
  SELECT exam_result AS y, {", ".join(f"{v} AS {c}" for c, v in _LR_VALUE.items())}
  FROM healthy, st WHERE {_hash_sql(_ROW_SQL + " || '|1'")} < {B60}),
s AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _LR_FEATS)} FROM train)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(avg(y * ({c} - lo_{c}) / (hi_{c} - lo_{c})), 3) AS moment "
    "FROM train, s" for c in _LR_FEATS))
def q_logistic_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a penalty a logistic regression at its optimum satisfies
    avg(p * x) = avg(y * x) on the training rows for every feature.  The query
    gives the left side from the fitted model, the oracle the right side."""
    train, _ = _binary_split(trial_frame(spark, sf_dir), scaled=True)
    train = train.persist()
    try:
        model = ML.logistic_regression().setTol(1e-10).setMaxIter(500).fit(train)
    finally:
        train.unpersist()
    scored = model.transform(train).select(vector_to_array("probability")[1].alias("p"),
                                           vector_to_array("features").alias("x"))
    wide = scored.agg(*[F.avg(F.col("p") * F.col("x")[i]).alias(f"m{i}") for i in range(len(_LR_FEATS))])
    out = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(f"m{i}"), 3).alias("moment"))
        for i, c in enumerate(_LR_FEATS)])))
    return out


_PAIR_DATA = f"""flagged AS MATERIALIZED (
  SELECT concat_ws('|', {", ".join(LINE_KEYS)}) AS key, {FLAG_LABEL_SQL} AS label, {", ".join(FLAG_FEATURES)} FROM lineitem)"""


def _pair_rows_sql(key: str, source: str, keep: tuple, pos: float, features: list[str]) -> str:
    side = f"CASE WHEN {_hash_sql(f"{key} || '|{TR.PAIR_SPLIT_SEED}'")} < {B60} THEN 'train' ELSE 'test' END"
    x = ", ".join(f"{v} AS x{i}" for i, v in enumerate(features, 1))
    return (f"SELECT {side} AS side, CASE WHEN label = {pos} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, {x} "
            f"FROM {source} WHERE label IN ({keep[0]}, {keep[1]})")


@query("linear_svm_margin", "WITH RECURSIVE " + _PAIR_DATA + ",\n" + _svm_sql("svm", _pair_rows_sql(
    "key", "flagged", (0.0, 2.0), 2.0, list(FLAG_FEATURES)), 4) + """
SELECT y AS label, round(score, 6) + 0.0 AS score,
  (score < 0 AND y = 0) OR (score > 0 AND y = 1) AS correct FROM svm_scored""")
def q_linear_svm_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw SVM margins of the test rows of class pair 0/2 (2 -> 1)."""
    data = flags(spark, sf_dir).withColumn(ROW, FE.row_key(LINE_KEYS))
    train, test = TR.svm_sides(data.filter(F.col("label").isin(0.0, 2.0)), FLAG_FEATURES)
    fit, = TR.fit_pairs(train, [("[Labels 0 and 2]", (0.0, 2.0), 2.0, False)])
    scored = TR.pair_scored(test, FLAG_FEATURES, fit)
    return scored.select("label", F.round("score", 6).alias("score"),
                         M.margin_correct("score", "label").alias("correct"))


_KERNEL = [t for c in FLAG_FEATURES for t in (f"{c} * {FE.KERNEL_SCALE!r}::DOUBLE", f"{c} * {c}", f"{c} * {c} * {c}")]
_PAIR_MODELS = [(f"p{i}", name, keep, pos, list(FLAG_FEATURES)) for i, (name, keep, pos) in enumerate(TR.PAIR_TESTS)]
_PAIR_MODELS += [("p3", TR.EXPANDED_TEST, (1.0, 2.0), 1.0, _KERNEL)]
_PAIR_SVM_SQL = "WITH RECURSIVE " + _PAIR_DATA + ",\n" + ",\n".join(
    _svm_sql(cte, _pair_rows_sql("key", "flagged", keep, pos, feats), len(feats))
    for cte, _, keep, pos, feats in _PAIR_MODELS)


def _pair_auc_sql(cte: str) -> str:
    return f"""(SELECT sum(p * (2 * below + n)) / (2.0::DOUBLE * sum(p) * sum(n)) FROM (
      SELECT p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT round(score, 9) AS s, count_if(y = 1) AS p, count_if(y = 0) AS n FROM {cte}_scored GROUP BY 1)))"""


def _pair_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-class rows of lineitem with their own row id."""
    return (drop_unlabeled(flags(spark, sf_dir)).withColumn(ROW, FE.row_key(LINE_KEYS))
            .drop(*LINE_KEYS))


@query("pairwise_svm_weights", _PAIR_SVM_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS pair, '{f'k{i - 1}' if cte == 'p3' else feats[i - 1]}' AS feature, round(w{i}, 4) + 0.0 AS weight "
    f"FROM {cte}_last" for cte, name, _, _, feats in _PAIR_MODELS for i in range(1, len(feats) + 1)))
def q_pairwise_svm_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the three pair models and the kernel-expanded one."""
    w = TR.pairwise_svm_weights(spark, _pair_points(spark, sf_dir), list(FLAG_FEATURES))
    return w.withColumn("weight", F.round("weight", 4))


@query("pairwise_svm_holdout", _PAIR_SVM_SQL + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS pair, (SELECT count(*) FROM {cte}_train) AS train_rows, count(*) AS test_rows,
  count_if((score < 0 AND y = 0) OR (score > 0 AND y = 1)) AS correct,
  count_if(NOT ((score < 0 AND y = 0) OR (score > 0 AND y = 1))) AS incorrect, round({_pair_auc_sql(cte)}, 6) AS auc
FROM {cte}_scored""" for cte, name, _, _, _ in _PAIR_MODELS))
def q_pairwise_svm_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and AUC of the pair tests on the table's own rows (their ids are
    in the table, so SQL can split them too)."""
    r = TR.pairwise_svm(spark, _pair_points(spark, sf_dir), list(FLAG_FEATURES))
    return r.withColumn("auc", F.round("auc", 6))


@query("pairwise_svm")
def q_pairwise_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three-class flow from its text file: parse four numbers and a
    class name, drop unknown classes, then class pairs 0/1, 0/2, 1/2 and the
    kernel-expanded pair 1/2: hits and AUC.  Lines have no id, so the split
    goes by their place; ``pairwise_svm_holdout`` is the same on the table."""
    lines = read_text_lines(spark, named_class_lines(spark, sf_dir))
    points = TR.with_row_id(spark, drop_unlabeled(DL.parse_text_label(lines, n_features=4)))
    return TR.pairwise_svm(spark, points, _features(points))


_PAIR_ROWS = [(name, keep) for name, keep, _ in TR.PAIR_TESTS] + [
    (TR.EXPANDED_TEST, (1.0, 2.0))]


@query("pairwise_svm_checks", f"WITH c AS (SELECT {FLAG_LABEL_SQL} AS label FROM lineitem)\n"
       + "\nUNION ALL\n".join(
           f"SELECT '{name}' AS pair, count_if(label IN ({a}, {b}))::BIGINT AS pair_rows, "
           "TRUE AS all_tested, TRUE AS better FROM c" for name, (a, b) in _PAIR_ROWS))
def q_pairwise_svm_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per pair: rows of both sides, whether every test row got a margin, and
    whether hits and AUC are well above chance."""
    r = q_pairwise_svm(spark, sf_dir)
    return r.select("pair", (F.col("train_rows") + F.col("test_rows")).alias("pair_rows"),
                    (F.col("correct") + F.col("incorrect") == F.col("test_rows")).alias("all_tested"),
                    ((F.col("correct") > F.col("incorrect")) & (F.col("auc") > 0.6)).alias("better"))


@query("trial_results")
def q_trial_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30 repeated 60/40 holdouts of four raw and four normalised models: 240
    rows.  Trials are kept in a ledger per version of the table and of the
    settings: a run that was cut short goes on after its last trial, reports
    read the same rows, and other settings have rows of their own."""
    version = table_version(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return TR.ledger_holdout(spark, lambda: trial_frame(spark, sf_dir), f"{version}-{FORMAT_VERSION}",
                             concurrent_trials=CONCURRENT_TRIALS, rows_at_once=TRIAL_ROWS_AT_ONCE)


@query("trial_averages")
def q_trial_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TR.trial_averages(q_trial_results(spark, sf_dir))


_TEST_NAMES = ", ".join(f"('{n}')" for n, _ in (*TR.RAW_MODELS, *TR.NORMALIZED_MODELS))


@query("trial_average_sums", HEALTHY_SQL + f""", t AS (
  SELECT i, count(*) AS n, count_if(exam_result = 1) AS p FROM healthy, range(1, {TR.TRIAL_ITERATIONS + 1}) r(i)
  WHERE {_hash_sql(_ROW_SQL + " || '|' || i")} >= {B60} GROUP BY i)
SELECT test, count(*) AS trials, round(avg(n), 6) AS avg_rows, round(avg(p), 6) AS avg_positives,
  round(avg(n - p), 6) AS avg_negatives FROM t, (VALUES {_TEST_NAMES}) v(test) GROUP BY test""")
def q_trial_average_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of ``trial_averages``: the averages of the confusion
    cells add up to the average test side, its positives and negatives."""
    a = q_trial_averages(spark, sf_dir)
    pos, neg = F.col("avg_tp") + F.col("avg_fn"), F.col("avg_tn") + F.col("avg_fp")
    return a.select("test", "trials", F.round(pos + neg, 6).alias("avg_rows"), F.round(pos, 6).alias("avg_positives"),
                    F.round(neg, 6).alias("avg_negatives"))


@query("trial_checks", HEALTHY_SQL + f""", t AS (
  SELECT i, count(*) AS n, count_if(exam_result = 1) AS p FROM healthy, range(1, {TR.TRIAL_ITERATIONS + 1}) r(i)
  WHERE {_hash_sql(_ROW_SQL + " || '|' || i")} >= {B60} GROUP BY i)
SELECT i::INTEGER AS iteration, 8::BIGINT AS models, n::BIGINT AS test_rows, p::BIGINT AS positives,
  TRUE AS trees_better FROM t""")
def q_trial_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per trial: number of models, rows and positives of the test side (the
    same from every model's cells, else null), and whether all tree models
    beat the majority class."""
    n, pos = F.col("fp") + F.col("tn") + F.col("tp") + F.col("fn"), F.col("tp") + F.col("fn")
    r = q_trial_results(spark, sf_dir).select("*", n.alias("n"), pos.alias("p"))
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c))
    better = F.col("accuracy") > F.greatest("p", F.col("n") - F.col("p")) / F.col("n")
    return r.groupBy("iteration").agg(
        F.count(F.lit(1)).alias("models"), one("n").alias("test_rows"), one("p").alias("positives"),
        F.min(better | ~F.col("test").rlike("Tree|Forest")).alias("trees_better"))
