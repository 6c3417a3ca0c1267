"""Trained trees as tables, and as one column expression.

``tree_nodes`` reads the nodes of a fitted decision tree from the files that
Spark writes for it; ``compile_tree`` turns a node table into a ``CASE`` over
plain columns, which stays in generated code and needs no vectors.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.cleaning import _q
from quarry.session import shared_dir


def tree_nodes(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """``(id, parent, side, feature, threshold, gain, impurity, prediction,
    n_rows, counts)``: one row per node, the root without parent.  Rows with
    ``feature <= threshold`` go to the left child; leaves have no feature.
    ``counts`` are the training rows per class."""
    path = shared_dir(spark, "trees", uuid.uuid4().hex)
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    names = F.array(*[F.lit(c) for c in features])
    inner = F.col("leftChild") >= 0
    # A tree has few nodes, at most two to the power of its depth plus one.
    links = nodes.where(inner).select(F.inline(F.array(*[
        F.struct(F.col("id").alias("_parent"), F.col(c).alias("_child"), F.lit(s).alias("_side"))
        for c, s in (("leftChild", "L"), ("rightChild", "R"))])))
    return nodes.join(F.broadcast(links), F.col("id") == F.col("_child"), "left").select(
        "id", F.col("_parent").alias("parent"), F.col("_side").alias("side"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.when(inner, F.col("gain")).alias("gain"), "impurity", "prediction",
        F.col("rawCount").alias("n_rows"),
        F.transform("impurityStats", lambda x: x.cast("long")).alias("counts"))


def compile_tree(nodes: DataFrame) -> Column:
    """The tree's prediction as one expression over its feature columns."""
    rows = {r["id"]: r for r in nodes.collect()}
    children = {(r["parent"], r["side"]): i for i, r in rows.items() if r["parent"] is not None}

    def at(i: int) -> Column:
        r = rows[i]
        if r["feature"] is None:
            return F.lit(float(r["prediction"]))
        goes_left = _q(r["feature"]).cast("double") <= F.lit(float(r["threshold"]))
        return F.when(goes_left, at(children[i, "L"])).otherwise(at(children[i, "R"]))

    return at(next(i for i, r in rows.items() if r["parent"] is None))


def node_paths(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``path``, the sides taken from the root (root: empty)."""
    rows = {r["id"]: (r["parent"], r["side"]) for r in nodes.select("id", "parent", "side").collect()}

    def path(i: int) -> str:
        parent, side = rows[i]
        return "" if parent is None else path(parent) + side

    pairs = [x for i in rows for x in (F.lit(i), F.lit(path(i)))]
    return nodes.withColumn("path", F.create_map(*pairs)[F.col("id")])
