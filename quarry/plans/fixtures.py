"""Inputs the registered queries derive from the test tables.

Each derived frame has a Spark form and a DuckDB SQL twin (a CTE body) that
computes the same rows, so the oracle sees identical inputs.  Derived files
(CSV, libsvm, delimited lines) are written below the session's shared
checkpoint folder, never to a machine-local path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import complete, shared_dir, table_version
from quarry.sources import delimited as DL
from quarry.sources import files as FS
from quarry.sources.tables import table

FORMAT_VERSION = "v2"

# --- masked lineitem: a sparse "clinical" table -----------------------------
# Sparse rows: half the lines of every 7th order lose five cells.
# patient_id (= order key) repeats, so a sparse row can share its id with a
# healthy row.  tax_sparse is 2 % filled (below the 5 % cut).


def _sparse_row() -> Column:
    return (F.col("l_orderkey") % 7 == 0) & (F.col("l_linenumber") % 2 == 1)


def _positive() -> Column:
    """The exam depends on two features, with one row in ten turned round."""
    rule = F.col("l_quantity") + F.lit(100.0) * F.col("l_tax") > F.lit(32.0)
    return rule != (F.col("l_partkey") % 10 == 0)


def clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    sparse = _sparse_row()
    return li.select(
        F.col("l_orderkey").alias("patient_id"),
        F.when(_positive(), F.lit("positive")).otherwise(F.lit("negative")).alias("exam_result"),
        F.col("l_quantity").alias("quantity"),
        F.when(~sparse, F.col("l_extendedprice")).alias("price"),
        F.when(~sparse & (F.col("l_partkey") % 3 != 0), F.col("l_discount")).alias("discount"),
        F.when(F.col("l_partkey") % 50 == 0, F.col("l_tax")).alias("tax_sparse"),
        F.when(sparse | (F.col("l_partkey") % 4 == 0), F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "F", F.lit("detected"))
        .otherwise(F.lit("not_detected")).alias("status_test"),
        F.when(sparse, F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "A", F.lit("detected"))
        .otherwise(F.lit("not_detected")).alias("flag_test"),
        F.col("l_linenumber").alias("linenumber"),
        F.when(~sparse, F.col("l_tax")).alias("tax"),
    )


CLINICAL_COLUMNS = ("patient_id", "exam_result", "quantity", "price", "discount", "tax_sparse",
                    "status_test", "flag_test", "linenumber", "tax")

CLINICAL_SQL = """clinical AS (
  SELECT l_orderkey AS patient_id,
    CASE WHEN (l_quantity + 100.0::DOUBLE * l_tax > 32.0::DOUBLE) <> (l_partkey % 10 = 0)
         THEN 'positive' ELSE 'negative' END AS exam_result,
    l_quantity AS quantity,
    CASE WHEN NOT (l_orderkey % 7 = 0 AND l_linenumber % 2 = 1) THEN l_extendedprice END AS price,
    CASE WHEN NOT (l_orderkey % 7 = 0 AND l_linenumber % 2 = 1) AND l_partkey % 3 <> 0
         THEN l_discount END AS discount,
    CASE WHEN l_partkey % 50 = 0 THEN l_tax END AS tax_sparse,
    CASE WHEN (l_orderkey % 7 = 0 AND l_linenumber % 2 = 1) OR l_partkey % 4 = 0 THEN NULL
         WHEN l_linestatus = 'F' THEN 'detected' ELSE 'not_detected' END AS status_test,
    CASE WHEN (l_orderkey % 7 = 0 AND l_linenumber % 2 = 1) THEN NULL
         WHEN l_returnflag = 'A' THEN 'detected' ELSE 'not_detected' END AS flag_test,
    l_linenumber AS linenumber,
    CASE WHEN NOT (l_orderkey % 7 = 0 AND l_linenumber % 2 = 1) THEN l_tax END AS tax
  FROM lineitem
)"""

CLINICAL_SCHEMA = ("patient_id BIGINT, exam_result STRING, quantity DOUBLE, price DOUBLE, "
                   "discount DOUBLE, tax_sparse DOUBLE, status_test STRING, flag_test STRING, "
                   "linenumber INT, tax DOUBLE")

# --- rule-based predictions for the metrics ---------------------------------


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0)).alias("label"),
        F.when(F.col("l_quantity") > 25, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
        (F.col("l_quantity") - F.lit(25.0) - F.col("l_discount") * F.lit(10.0)).alias("score"),
        (F.col("l_linenumber") - 1).cast("double").alias("class_label"),
        F.floor(F.col("l_quantity") / F.lit(7.5)).cast("double").alias("class_prediction"),
    )


POINTS_SQL = """points AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
    CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
    l_quantity - 25.0::DOUBLE - l_discount * 10.0::DOUBLE AS score,
    CAST(l_linenumber - 1 AS DOUBLE) AS class_label,
    CAST(floor(l_quantity / 7.5::DOUBLE) AS DOUBLE) AS class_prediction
  FROM lineitem
)"""

CLASSES_7 = tuple(float(i) for i in range(7))

# --- three and seven classes by bands of the features -------------------------
# Names of the three classes as written to the text file.
FLAG_NAME = ("Iris-setosa", "Iris-versicolor", "Iris-virginica")
FLAG_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def flag_label() -> Column:
    """Class 0, 1 or 2 by thirds of quantity and tax; one row in fifty has
    none."""
    level = F.col("l_quantity") + F.lit(100.0) * F.col("l_tax")
    return F.when(F.col("l_partkey") % 50 == 7, F.lit(None).cast("double")).otherwise(
        F.when(level < 20.0, F.lit(0.0)).when(level < 38.0, F.lit(1.0)).otherwise(F.lit(2.0)))


FLAG_LABEL_SQL = ("CASE WHEN l_partkey % 50 = 7 THEN NULL "
                  "WHEN l_quantity + 100.0::DOUBLE * l_tax < 20.0 THEN 0.0::DOUBLE "
                  "WHEN l_quantity + 100.0::DOUBLE * l_tax < 38.0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END")


def seven_class() -> Column:
    """Class 1 to 7 by bands of quantity and discount."""
    return (F.least(F.floor((F.col("l_quantity") + F.lit(50.0) * F.col("l_discount")) / F.lit(7.5)),
                    F.lit(6)) + 1).cast("int")


SEVEN_CLASS_SQL = ("least(floor((l_quantity + 50.0::DOUBLE * l_discount) / 7.5::DOUBLE), 6)")


def flags(spark: SparkSession, sf_dir: str, keys: bool = True) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*(LINE_KEYS if keys else ()), flag_label().alias("label"),
                     *[F.col(c) for c in FLAG_FEATURES])


# --- derived files ----------------------------------------------------------


def derived(spark: SparkSession, name: str, sf_dir: str, write: Callable[[str], object],
            source: str = "lineitem") -> str:
    """The folder of a file derived from a table: one per version of the
    table, written once and used again.  ``quarry.session.clear_shared``
    removes them all."""
    version = table_version(spark, f"{sf_dir.rstrip('/')}/{source}.parquet")
    path = shared_dir(spark, "fixtures", f"{name}-{FORMAT_VERSION}-{version}")
    if not complete(spark, path):
        write(path)
    return path


def clinical_csv(spark: SparkSession, sf_dir: str) -> str:
    """The clinical table written as CSV with a header."""
    return derived(spark, "clinical-csv", sf_dir, lambda path: FS.write_csv(clinical(spark, sf_dir), path))


def regression_libsvm(spark: SparkSession, sf_dir: str) -> str:
    """libsvm lines ``label 1:l_quantity`` with label
    ``l_quantity/10 + l_extendedprice/10000``."""
    li = table(spark, sf_dir, "lineitem")
    label = F.col("l_quantity") / F.lit(10.0) + F.col("l_extendedprice") / F.lit(10000.0)
    line = FS.libsvm_line(label, [F.col("l_quantity")])
    return derived(spark, "regression-libsvm", sf_dir, lambda path: FS.write_lines(li, line, path))


# The label of the sweep on vectors: all four features and a part no feature explains.
VECTOR_LABEL_SQL = ("l_quantity / 10.0::DOUBLE + l_extendedprice / 10000.0::DOUBLE "
                    "+ 20.0::DOUBLE * l_discount - 10.0::DOUBLE * l_tax + (l_partkey % 7)::DOUBLE / 7.0::DOUBLE")


def vector_libsvm(spark: SparkSession, sf_dir: str) -> str:
    """libsvm lines of the four line features."""
    li = table(spark, sf_dir, "lineitem")
    label = (F.col("l_quantity") / F.lit(10.0) + F.col("l_extendedprice") / F.lit(10000.0)
             + F.lit(20.0) * F.col("l_discount") - F.lit(10.0) * F.col("l_tax")
             + (F.col("l_partkey") % 7).cast("double") / F.lit(7.0))
    line = FS.libsvm_line(label, [F.col(c) for c in FLAG_FEATURES])
    return derived(spark, "vector-libsvm", sf_dir, lambda path: FS.write_lines(li, line, path))


def numeric_class_lines(spark: SparkSession, sf_dir: str) -> str:
    """Comma-separated numeric lines, the class (1..7) last."""
    li = table(spark, sf_dir, "lineitem")
    line = DL.to_delimited_line([*FLAG_FEATURES, seven_class()])
    return derived(spark, "numeric-class-lines", sf_dir, lambda path: FS.write_lines(li, line, path))


def named_class_lines(spark: SparkSession, sf_dir: str) -> str:
    """Comma-separated lines: four numbers, then a class name."""
    li = table(spark, sf_dir, "lineitem")
    label = flag_label()
    name = F.when(label.isNotNull(), F.element_at(F.array(*map(F.lit, FLAG_NAME)), label.cast("int") + 1))
    line = DL.to_delimited_line([*FLAG_FEATURES, name.otherwise(F.lit("unknown"))])
    return derived(spark, "named-class-lines", sf_dir, lambda path: FS.write_lines(li, line, path))
