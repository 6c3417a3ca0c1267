"""CSV, libsvm and matrix-table sources, and writers for derived files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """CSV with a header.  Pass ``schema`` at scale: inference costs an
    extra full pass over the files."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """``(label double, features vector)``; indices in the file are
    one-based, in the vector zero-based.  Give ``num_features`` at scale:
    otherwise the source scans once to find it."""
    reader = spark.read.format("libsvm")
    if num_features is not None:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def libsvm_line(label, values: Sequence) -> F.Column:
    """``label 1:v1 2:v2 ...`` (zero values omitted, as the format allows)."""
    items = [F.when(v != 0.0, F.concat(F.lit(f"{i + 1}:"), v.cast("string")))
             for i, v in enumerate(values)]
    return F.concat_ws(" ", label.cast("string"), *items)


def write_lines(df: DataFrame, line, path: str) -> str:
    """Write one text line per row (a folder of part files)."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def matrix_vectors(df: DataFrame, array_col: str, out: str = "features",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Matrix table (one ``array<float|double>`` row per matrix row) ->
    dense vectors."""
    return df.select(*keep, array_to_vector(F.col(array_col).cast("array<double>")).alias(out))


def vector_columns(df: DataFrame, vec_col: str, n: int, prefix: str = "x",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Vector -> ``n`` named double columns."""
    arr = vector_to_array(F.col(vec_col))
    return df.select(*keep, *[arr[i].alias(f"{prefix}{i}") for i in range(n)])
