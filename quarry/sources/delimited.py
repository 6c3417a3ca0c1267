"""Delimited text lines -> labelled numeric rows.

Parsing is column expressions over ``spark.read.text`` rows: split, cast,
slice -- no per-row Python.  Lines are kept as named double columns until
the last step; ``to_labeled_points`` builds the vector.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.strings import parse_double

# The three-class text labels the reference maps to numbers.
IRIS_CLASSES = {"Iris-setosa": 0.0, "Iris-versicolor": 1.0, "Iris-virginica": 2.0}


def fields(line_col: str = "line", sep: str = ",") -> Column:
    """Array of the fields of a line.  The separator is literal text and, as
    in the JVM's ``split``, trailing empty fields do not count."""
    parts = F.split(F.col(line_col), r"\Q" + sep + r"\E", -1)
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(F.lit(0))))
    return F.slice(parts, 1, last)


def _checked(values: Column, expected: int, strict: bool) -> Column:
    """The array if it has ``expected`` fields; else an error, or null."""
    bad = (F.raise_error(F.concat(F.lit(f"expected {expected} fields: "), F.array_join(values, ",")))
           if strict else F.lit(None)).cast("array<string>")
    return F.when(values.isNotNull(), F.when(F.size(values) == expected, values).otherwise(bad))


def parse_last_label(lines: DataFrame, n_features: int, line_col: str = "line",
                     sep: str = ",", label_shift: float = 1.0, strict: bool = True,
                     prefix: str = "f") -> DataFrame:
    """All fields numeric, the last is the class (1..k, shifted to 0..k-1):
    ``(label, f0 .. f{n-1})``.  Another number of fields or bad text fails
    when ``strict``, else gives nulls."""
    parsed = lines.select(fields(line_col, sep).alias("__f")).select(
        _checked(F.col("__f"), n_features + 1, strict).alias("__a"))
    return parsed.select(
        (parse_double(F.col("__a")[n_features], strict) - F.lit(float(label_shift))).alias("label"),
        *[parse_double(F.col("__a")[i], strict).alias(f"{prefix}{i}") for i in range(n_features)])


def parse_text_label(lines: DataFrame, n_features: int,
                     classes: Mapping[str, float] = IRIS_CLASSES, line_col: str = "line",
                     sep: str = ",", prefix: str = "f") -> DataFrame:
    """Numeric fields, then a class name mapped by ``classes``; an unknown
    name (or a fragment line) gets a null label -- drop it with
    ``drop_unlabeled``."""
    parsed = lines.select(fields(line_col, sep).alias("__f")).select(
        _checked(F.col("__f"), n_features + 1, False).alias("__p"))
    label = None
    for name, value in classes.items():
        cond = F.col("__p")[n_features] == F.lit(name)
        label = F.when(cond, F.lit(float(value))) if label is None else label.when(
            cond, F.lit(float(value)))
    return parsed.select(
        label.alias("label"),
        *[parse_double(F.col("__p")[i], strict=False).alias(f"{prefix}{i}") for i in range(n_features)])


def fields_vector(lines: DataFrame, line_col: str = "line", sep: str = ",") -> DataFrame:
    """Generic form: ``(label, features)`` with the last field as label and
    the others as a dense vector (any field count); bad text fails."""
    numbers = F.transform(F.col("__f"), lambda x: parse_double(x))
    return lines.select(fields(line_col, sep).alias("__f")).select(numbers.alias("__a")).select(
        F.element_at("__a", -1).alias("label"),
        array_to_vector(F.slice("__a", 1, F.size("__a") - 1)).alias("features"))


def to_delimited_line(cols: Sequence, sep: str = ",") -> Column:
    """Render columns (names or expressions) as one delimited text line."""
    return F.concat_ws(sep, *[(F.col(c) if isinstance(c, str) else c).cast("string")
                              for c in cols])
