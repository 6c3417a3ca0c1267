"""Text sources: one row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_text_lines(spark: SparkSession, path: str, line_col: str = "line") -> DataFrame:
    """A text file (or folder of files) as one row per line.

    Splittable files are read in parallel blocks; a final newline produces
    no empty row.
    """
    return spark.read.text(path).withColumnRenamed("value", line_col)
