"""Parquet tables of a test-data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` as a DataFrame (lazy; the scan prunes
    columns and takes pushed filters)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
