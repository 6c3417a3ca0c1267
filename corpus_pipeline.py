"""Corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of ``documents`` (the last one adds ``copy``); it is written as Parquet
and read again as the next stage's input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import line_windows, simhash_gray, systematic_mix, template_decontam, toxic_segments
from quarry.session import shared_dir
from quarry.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxic_segments.fit(docs, table(spark, sf_dir, "labels"))
    return toxic_segments.reject_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of three-line windows seen earlier."""
    return line_windows.dedup_lines(docs).drop("_lines", "_removed")


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash_gray.keep_one_per_group(docs, shingle=simhash_gray.SHINGLE, k=simhash_gray.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return template_decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them."""
    return systematic_mix.mix_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the
    shared folder that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    base = shared_dir(spark, "pipeline", uuid.uuid4().hex)
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
