"""Word-frequency queries over ``documents.text`` and table row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import selection as SE
from quarry.operators import text as T
from quarry.plans.registry import query
from quarry.sources.tables import TABLES, table

# DuckDB twins of the Spark expressions.
LINES_CTE = r"""
lines AS (
  SELECT doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS line_no,
         unnest(arr) AS line
  FROM (SELECT doc_id, string_split_regex(text, '\r\n|\r|\n') AS arr FROM documents)
)"""

TOKENS_CTE = LINES_CTE + r""",
tok AS (
  SELECT doc_id, line_no,
         CASE WHEN line = '' THEN ['']
              WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(line, ' '), ' ') END AS arr
  FROM lines
),
tokens AS (
  SELECT doc_id, line_no, CAST(unnest(range(len(arr))) AS INTEGER) AS word_pos,
         unnest(arr) AS word
  FROM tok
)"""


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return T.tokenize(T.text_lines(docs), keep=("doc_id", "line_no"))


@query("text_lines", "WITH" + LINES_CTE + "\nSELECT doc_id, line_no, line FROM lines")
def q_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.text_lines(table(spark, sf_dir, "documents"))


@query("tokenize", "WITH" + TOKENS_CTE + "\nSELECT doc_id, line_no, word_pos, word FROM tokens")
def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokens(spark, sf_dir)


@query("word_count", "WITH" + TOKENS_CTE
       + "\nSELECT word, count(*) AS cnt FROM tokens GROUP BY word")
def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.word_count(_tokens(spark, sf_dir))


@query("top_words", "WITH" + TOKENS_CTE
       + "\nSELECT word, count(*) AS cnt FROM tokens GROUP BY word"
         " ORDER BY cnt DESC, word LIMIT 500")
def q_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.word_frequency(table(spark, sf_dir, "documents"), k=500)


@query("top_words_certified", "WITH" + TOKENS_CTE
       + "\nSELECT word, count(*) AS cnt FROM tokens GROUP BY word"
         " ORDER BY cnt DESC, word LIMIT 500")
def q_top_words_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 500 most frequent words without a shuffle of the vocabulary: sketch,
    exact recount of its candidates, proof (else the plan of ``top_words``)."""
    docs = table(spark, sf_dir, "documents")
    return SE.certified_top_k(T.tokenize(T.text_lines(docs)), 500)


@query("row_count", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(t).alias("table_name"), "n_rows")
        for t in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query("line_count", "WITH" + LINES_CTE + "\nSELECT count(*) AS n_lines FROM lines")
def q_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's first printed number: lines of the text input."""
    return T.text_lines(table(spark, sf_dir, "documents")).agg(
        F.count(F.lit(1)).alias("n_lines"))
