"""Tokenizer and word-frequency semantics on hand-made lines."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.strings import java_split_spaces, split_lines
from quarry.operators import text as T
from tests.conftest import plan_text

# (line, tokens by the JVM String.split(" ") rule)
CASES = [
    ("", [""]),
    (" ", []),
    ("   ", []),
    (" a", ["", "a"]),
    ("a  b ", ["a", "", "b"]),
    ("a\tb", ["a\tb"]),
    ("a b", ["a", "b"]),
    ("  a  ", ["", "", "a"]),
    ("a \u2028", ["a", "\u2028"]),
    ("a \u0085", ["a", "\u0085"]),
    ("a  \u2029 ", ["a", "", "\u2029"]),
]


@pytest.mark.parametrize("line,expected", CASES)
def test_java_split(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    got = df.select(java_split_spaces("line").alias("t")).first()["t"]
    assert got == expected


def test_split_lines_keeps_trailing_empty_line(spark):
    df = spark.createDataFrame([("a\r\nb\rc\nd\n",)], "text string")
    assert df.select(split_lines("text").alias("l")).first()["l"] == ["a", "b", "c", "d", ""]


def test_word_count_counts_empty_tokens_and_top_k_ties(spark):
    docs = spark.createDataFrame([(1, "b a\na  b"), (2, "c b")], "doc_id long, text string")
    toks = T.tokenize(T.text_lines(docs))
    counts = {r["word"]: r["cnt"] for r in T.word_count(toks).collect()}
    assert counts == {"a": 2, "b": 3, "": 1, "c": 1}
    top = [tuple(r) for r in T.word_frequency(docs, k=3).collect()]
    assert top == [("b", 3), ("a", 2), ("", 1)]


def test_top_words_partition_invariant(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ref = [tuple(r) for r in T.word_frequency(docs.coalesce(1), k=50).collect()]
    for n in (3, 8):
        got = [tuple(r) for r in T.word_frequency(docs.repartition(n), k=50).collect()]
        assert got == ref


def test_top_words_plan_is_take_ordered(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = plan_text(T.word_frequency(docs))
    assert "TakeOrderedAndProject" in plan
    # only the text column is read
    assert "ReadSchema: struct<text:string>" in plan


def test_whole_texts_are_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rejoined = docs.select(
        F.array_join(split_lines("text"), "\n").alias("a"),
        F.regexp_replace("text", "\r\n|\r", "\n").alias("b"))
    assert rejoined.filter(F.col("a") != F.col("b")).count() == 0
    n_lines = T.text_lines(docs).count()
    n_breaks = docs.agg(F.sum(F.size(split_lines("text")))).first()[0]
    assert n_lines == n_breaks
