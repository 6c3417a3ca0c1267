"""Word frequency: lines, tokens, counts, top-k.

Plan shape at any scale: scan -> generate (explode) -> partial hash
aggregate -> exchange on the word -> final aggregate -> TakeOrderedAndProject.
A very frequent word does not skew the exchange: the partial aggregate
collapses it to one row per input partition before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.strings import java_split_spaces, split_lines


def text_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               line_col: str = "line", spread: int | None = None) -> DataFrame:
    """One row per line of a text column: ``(id, line_no, line)``.

    ``line_no`` is zero-based.  Whole texts are split; nothing is truncated.
    Splitting is CPU-bound: a caller whose input reads as fewer partitions
    than there are cores can spread it over ``spread`` partitions first.
    """
    docs = docs.select(id_col, text_col)
    if spread:
        docs = docs.repartition(spread)
    return docs.select(
        F.col(id_col),
        F.posexplode(split_lines(text_col)).alias("line_no", line_col),
    )


def tokenize(lines: DataFrame, line_col: str = "line", word_col: str = "word",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token of each line (single-space split, JVM rules).

    ``keep`` names columns carried along; ``word_pos`` is the zero-based
    token position in its line.
    """
    return lines.select(
        *[F.col(c) for c in keep],
        F.posexplode(java_split_spaces(line_col)).alias("word_pos", word_col),
    )


def word_count(tokens: DataFrame, word_col: str = "word",
               count_col: str = "cnt") -> DataFrame:
    """``(word, cnt)`` for every distinct token, empty tokens included."""
    return tokens.groupBy(word_col).agg(F.count(F.lit(1)).alias(count_col))


def top_words(counts: DataFrame, k: int = 500, word_col: str = "word",
              count_col: str = "cnt") -> DataFrame:
    """The ``k`` most frequent words, ties broken by the word itself.

    ``orderBy`` + ``limit`` plans as TakeOrderedAndProject: each partition
    keeps its own top ``k`` and only those reach the final merge.
    """
    return counts.orderBy(F.desc(count_col), F.asc(word_col)).limit(k)


def word_frequency(docs: DataFrame, k: int = 500, text_col: str = "text",
                   id_col: str = "doc_id") -> DataFrame:
    """Documents -> lines -> tokens -> counts -> top ``k``."""
    lines = text_lines(docs, text_col=text_col, id_col=id_col)
    return top_words(word_count(tokenize(lines)), k=k)
