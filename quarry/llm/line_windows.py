"""Line deduplication with overlapping three-line windows.

The lines of a text (split at LF, blank lines aside) form overlapping windows
of three consecutive lines; a text of one or two lines forms one window of all
of them, which only equals windows of the same number of lines.  Lines are
compared without the blanks around them.  Windows are hashed (md5 of the
joined lines) and the earliest place of each window, by (id, line), is found
globally.  Every later place is a repeat: the positions that repeats cover are
merged per document and those lines go.  A removed line always equals a line
of an earlier window, so each line's wording stays somewhere.

Scale.  Only (window hash, id, position) is shuffled for the search: a partial
``min`` per hash finds first places, so a window that stands in a third of all
documents is one row per task, and the join that marks later places is a plain
inner join that adaptive execution may split.  Texts are shuffled once, to
drop the covered lines.

Edge cases.  Null and empty texts have no windows and come back unchanged.
Blank lines go only where they stand between the lines of a removed window.
Among repeated ids the text's hash decides which is earlier;
rows equal in id and text are repeats of one another: they are counted as one
document, and each comes back with the same text.  A null id is later than all
others.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import saved

#: Consecutive lines in a window.
WINDOW = 3


#: ASCII blanks around a line do not count.
BLANKS = "\t\x0b\x0c\r "


def line_windows(text: str, size: int = WINDOW) -> list[tuple[bytes, int, int]]:
    """(md5, first line, last line) of the windows over the non-blank lines;
    positions count all lines from 0."""
    lines = [(t, i) for i, x in enumerate(text.split("\n")) if (t := x.strip(BLANKS))]
    span = min(len(lines), size)
    return [(hashlib.md5("\n".join([str(span), *(t for t, _ in lines[k:k + span])]).encode()).digest(),
             lines[k][1], lines[k + span - 1][1]) for k in range(len(lines) - span + 1) if span]


def window_places(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(doc_id, text_hash, hash, at, upto): every window of every text."""
    narrow = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                rows, found = [], []
                for row, text in enumerate(b.column(2).to_pylist()):
                    new = line_windows(text, size)
                    found += new
                    rows += [row] * len(new)
                of = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(of), b.column(1).take(of),
                     pa.array([x[0] for x in found], pa.binary()),
                     pa.array([x[1] for x in found], pa.int32()),
                     pa.array([x[2] for x in found], pa.int32())],
                    names=["doc_id", "text_hash", "hash", "at", "upto"])

    return narrow.mapInArrow(run, f"doc_id {kind}, text_hash long, hash binary, at int, upto int")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     size: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, spans): per document the spans (at, upto) of its
    windows that occur earlier in the corpus.  Documents without any are
    absent."""
    places = window_places(docs, id_col, text_col, size)
    # Nulls last, then id, text and line: the order of "earlier".
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash", "at")
    first = (places.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("hash").alias("_hash"), "first"))
    first = saved(first)  # its own exchange below, so a hot hash can be split
    later = (places.join(first, F.col("hash") == F.col("_hash"))
             .where(place > F.col("first")))
    return (later.groupBy("doc_id", "text_hash")
            .agg(F.sort_array(F.collect_set(F.struct("at", "upto"))).alias("spans")))


def drop_spans(text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[str, int]:
    """The text without the lines that any span covers, and their number
    (one pass: spans open and close in a difference array)."""
    lines = text.split("\n")
    depth = np.zeros(len(lines) + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends + 1, -1)
    gone = np.cumsum(depth[:-1]) > 0
    return "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), int(gone.sum())


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()),
                            T.StructField("n_removed", T.IntegerType())]))
def _drop(cols: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, starts, ends in cols:
        done = [(None, 0) if t is None else drop_spans(t, np.asarray(a), np.asarray(b))
                for t, a, b in zip(texts, starts, ends, strict=True)]
        yield pd.DataFrame({"text": pd.Series([x[0] for x in done], dtype=object),
                            "n_removed": pd.Series([x[1] for x in done], dtype="int32")})


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = WINDOW) -> DataFrame:
    """The documents with their columns, repeats removed from the text, and
    ``_lines`` and ``_removed`` (lines before, lines that went)."""
    spans = repeated_windows(docs, id_col, text_col, size).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "spans")
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                         F.xxhash64(text_col).alias("_hash"), F.col(text_col).alias("_text"))
    joined = packed.join(spans, F.col("_id").eqNullSafe(F.col("_d"))
                         & (F.col("_hash") == F.col("_h")), "left")
    hit = F.col("spans").isNotNull()
    # Only texts that lose lines travel to Python.
    cleaned = joined.withColumn("_new", _drop(F.when(hit, F.col("_text")),
                                              F.col("spans.at"), F.col("spans.upto")))
    text = F.when(hit, F.col("_new.text")).otherwise(F.col("_text"))
    return cleaned.select(
        *[(text if c.lower() == text_col.lower() else F.col("_row").getField(c)).alias(c)
          for c in docs.columns if c.lower() not in ("_lines", "_removed")],
        F.coalesce(F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("\n"), F.lit(""))) + 1,
                   F.lit(0)).alias("_lines"),
        F.coalesce(F.when(hit, F.col("_new.n_removed")), F.lit(0)).alias("_removed"))
