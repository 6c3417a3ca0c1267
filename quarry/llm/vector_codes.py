"""Vector codes from a lexicographic trie over distinct parts.

Components become integers, ``floor(SCALE * x)``; a vector is cut into
``PARTS`` consecutive parts, and each part position has a codebook of up to
``ENTRIES`` entries that ``ROUNDS`` rounds of Lloyd's step fit.  The distances
of a part to all entries are sums over its components, so parts that begin
alike share the beginning of those sums: the distinct parts, in lexicographic
order, are a trie, which is walked depth first with one vector of distances to
all entries accumulated along the path.  A leaf takes the smallest distance and
adds its part, times the number of its copies, to that entry's sum.  Subtrees of
at most ``LEAVES`` leaves are finished level by level as matrices, with one
row for each distinct prefix.

All numbers are integers, so sums are exact and independent of partitioning.

Scale.  The distinct parts are found once, by a partial aggregate (a part in a
third of all vectors is one row per task), and saved in order; every round reads
them in place, without a shuffle, and returns one sum per entry and task.
Codebooks (at most ``ENTRIES`` times the vector's length integers per length)
are all that is broadcast or reaches the driver.  Codes of the vectors need no
join: their tasks walk the trie of their own parts.

Edge cases.  Vectors that are null or hold null or non-finite components are
dropped, also where 1024 times a component is no finite double.  Vectors of
another length have codebooks of their own.  Where the length is no multiple of
``PARTS``, the first parts take one component more; parts without components
have distance 0.  Repeated ids are a row each; for the first codebook, ties go
to the lexicographically smaller vector and null ids come last.  With fewer
than ``ENTRIES`` vectors each starts an entry.  An empty table gives an empty
result.  Components of more than ``LARGEST`` in size, whose squared distances
would leave 64 bits, are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import saved

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Leaves of a subtree that is finished as one matrix.
LEAVES = 1024
#: Largest integer component: 2**11 squares of twice that stay below 2**63.
LARGEST = 1 << 25


class Codebooks(NamedTuple):
    """Per vector length, one integer matrix (entries x components) per part."""

    by_dim: dict[int, list[np.ndarray]]

    def sha256(self, dim: int) -> str:
        """Of the decimal components by part, entry and place, comma-joined."""
        text = ",".join(str(int(x)) for book in self.by_dim[dim] for x in book.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def cuts(dim: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """(begin, end) of each part; the first ``dim % parts`` are one longer."""
    base, more = divmod(dim, parts)
    ends = np.cumsum([base + (i < more) for i in range(parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def integer_vectors(vectors: DataFrame, vector_col: str, keep: dict[str, Column]) -> DataFrame:
    """The kept columns and ``_v``, the integer components, of the valid rows."""
    x = vectors.select(*[c.alias(n) for n, c in keep.items()],
                       F.transform(F.col(vector_col).cast("array<double>"), lambda c: c * F.lit(float(SCALE)))
                       .alias("_x"))
    bad = F.exists("_x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    floored = F.transform("_x", lambda c: F.floor(c))
    large = F.exists("_x", lambda c: F.abs(c) > F.lit(float(LARGEST)))
    checked = F.when(large, F.raise_error(F.lit(f"a component exceeds {LARGEST / SCALE}"))
                     .cast("array<bigint>")).otherwise(floored)
    return x.where(F.col("_x").isNotNull() & ~bad).select(*keep, checked.cast("array<int>").alias("_v"))


def distinct_parts(rows: DataFrame, parts: int = PARTS) -> DataFrame:
    """(dim, pos, part, copies), sorted within partitions."""
    dim = F.size("_v")
    base, more = F.floor(dim / parts).cast("int"), dim % parts
    cut = F.array(*[F.struct(F.lit(i).alias("pos"),
                             F.slice("_v", base * i + F.least(F.lit(i), more) + 1,
                                     base + (F.lit(i) < more).cast("int")).alias("part"))
                    for i in range(parts)])
    return (rows.select(dim.alias("dim"), F.inline(cut)).groupBy("dim", "pos", "part")
            .agg(F.count(F.lit(1)).alias("copies")).sortWithinPartitions("dim", "pos", "part"))


def first_books(rows: DataFrame, id_col: str, parts: int, entries: int) -> Codebooks:
    """Parts of the ``entries`` smallest ids' vectors (per length).  A task
    hands on its own first ones only (window group limit)."""
    order = W.partitionBy("dim").orderBy(F.col("id").asc_nulls_last(), "_v")
    first = (rows.select(F.col(id_col).alias("id"), "_v", F.size("_v").alias("dim"))
             .withColumn("r", F.row_number().over(order)).where(F.col("r") <= entries)
             .select("dim", "r", "_v").collect())
    by_dim: dict[int, list] = {}
    for dim, _, v in sorted(first, key=lambda t: (t[0], t[1])):
        by_dim.setdefault(dim, []).append(v)
    return Codebooks({dim: [np.array(vs, dtype=np.int64).reshape(len(vs), dim)[:, a:b] for a, b in cuts(dim, parts)]
                      for dim, vs in by_dim.items()})


def nearest_entries(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every point; ``points`` are in
    lexicographic order.  Depth-first walk of their trie."""
    n, width = points.shape
    entry, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not width:
        return entry, best
    bound = 2 * max(int(np.abs(points).max()), int(np.abs(book).max()), 1)
    # The narrowest type that holds every sum.
    kind = np.int32 if width * bound * bound < 2**31 else np.int64
    points, book = points.astype(kind), book.astype(kind)
    # new[i, j]: the prefix of length j + 1 of point i differs from that of i - 1.
    new = np.ones((n, width), dtype=bool)
    new[1:] = np.logical_or.accumulate(points[1:] != points[:-1], axis=1)

    def finish(lo: int, hi: int, depth: int, sums: np.ndarray, owner: np.ndarray) -> None:
        """The leaves of neighbouring subtrees, whose roots' sums are the rows
        of ``sums``; ``owner`` is the row of each leaf."""
        for j in range(depth, width):
            starts = np.flatnonzero(new[lo:hi, j])
            if len(starts) != len(sums):
                sums = sums[owner[starts]]
            step = points[lo + starts, j][:, None] - book[:, j]
            np.multiply(step, step, out=step)
            sums = sums + step
            owner = np.cumsum(new[lo:hi, j]) - 1
        at = sums.argmin(axis=1)
        least = sums[np.arange(len(sums)), at]
        entry[lo:hi], best[lo:hi] = at[owner], least[owner]

    # Depth first: (range of leaves, depth, accumulated distances of its path).
    stack = [(0, n, 0, np.zeros(len(book), kind))]
    while stack:
        lo, hi, depth, sums = stack.pop()
        if hi - lo <= LEAVES or depth == width:
            finish(lo, hi, depth, sums[None], np.zeros(hi - lo, np.int64))
            continue
        starts = lo + np.flatnonzero(np.r_[True, new[lo + 1:hi, depth]])
        ends = np.r_[starts[1:], hi]
        step = points[starts, depth][:, None] - book[:, depth]
        below = sums + step * step
        # Small neighbouring children are finished together, large ones walked.
        i = 0
        while i < len(starts):
            if ends[i] - starts[i] > LEAVES:
                stack.append((int(starts[i]), int(ends[i]), depth + 1, below[i]))
                i += 1
                continue
            j = i
            while j < len(starts) and ends[j] - starts[i] <= LEAVES:
                j += 1
            owner = np.repeat(np.arange(j - i), ends[i:j] - starts[i:j])
            finish(int(starts[i]), int(ends[j - 1]), depth + 1, below[i:j], owner)
            i = j
    return entry, best


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def entry_sums(parts: DataFrame, books: Codebooks) -> list:
    """(dim, pos, entry, place, total, copies): each entry's parts summed."""
    shared = parts.sparkSession.sparkContext.broadcast(books.by_dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            dims, poss, copies = (b.column(i).to_numpy() for i in (0, 1, 3))
            key = dims.astype(np.int64) * 2**16 + poss
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else []
            for lo, hi in zip(starts, [*starts[1:], len(key)], strict=True):
                dim, pos = int(dims[lo]), int(poss[lo])
                book = shared.value[dim][pos]
                if not book.shape[1]:
                    continue
                points = _matrix(b.column(2).slice(lo, hi - lo), book.shape[1])
                at, _ = nearest_entries(points, book)
                if (dim, pos) not in totals:
                    totals[dim, pos] = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
                total, count = totals[dim, pos]
                np.add.at(total, at, points.astype(np.int64) * copies[lo:hi, None])
                np.add.at(count, at, copies[lo:hi])
        for (dim, pos), (total, count) in totals.items():
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), dim, np.int32)), pa.array(np.full(len(used), pos, np.int32)),
                 pa.array(used.astype(np.int32)), pa.array(list(total[used]), pa.list_(pa.int64())),
                 pa.array(count[used])], names=["dim", "pos", "entry", "total", "copies"])

    sums = parts.mapInArrow(run, "dim int, pos int, entry int, total array<long>, copies long")
    return (sums.select("dim", "pos", "entry", "copies", F.posexplode("total").alias("place", "x"))
            .groupBy("dim", "pos", "entry", "place")
            .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("total"), F.sum("copies").alias("copies")).collect())


def fit(rows: DataFrame, id_col: str = "_id", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of integer vectors ``_v``."""
    books = first_books(rows, id_col, parts, entries)
    if not books.by_dim:
        return books
    distinct = saved(distinct_parts(rows, parts))
    for _ in range(rounds):
        moved = {dim: [b.copy() for b in bs] for dim, bs in books.by_dim.items()}
        for r in entry_sums(distinct, books):
            moved[r["dim"]][r["pos"]][r["entry"], r["place"]] = int(r["total"]) // r["copies"]
        books = Codebooks(moved)
    return books


def encode(rows: DataFrame, books: Codebooks, keep: list[str], parts: int = PARTS) -> DataFrame:
    """Kept columns, code (two hex digits per part), error and
    codebooks_sha256 of integer vectors ``_v``."""
    shared = rows.sparkSession.sparkContext.broadcast(books.by_dim)
    digests = {dim: books.sha256(dim) for dim in books.by_dim}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                mine = b.take(pa.array(np.flatnonzero(dims == dim)))
                v = _matrix(mine.column(2), dim)
                error, codes = np.zeros(len(v), np.int64), np.zeros((len(v), parts), np.int64)
                for pos, ((a, z), book) in enumerate(zip(cuts(dim, parts), shared.value[dim], strict=True)):
                    points, back = np.unique(v[:, a:z], axis=0, return_inverse=True)
                    at, far = nearest_entries(points, book)
                    back = back.reshape(-1)
                    codes[:, pos] = at[back]
                    error += far[back]
                code = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [mine.column(0), pa.array(code), pa.array(error), pa.array([digests[dim]] * len(code))],
                    names=["kept", "code", "error", "codebooks_sha256"])

    kept = rows.select(F.struct(*keep).alias("kept"), F.size("_v").alias("dim"), "_v")
    kind = kept.schema["kept"].dataType.simpleString()
    return (kept.mapInArrow(run, f"kept {kind}, code string, error long, codebooks_sha256 string")
            .select("kept.*", "code", "error", "codebooks_sha256"))


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS) -> DataFrame:
    """One row per valid vector: id, label, code, error, label_error (errors of
    equal labels added up, nulls together) and codebooks_sha256."""
    rows = integer_vectors(vectors, vector_col, {"_id": F.col(id_col), "_label": F.col(label_col)})
    coded = saved(encode(rows, fit(rows, "_id", parts, entries, rounds), ["_id", "_label"], parts))
    # Saved, so that both join sides are plain exchanges and a hot label can be split.
    sums = saved(coded.groupBy("_label").agg(F.sum("error").alias("label_error"))
                 .withColumnRenamed("_label", "_l"))
    return (coded.join(sums, F.col("_label").eqNullSafe(F.col("_l")))
            .select(F.col("_id").alias(id_col), F.col("_label").alias(label_col), "code", "error",
                    "label_error", "codebooks_sha256"))
