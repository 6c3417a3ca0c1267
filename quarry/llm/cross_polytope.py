"""Nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-random rotations (three rounds of random
signs and a fast Hadamard transform) and hashed to the nearest signed axis.  A
hash table combines as many rotations as its bucket count needs; the last one
may use fewer axes.  A query probes, in each of ``TABLES`` tables, the buckets
whose axes it is nearest to next (multiprobe), and all vectors found there are
ranked by the exact inner product, in double precision, on the original
vectors.

Vectors of unequal length are split into bands, counted down from the largest
length by factors of ``BAND``.  Each band is hashed by direction with buckets
and probes for its own size, and a query probes every band: inside one the
inner product follows the angle but for the factor.  Neighbouring bands of
together at most ``ALL`` classes share one bucket, which is ranked whole.

A query that found fewer than ``k + 1`` classes (its own included) although
there are more asks again with ``WIDEN`` times the probes, and in the end, once
that were more than ``LISTED`` buckets of a table, every group of one table.

Scale.  Equal vectors are one class, of which the ``k + 1`` smallest ids are
kept (ties go to smaller ids, so no other can rank): a hot vector is indexed
and ranked once.  Buckets per table grow with the number of classes (about one
per ``PER_BUCKET``), the probed share falls as the number grows.  Buckets are
dealt in groups of about ``GROUP`` vectors, a hot one is cut into hash blocks, and a query goes once to each group it probes.  The best of each group
meet in one ranking per query.  Only the classes per band reach the driver (a
double has at most 15,000 bands).

Edge cases.  Vectors that are null, zero, or hold null or non-finite
components take no part.  Vectors of each length are searched among themselves,
with bands of their own.  Repeated ids count once per distinct vector.  A query
with fewer candidates gets all of them; a band of at most ``ALL`` classes is
ranked whole.  Null ids take no part.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import rows_in_key_runs, saved

TABLES = 8
PER_BUCKET = 4
GROUP = 32_768
#: Vectors hashed at once.
SLICE = 1024
#: Stands for all buckets of a group.
EVERY = -1
#: Up to this many classes are ranked whole.
ALL = 256
#: Share of buckets probed at 500 classes, and how it falls with their number.
SHARE, FALL = 0.16, 0.45
#: Probes of a further round to those of the last, and the most listed buckets.
WIDEN, LISTED = 8, 16_384
#: Largest and smallest length of a band differ by this factor.
BAND = 1.1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the columns (length a power of two)."""
    d, n = x.shape
    h = 1
    while h < d:
        x = x.reshape(d // (2 * h), 2, h, n)
        x = np.concatenate([x[:, :1] + x[:, 1:], x[:, :1] - x[:, 1:]], axis=1).reshape(d, n)
        h *= 2
    return x / np.sqrt(d)


class Hashes:
    """The tables' hash functions for vectors of ``dim`` components."""

    def __init__(self, dim: int, buckets: int, tables: int = TABLES, seed: int = 11):
        self.size = 1 << max(1, (dim - 1).bit_length())
        self.tables = tables
        self.radix = []  # signed axes of each rotation
        left = max(2, buckets)
        while left > 1:
            full = 2 * self.size
            self.radix.append(min(full, max(2, 1 << (left - 1).bit_length())))
            left = -(-left // self.radix[-1])
        rng = np.random.default_rng(seed)
        self.signs = rng.choice([-1.0, 1.0], size=(tables, len(self.radix), 3, self.size))
        self.buckets = int(np.prod([float(r) for r in self.radix]))

    def axes(self, x: np.ndarray, table: int, level: int) -> np.ndarray:
        """Nearness to every signed axis of one rotation."""
        y = np.zeros((self.size, len(x)))
        y[:x.shape[1]] = x.T
        for s in self.signs[table, level]:
            y = hadamard(y * s[:, None])
        y = y[:self.radix[level] // 2].T
        return np.concatenate([y, -y], axis=1)

    def bucket(self, x: np.ndarray, table: int) -> np.ndarray:
        code = np.zeros(len(x), dtype=np.int64)
        for level, r in enumerate(self.radix):
            code = code * r + self.axes(x, table, level).argmax(axis=1)
        return code

    def probes(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """The ``count`` best buckets of each row: nearest axes, added up over
        the rotations; keeping the best prefixes at each level is exact."""
        codes = np.zeros((len(x), 1), dtype=np.int64)
        loss = np.zeros((len(x), 1))
        for level, r in enumerate(self.radix):
            a = self.axes(x, table, level)
            a = a.max(axis=1, keepdims=True) - a
            loss = (loss[:, :, None] + a[:, None, :]).reshape(len(x), -1)
            codes = (codes[:, :, None] * r + np.arange(r)).reshape(len(x), -1)
            if loss.shape[1] > count:
                best = np.argpartition(loss, count - 1, axis=1)[:, :count]
                loss = np.take_along_axis(loss, best, axis=1)
                codes = np.take_along_axis(codes, best, axis=1)
        return codes


def plan(n: int, dim: int) -> tuple[Hashes, int, int]:
    """Hash functions, probes per table and buckets per group for n classes."""
    h = Hashes(dim, max(16, n // PER_BUCKET))
    share = 1.0 if n <= ALL else min(1.0, SHARE * (500 / n) ** FALL)
    return h, max(1, int(np.ceil(share * h.buckets))), max(1, int(h.buckets * GROUP / max(GROUP, n)))


class Space(NamedTuple):
    """Bands that are searched together: hash functions (None: one bucket,
    ranked whole), probes per table, buckets per group and fine bands."""

    hashes: Hashes | None
    probes: int
    per_group: int
    bands: list[int]
    dim: int


def spaces(counts: dict[int, int], dim: int) -> list[Space]:
    """Spaces for these classes per band, of vectors of one length."""
    out: list[Space] = []
    small: list[int] = []
    for band, n in sorted(counts.items()):
        if n > ALL:
            out.append(Space(*plan(n, dim), [band], dim))
        elif small and sum(counts[x] for x in small) + n <= ALL:
            small.append(band)
        else:
            small = [band]
            out.append(Space(None, 1, 1, small, dim))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (by their largest component first, whose square may leave a double)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def probed(hashes: Hashes, x: np.ndarray, t: int, count: int, per_group: int
           ) -> tuple[int, pa.Array, list[int], list[np.ndarray]]:
    """Table, rows, groups and the buckets probed there."""
    rows, groups, lists = [], [], []
    for i, own in enumerate(np.sort(hashes.probes(x, t, count), axis=1)):
        cut = np.flatnonzero(np.diff(own // per_group)) + 1
        for part in np.split(own, cut):
            rows.append(i)
            groups.append(int(part[0] // per_group))
            lists.append(part)
    return t, pa.array(rows), groups, lists


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def classes(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(v, cid, ids): distinct valid vectors (double), the smallest id, and the
    ``k + 1`` smallest ids in order."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = (vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
             .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
             .where(~bad & F.exists("v", lambda x: x != 0.0))
             .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))))  # -0.0 is 0.0
    # Only the first k + 1 of a vector leave a task (window group limit).
    few = (valid.distinct().withColumn("r", F.row_number().over(W.partitionBy("v").orderBy("id")))
           .where(F.col("r") <= k + 1))
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        "v", F.element_at("ids", 1).alias("cid"), "ids")


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (a
    function of the id column) holds, against all other rows."""
    # Logarithm of the length, by the largest component, so that no square leaves a double.
    largest = F.array_max(F.transform("v", F.abs))
    log_length = F.log(largest) + F.log(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))) / 2
    every = saved(classes(vectors, id_col, vector_col, k).withColumn("length", log_length))
    # Vectors of each number of components are searched among themselves.
    tops = {r["d"]: r["m"] for r in every.groupBy(F.size("v").alias("d")).agg(F.max("length").alias("m")).collect()}
    spark = vectors.sparkSession
    if not tops:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    top = F.create_map(*[F.lit(x) for pair in sorted(tops.items()) for x in pair])[F.size("v")]
    band = F.floor((top - F.col("length")) / F.lit(float(np.log(BAND))))
    every = every.withColumn("dim", F.size("v")).withColumn("band", band.cast("int"))
    counts: dict[int, dict[int, int]] = {}
    for r in every.groupBy("dim", "band").count().collect():
        counts.setdefault(r["dim"], {})[r["band"]] = r["count"]
    searched = [space for dim, own in sorted(counts.items()) for space in spaces(own, dim)]
    space_of = {(space.dim, x): i for i, space in enumerate(searched) for x in space.bands}
    v = F.col(vector_col).cast("array<double>")
    # Which class each query row belongs to (by its vector).
    asked = (vectors.select(F.col(id_col).cast("long").alias("query_id"), v.alias("_v"))
             .where(F.col("query_id").isNotNull() & is_query(F.col("query_id"))).distinct()
             .withColumn("_v", F.transform("_v", lambda x: x + F.lit(0.0))))
    queries = saved(asked.join(every, F.col("_v") == F.col("v")).select("query_id", "cid", "dim"))
    wanted = queries.select(F.col("cid").alias("_c"), "dim").distinct()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                slice_ = whole.slice(lo, SLICE)
                own = np.array([space_of[x] for x in zip(slice_.column(3).to_pylist(), slice_.column(2).to_pylist(),
                                                         strict=True)], dtype=np.int32)
                for i in np.unique(own).tolist():
                    b = slice_.take(pa.array(np.flatnonzero(own == i)))
                    hashes, _, per_group, _, dim = searched[i]
                    x = _unit(_matrix(b.column(1), dim))
                    for t in range(1 if hashes is None else hashes.tables):
                        code = np.zeros(len(x), np.int64) if hashes is None else hashes.bucket(x, t)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(code), i, np.int32)), pa.array(np.full(len(code), t, np.int32)),
                             pa.array(code // per_group), pa.array(code), b.column(0), b.column(1)],
                            names=["s", "t", "g", "code", "cid", "v"])

    def ask(widen: int):
        """Probes of the queries; ``widen`` 0 asks for every group of one table."""
        step = max(1, 64 // max(1, widen))  # the same memory for more probes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                sizes = whole.column(2).to_numpy()
                alike = [whole.take(pa.array(np.flatnonzero(sizes == d))) for d in np.unique(sizes).tolist()]
                for b in (same.slice(lo, step) for same in alike for lo in range(0, same.num_rows, step)):
                    own = b.column(2)[0].as_py()
                    x = _unit(_matrix(b.column(1), own))
                    for s, (hashes, probes, per_group, _, dim) in enumerate(searched):
                        if dim != own:
                            continue
                        count = 0 if hashes is None or not widen else probes * widen
                        if count == 0 or count >= hashes.buckets:  # whole groups of table 0
                            n_groups = 1 if hashes is None else -(-hashes.buckets // per_group)
                            at = pa.array(np.repeat(np.arange(len(x)), n_groups))
                            groups = [(0, at, np.tile(np.arange(n_groups), len(x)), [[EVERY]] * len(at))]
                        else:
                            groups = (probed(hashes, x, t, count, per_group) for t in range(hashes.tables))
                        for t, at, g, lists in groups:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(at), s, np.int32)), pa.array(np.full(len(at), t, np.int32)),
                                 pa.array(g, pa.int64()), pa.array(lists, pa.list_(pa.int64())),
                                 b.column(0).take(at), b.column(1).take(at)],
                                names=["s", "t", "g", "codes", "cid", "v"])
        return run

    index = (every.select("cid", "v", "band", "dim").mapInArrow(
        place, "s int, t int, g long, code long, cid long, v array<double>"))
    index = saved(index.select("s", "t", "g", F.array("code").alias("codes"), "cid", "v", F.lit(False).alias("asks")))
    # Blocks per group; a group far above GROUP vectors (a hot bucket) gets several.
    blocks = saved(index.groupBy("s", "t", "g").agg(F.ceil(F.count(F.lit(1)) / (2 * GROUP)).cast("int").alias("b"))
                   .select(F.col("s").alias("_s"), F.col("t").alias("_t"), F.col("g").alias("_g"), "b"))
    same = (F.col("s") == F.col("_s")) & (F.col("t") == F.col("_t")) & (F.col("g") == F.col("_g"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (space, *_), cols in rows_in_key_runs(batches, ["s", "t", "g", "b"]):
            asking = cols["asks"].astype(bool)
            if not asking.any() or asking.all():
                continue
            cid, x = cols["cid"], _matrix(cols["v"], searched[space].dim)
            owner = np.repeat(np.arange(len(cid)), np.diff(cols["codes"].offsets.to_numpy()))
            code = cols["codes"].flatten().to_numpy()
            held = np.flatnonzero(~asking)
            mine = code[~asking[owner]]
            order = np.argsort(mine, kind="stable")
            held, mine = held[order], mine[order]
            q_owner, q_code = owner[asking[owner]], code[asking[owner]]
            first = np.searchsorted(mine, q_code, "left")
            upto = np.searchsorted(mine, q_code, "right")
            first, upto = np.where(q_code == EVERY, 0, first), np.where(q_code == EVERY, len(mine), upto)
            out_q, out_c, out_s = [], [], []
            for q in np.flatnonzero(asking):
                a, b = np.searchsorted(q_owner, q, "left"), np.searchsorted(q_owner, q, "right")
                some = upto[a:b] > first[a:b]
                spans = [np.arange(i, j) for i, j in zip(first[a:b][some], upto[a:b][some], strict=True)]
                if not spans:
                    continue
                near = held[np.concatenate(spans)]
                score = (x[near] * x[q]).sum(axis=1)
                best = np.lexsort((cid[near], -score))[:k + 1]
                out_q.append(np.full(len(best), cid[q]))
                out_c.append(cid[near][best])
                out_s.append(score[best])
            if out_q:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_c)),
                     pa.array(np.concatenate(out_s))], names=["qcid", "cid", "score"])

    order = W.partitionBy("qcid").orderBy(F.desc("score"), "cid")

    def search(who: DataFrame, widen: int) -> DataFrame:
        """(qcid, cid, score): the best k + 1 classes the probes of ``who`` (_c) find."""
        asks = (every.join(who, F.col("cid") == F.col("_c"), "left_semi").select("cid", "v", "dim")
                .mapInArrow(ask(widen), "s int, t int, g long, codes array<long>, cid long, v array<double>")
                .withColumn("asks", F.lit(True)))
        live = blocks
        if widen != 1:  # few ask: only the groups they ask for travel
            asks = saved(asks)
            live = saved(blocks.join(asks.select("s", "t", "g").distinct(), same, "left_semi"))
        dealt = (index.join(live, same).withColumn("b", F.pmod(F.xxhash64("cid"), F.col("b")).cast("int"))
                 .unionByName(asks.join(live, same)
                              .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("b") - 1))))
                 .drop("_s", "_t", "_g"))
        found = (dealt.repartition("s", "t", "g", "b").sortWithinPartitions("s", "t", "g", "b")
                 .mapInArrow(rank, "qcid long, cid long, score double")
                 .groupBy("qcid", "cid").agg(F.max("score").alias("score")))
        return saved(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"))

    top_classes = search(wanted, 1)
    enough = F.create_map(*[F.lit(x) for dim, own in sorted(counts.items())
                            for x in (dim, min(k + 1, sum(own.values())))])[F.col("dim")]
    most = max((s.probes for s in searched if s.hashes is not None), default=0)
    widen = 1
    while widen and most:
        hits = top_classes.groupBy("qcid").count()
        short = saved(wanted.join(hits, F.col("_c") == F.col("qcid"), "left")
                      .where(F.coalesce("count", F.lit(0)) < enough).select("_c", "dim"))
        if short.isEmpty():
            break
        widen = widen * WIDEN if most * widen * WIDEN <= LISTED else 0
        # A wider round finds all that the last one found.
        top_classes = saved(top_classes.join(short, F.col("qcid") == F.col("_c"), "left_anti")
                            .unionByName(search(short, widen)))
    # Classes back to rows: a class gives at most its k + 1 smallest ids.
    members = every.select(F.col("cid").alias("_c"), "ids")
    rows = (top_classes.join(members, F.col("cid") == F.col("_c"))
            .select("qcid", "score", F.explode("ids").alias("vec_id")))
    best = W.partitionBy("qcid").orderBy(F.desc("score"), "vec_id")
    lists = (rows.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
             .groupBy("qcid").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found")))
    lists = saved(lists)
    own = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return (queries.join(lists, F.col("cid") == F.col("qcid"))
            .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("p", "hit"))
            .select("query_id", (F.col("p") + 1).cast("int").alias("rank"),
                    F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")))
