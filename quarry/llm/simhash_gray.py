"""SimHash near-duplicate groups with a Gray-order hierarchical index.

Fingerprints: one XXH64 per word shingle, a bit is set where over half of the
hashes have it.  Two documents are linked when their fingerprints differ in at
most ``k`` bits; a group is a connected component of links.

Search.  Distinct fingerprints are cut into ``k + 1`` bit segments; linked
fingerprints agree on at least one of them, so each (segment, value) group is
searched on its own.  Inside a group the fingerprints are sorted by Gray rank,
runs of ``FANOUT`` become leaf nodes that keep the bits all members share
(mask and pattern), runs of nodes become upper nodes the same way, and a node
keeps only the shared bits its parent does not have.  A search goes down with
the differences accumulated so far and drops a whole node once they exceed
``k``; at the leaves the rest of the bits complete the exact distance.  A
group gives the links of a spanning forest, never all its pairs.

Scale.  Copies collapse first (one row per fingerprint, partial ``min`` of
the ids).  A group larger than the block size (at least 1024, the square root
of the number of fingerprints beyond) is cut into hash blocks and searched by
pairs of blocks, so no task holds a whole hot group.  Components come from
alternating large-star and small-star joins over the links, checkpointed each
round.  Nothing but counts reaches the driver.

Edge cases.  Null and blank texts have fingerprint zero and are linked like
any other.  Null ids take part; a component's id is its smallest non-null id
(null if there is none).  Repeated rows each get a row.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_texts, rows_in_key_runs, saved

SHINGLE = 4
MAX_BITS = 4
#: Members of a leaf and children of an upper node.
FANOUT = 16
#: Least number of fingerprints in a block of a large group.
BLOCK = 1024
#: Fingerprint-by-member comparisons done at once, even if nothing is pruned.
BATCH = 1 << 20


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text (see the module's rules)."""
    words = (text or b"").lower().split()  # bytes: A-Z only; blanks 20, 09-0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    lasts = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    firsts = starts[:n].tolist()
    for at in range(0, n, 1 << 16):
        part = [digest(joined[a:b], 42) for a, b in
                zip(firsts[at:at + (1 << 16)], lasts[at:at + (1 << 16)], strict=True)]
        bits = np.unpackbits(np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long."""
    def run(texts: list) -> dict:
        fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return {"fp": fps.view(np.int64)}

    return map_texts(docs, text_col, {"doc_id": F.col(id_col), "text_hash": F.xxhash64(text_col)},
                     run, "fp long")


# --- the index --------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """Levels from the top down; ``masks`` holds the bits a node adds to its
    ancestors', ``patterns`` their values."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        pattern = fps[self.order]
        shared = np.full(len(pattern), np.uint64(0xFFFFFFFFFFFFFFFF))
        levels = [(pattern, shared)]
        while len(pattern) > FANOUT:
            at = np.arange(0, len(pattern), FANOUT)
            low = np.bitwise_and.reduceat(pattern & shared, at)
            # A bit is shared upward if every child shares it with one value.
            high = np.bitwise_and.reduceat(~pattern & shared, at)
            shared = low | high
            pattern = low
            levels.append((pattern, shared))
        self.levels = []
        above = None
        for pattern, shared in reversed(levels):
            extra = shared if above is None else shared & ~np.repeat(above, FANOUT)[:len(shared)]
            self.levels.append((pattern & extra, extra))
            above = shared

    def search(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query positions, member positions) within ``k`` bits, in batches."""
        width = len(self.levels[0][0])
        step = max(1, BATCH // len(self.order))
        for lo in range(0, len(queries), step):
            q = np.repeat(np.arange(lo, min(lo + step, len(queries))), width)
            node = np.tile(np.arange(width), len(q) // width)
            spent = np.zeros(len(q), dtype=np.uint8)
            for depth, (pattern, extra) in enumerate(self.levels):
                if depth:
                    q = np.repeat(q, FANOUT)
                    spent = np.repeat(spent, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    real = node < len(pattern)
                    q, spent, node = q[real], spent[real], node[real]
                spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & extra[node])
                near = spent <= k
                q, spent, node = q[near], spent[near], node[near]
            yield q, self.order[node]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest position of its component) after linking
    ``a`` and ``b`` pairwise."""
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def forest(left: np.ndarray, right: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over ``left`` and ``right`` together, from
    all links between the two (within ``left`` if ``right`` is empty)."""
    both = np.concatenate([left, right]).view(np.int64)
    order = np.argsort(both, kind="stable")  # so that roots are smallest fingerprints
    place = np.empty_like(order)
    place[order] = np.arange(len(both))
    label = np.arange(len(both))
    index = GrayIndex(right if len(right) else left)
    shift = len(left) if len(right) else 0
    for q, m in index.search(left, k):
        label = merge(label, place[q], place[m + shift])
    child = np.flatnonzero(label != np.arange(len(both)))
    return both[order[child]], both[order[label[child]]]


# --- links and components ---------------------------------------------------

def segments(k: int) -> list[tuple[int, int]]:
    """(shift, width) of the ``k + 1`` nearly equal bit segments."""
    base, extra = divmod(64, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        width = base + (1 if i < extra else 0)
        out.append((at, width))
        at += width
    return out


def links(distinct: DataFrame, n: int, k: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect what the fingerprints ``fp`` within ``k``
    bits of each other connect.  ``n`` is their number."""
    block = max(BLOCK, int(n ** 0.5))
    keys = F.array(*[
        F.struct(F.lit(i).alias("seg"),
                 F.shiftrightunsigned("fp", at).bitwiseAND((1 << width) - 1).alias("val"))
        for i, (at, width) in enumerate(segments(k))])
    routed = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.seg", "k.val")
    blocks = saved(routed.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select(F.col("seg").alias("_s"), F.col("val").alias("_v"),
                           F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (routed.join(blocks, (F.col("seg") == F.col("_s")) & (F.col("val") == F.col("_v")))
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("seg", "val", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("low"),
                     "fp"))
    group = ["seg", "val", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, i, j), rows in rows_in_key_runs(batches, group):
            fps = rows["fp"].view(np.uint64)
            low = rows["low"].astype(bool)
            if i == j:
                a, b = forest(fps, fps[:0], k)
            elif low.all() or not low.any():
                continue
            else:
                a, b = forest(fps[low], fps[~low], k)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b)], names=["a", "b"])

    return (dealt.repartition(*group).sortWithinPartitions(*group)
            .mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the
    component's smallest node.

    Alternates two steps until nothing changes.  Large star: a node hands its
    larger neighbours to its smallest one.  Small star: it hands its smaller
    neighbours to the smallest.  Both keep the components, and the end state
    is one star per component around its smallest node.
    """
    e = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .where("u <> v").distinct())
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select(F.col("u").alias("c"), F.least("u", "m").alias("m")))
        e = saved(both.join(low, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .where("u <> v").distinct())
        low = saved(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m"))
        stepped = e.join(low, F.col("u") == F.col("c"))
        e = saved(stepped.select("u", F.col("m").alias("v"))
                  .union(stepped.select(F.col("v").alias("u"), F.col("m").alias("v")))
                  .where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, k: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, group (smallest linked
    fingerprint) and component_id (smallest id of the group)."""
    rows = saved(fingerprints(docs, id_col, text_col, shingle))
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(distinct.select("fp"), distinct.count(), k))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("group"))
    # Both saved, so that the join has two plain exchanges and a group of many
    # fingerprints can be split.
    named = saved(named)
    ids = saved(named.groupBy("group").agg(F.min("low").alias("component_id")).select(
        F.col("group").alias("_g"), "component_id"))
    groups = saved(named.join(ids, F.col("group") == F.col("_g"))
                   .select(F.col("fp").alias("_fp"), "group", "component_id"))
    return rows.join(groups, F.col("fp") == F.col("_fp")).drop("_fp")


def fingerprint_hex(fp_col: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp_col)), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, k: int = MAX_BITS) -> DataFrame:
    """The documents, one of each group: the one with the smallest id (null
    ids last; among equal ids the smallest text hash).  Columns unchanged."""
    groups = simhash_groups(docs, id_col, text_col, shingle, k)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash"))
    keep = (groups.groupBy("group").agg(first.alias("f"))
            .select(F.col("f.doc_id").alias("_d"), F.col("f.text_hash").alias("_h")))
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                         F.xxhash64(text_col).alias("_hash"))
    kept = (packed.join(keep, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")))
            .dropDuplicates(["_id", "_hash"]))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
