"""Mixing sources to target weights by systematic sampling (native SQL
functions only).

Every document of a source has the same expected number of copies, its
source's target over its source's size.  The expected copies are prefix-summed
over the source's documents, one offset in [0, 1) is added, and a copy is
emitted for each integer boundary the running sum crosses, so a document gets
the floor or the ceiling of its expectation.  The documents stand in size
classes (about 3 % wide) and by hash of their id within a class: neighbours
have similar sizes, so the words taken stay within about one document of the
target.

Scale.  Neither a hot source nor a hot id is one task.  Documents and sources
are placed in ranges of their order; a prefix sum is a window inside a range plus
the sums of the ranges before it, one row per range and source.  The texts are
read once for the sizes and, by ``mix_documents``, again for the mix; everything
between moves ids, sizes and hashes.

Edge cases.  Null text has size 0.  A source without words has target 0 and
no copies.  A null source is one source, ordered last.  Repeated rows (same
id, source and size) are counted together first and come back as often as
they came.  An empty table gives an empty result.  Further input columns are
ignored and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import BLANK_WORD, saved

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is never taken more often than this.
MAX_REPEAT = 3
#: Size classes per factor e.
CLASSES = 32
#: Repeated rows are expanded in runs of this many.
RUN = 1_000_000


def word_size(text_col: str) -> Column:
    """Number of blank-separated words (null text: 0)."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from rows (source, source_size).

    Sources in code-point order (null last) get the repeating weights.  With
    caps ``max_repeat * source_size`` the repeated resharing of the excess ends
    where ``target = min(cap, level * weight)`` and the targets add up to all
    sizes; ordered by cap over weight, the capped sources are a prefix, so the
    level comes from two running sums.  One row per source.
    """
    by_source = F.col("source").asc_nulls_last()
    place = sums_before(sizes, [by_source], {"_place": F.lit(1)})
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]),
                        (F.col("_place") % len(weights) + 1).cast("int"))
    ranked = (place.withColumn("_w", pick.cast("long"))
              .withColumn("_cap", F.col("source_size") * max_repeat)
              .withColumn("_need", F.col("_cap") / F.col("_w")))
    levels = saved(sums_before(ranked, [F.col("_need").asc(), by_source],
                               {"_caps": F.col("_cap"), "_ws": F.col("_w")}))
    words, weight = levels.agg(F.sum("source_size"), F.sum("_w")).first()
    level = ((F.lit(words).cast("long") - F.col("_caps")) / (F.lit(weight).cast("long") - F.col("_ws")))
    # From the first source on whose cap its level stays below, levels only fall:
    # the highest of them is the level of all uncapped sources.
    top = levels.agg(F.max(F.when(level <= F.col("_need"), level))).first()[0]
    cap = F.col("_cap").cast("double")
    target = F.least(cap, F.coalesce(F.lit(top).cast("double") * F.col("_w"), cap))
    return levels.select("source", "source_size", target.alias("target"))


def placed_in_ranges(df: DataFrame, order: list[Column], rows: int = 0) -> DataFrame:
    """``df`` saved with the number ``_range`` of its range in ``order``; one
    range per shuffle partition, more for more than a million rows each."""
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // RUN + 1)
    return saved(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def sums_before(df: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """``df`` with the sums of ``values`` over the rows before each one in
    ``order`` (a total order): running sums inside a range of the order plus
    the sums of the ranges before it (one row per range)."""
    placed = placed_in_ranges(df, order)
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranges = W.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy(F.col("_range").alias("_r"))
              .agg(*[F.sum(v).alias(f"_of{n}") for n, v in values.items()])
              .select("_r", *[F.coalesce(F.sum(f"_of{n}").over(ranges), F.lit(0)).alias(f"_to{n}")
                              for n in values]))
    within = placed.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in{n}")
                                  for n, v in values.items()])
    return (within.join(starts, F.col("_range") == F.col("_r"))
            .select(*df.columns, *[(F.col(f"_in{n}") + F.col(f"_to{n}")).alias(n) for n in values]))


def offset(source: Column, seed: int) -> Column:
    """The source's offset in [0, 1): 32 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix_ranks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
              max_repeat: int = MAX_REPEAT, seed: int = 7, tie: Column | None = None) -> DataFrame:
    """One row per distinct (id, source, size, ``_tie``): ``_n`` repeated rows
    whose ranks in the source's order start at ``_first`` (from 0), with the
    source's size, target, copies per document and offset."""
    rows = saved(docs.select(F.col(id_col).alias("doc_id"),
                             F.col(source_col).cast("string").alias("source"),
                             word_size(text_col).alias("size"),
                             (F.lit(0) if tie is None else tie).cast("long").alias("_tie"))
                 .groupBy("doc_id", "source", "size", "_tie").agg(F.count(F.lit(1)).alias("_n")))
    by_source = saved(rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("_n")).alias("source_size"), F.count(F.lit(1)).alias("_rows")))
    sources = saved(source_targets(by_source.select("source", "source_size"), weights, max_repeat))
    n_rows = by_source.agg(F.sum("_rows")).first()[0] or 0
    keyed = (rows.withColumn("_class", F.floor(F.log(F.col("size") + 1.0) * CLASSES))
             .withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    within = [F.col(c) for c in ("_class", "_key", "doc_id", "size", "_tie")]
    placed = placed_in_ranges(keyed, [F.col("source").asc_nulls_last(), *within], n_rows)
    inside = W.partitionBy("_range", "source").orderBy(*within).rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    ranges = W.partitionBy("source").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy("source", "_range").agg(F.sum("_n").alias("_m"))
              .select(F.col("source").alias("_s"), F.col("_range").alias("_r"),
                      F.coalesce(F.sum("_m").over(ranges), F.lit(0)).alias("_start")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (ranked
            .join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
            .drop("_s", "_r")
            .join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("_rate", rate).withColumn("_offset", offset(F.col("source"), seed))
            .select("doc_id", "source", "size", "_tie", "_n", "source_size", "target", "_rate", "_offset",
                    (F.col("_start") + F.col("_inside")).alias("_first")))


def crossed(rank: Column, max_repeat: int = MAX_REPEAT) -> Column:
    """Integer boundaries crossed by the document of this rank (from 0)."""
    upto = F.floor((rank + 1) * F.col("_rate") + F.col("_offset"))
    since = F.floor(rank * F.col("_rate") + F.col("_offset"))
    return F.least(upto - since, F.lit(max_repeat)).cast("long")


def each_copy_of(ranks: DataFrame) -> DataFrame:
    """A row for each of the ``_n`` repeated rows, numbered ``_j`` from 0."""
    return (ranks.withColumn("_run", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(RUN))))
            .withColumn("_j", F.explode(F.sequence(
                F.col("_run"), F.least(F.col("_run") + RUN, F.col("_n")) - 1))))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
               max_repeat: int = MAX_REPEAT, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    copies and taken (= copies * size)."""
    ranks = mix_ranks(docs, id_col, text_col, source_col, weights, max_repeat, seed)
    return (each_copy_of(ranks).withColumn("copies", crossed(F.col("_first") + F.col("_j"), max_repeat))
            .select(F.col("doc_id").alias(id_col), "source", "size", "source_size", "target",
                    "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                  max_repeat: int = MAX_REPEAT, seed: int = 7) -> DataFrame:
    """The mix itself: every document as often as it was drawn, with its
    columns and ``copy`` (from 1; it replaces an input column of that name).
    Documents drawn zero times are absent.

    The draws are joined back on id, source, size and a hash of the whole row.
    Rows equal in all of these (usually none) are one row with all their draws,
    put together before the shuffle, so that no group of them is one task.
    """
    others = [F.col(c) for c in docs.columns if c != text_col]
    whole = F.xxhash64(F.col(text_col), F.to_json(F.struct(*others)))
    ranks = saved(mix_ranks(docs, id_col, text_col, source_col, weights, max_repeat, seed, whole)
                  .select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z"),
                          F.col("_tie").alias("_t"), "_n", "_first", "_rate", "_offset"))
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"),
                         F.col(source_col).cast("string").alias("_source"),
                         word_size(text_col).alias("_size"), whole.alias("_hash"))
    same = (F.col("_id").eqNullSafe(F.col("_d")) & F.col("_source").eqNullSafe(F.col("_s"))
            & (F.col("_size") == F.col("_z")) & (F.col("_hash") == F.col("_t")))
    drawn = crossed(F.col("_first"), max_repeat)
    single = (packed.join(ranks.where((F.col("_n") == 1) & (drawn > 0)), same)
              .select("_row", drawn.alias("_copies")))
    repeated = (packed.join(ranks.where("_n > 1"), same)
                .dropDuplicates(["_id", "_source", "_size", "_hash"])
                .transform(each_copy_of)
                .select("_row", crossed(F.col("_first") + F.col("_j"), max_repeat).alias("_copies"))
                .where("_copies > 0"))
    return (single.unionByName(repeated)
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
            .select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c.lower() != "copy"],
                    F.col("_copy").alias("copy")))
