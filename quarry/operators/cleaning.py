"""Table cleaning: sparse columns and rows, healthy-id filter, imputation,
label and string encoding, type-driven column choice.

Every data-dependent decision (which columns survive, which value fills a
gap) comes from ONE global aggregate over all columns at once: partial
aggregates per task, one row to the driver -- never the data itself.  The
decision is then applied as literal column expressions in a single
``select``, so wide tables keep a flat plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text labels the cleaning rules recognise.
POSITIVE, NEGATIVE = "positive", "negative"
DETECTED, NOT_DETECTED = "detected", "not_detected"
# A column is sparse when fewer than this share of its rows is filled.
SPARSE_COLUMN_SHARE = 0.05

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _q(name: str) -> Column:
    """Column by exact name (names may hold spaces, commas or dots)."""
    return F.col(f"`{name}`")


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns; names not present are ignored."""
    drop = set(names)
    return df.select(*[_q(c) for c in df.columns if c not in drop])


def columns_by_type(df: DataFrame, kind: str = "string",
                    exclude: Iterable[str] = ()) -> list[str]:
    """Names of columns of a type family (``string``, ``numeric``,
    ``boolean`` or a Spark simple-type name) minus ``exclude``."""
    skip = set(exclude)
    out = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        dt = f.dataType
        if kind == "string":
            hit = isinstance(dt, T.StringType)
        elif kind == "numeric":
            hit = isinstance(dt, NUMERIC_TYPES)
        elif kind == "boolean":
            hit = isinstance(dt, T.BooleanType)
        else:
            hit = dt.simpleString() == kind
        if hit:
            out.append(f.name)
    return out


def select_by_type(df: DataFrame, kind: str = "string",
                   exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*[_q(c) for c in columns_by_type(df, kind, exclude)])


# --- fill counts, summaries -------------------------------------------------

def fill_count_row(df: DataFrame) -> dict[str, int]:
    """Non-null count per column plus ``__rows__``, from one aggregate."""
    exprs = [F.count(F.lit(1)).alias("__rows__")] + [
        F.count(_q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    row = df.agg(*exprs).first()
    out = {c: int(row[f"c{i}"]) for i, c in enumerate(df.columns)}
    out["__rows__"] = int(row["__rows__"])
    return out


def column_fill_counts(df: DataFrame) -> DataFrame:
    """Long table ``(column_name, n_filled, n_rows)``: one aggregate, then
    the single wide row is turned into one row per column (no shuffle of
    data)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows__"),
                  *[F.count(_q(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_filled"),
                 F.col("__rows__").alias("n_rows"))
        for i, c in enumerate(cols)])))


def sparse_column_report(df: DataFrame, min_share: float = SPARSE_COLUMN_SHARE) -> DataFrame:
    """``column_fill_counts`` plus the keep decision: a column is kept
    unless its filled count is below ``n_rows * min_share`` (exactly the
    share stays)."""
    return column_fill_counts(df).withColumn(
        "keep", ~(F.col("n_filled") < F.col("n_rows") * F.lit(float(min_share))))


def drop_sparse_columns(df: DataFrame, min_share: float = SPARSE_COLUMN_SHARE) -> DataFrame:
    """Keep column ``c`` iff ``count(c) >= rows * min_share``.

    Every column type is counted (booleans too), in one aggregate job.
    """
    counts = fill_count_row(df)
    limit = counts["__rows__"] * float(min_share)
    keep = [c for c in df.columns if not counts[c] < limit]
    return df.select(*[_q(c) for c in keep])


def numeric_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Typed ``summary``: ``(column_name, n_filled, mean, stddev, min, max)``
    for numeric columns, from one aggregate."""
    cols = list(cols) if cols is not None else columns_by_type(df, "numeric")
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_filled"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])))


def text_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, n_filled, min, max)`` for text columns (the text part
    of ``summary``), from one aggregate."""
    cols = list(cols) if cols is not None else columns_by_type(df, "string")
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(_q(c)).alias(f"n{i}"), F.min(_q(c)).alias(f"lo{i}"),
                 F.max(_q(c)).alias(f"hi{i}")]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_filled"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])))


#: Accuracy of the quartile sketch: a rank is right within rows / accuracy.
QUARTILE_ACCURACY = 10_000


def numeric_quartiles(df: DataFrame, cols: Sequence[str] | None = None,
                      accuracy: int = QUARTILE_ACCURACY) -> DataFrame:
    """Approximate 25/50/75 % points per numeric column (the same sketch
    ``DataFrame.summary`` uses; mergeable, bounded memory per task)."""
    cols = list(cols) if cols is not None else columns_by_type(df, "numeric")
    wide = df.agg(*[F.percentile_approx(_q(c).cast("double"), [0.25, 0.5, 0.75], accuracy)
                    .alias(f"q{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"q{i}")[0].alias("p25"),
                 F.col(f"q{i}")[1].alias("p50"), F.col(f"q{i}")[2].alias("p75"))
        for i, c in enumerate(cols)])))


# --- sparse rows ------------------------------------------------------------

def balanced_sum(terms: Sequence[Column]) -> Column:
    """``t0 + t1 + ...`` as a balanced tree (depth log n), so a table with
    thousands of columns does not build an expression thousands deep."""
    terms = list(terms)
    if not terms:
        return F.lit(0)
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i]
                 for i in range(0, len(terms), 2)]
    return terms[0]


def null_count_expr(cols: Sequence[str]) -> Column:
    """Number of null cells among ``cols`` in a row (JVM-side sum)."""
    return balanced_sum([_q(c).isNull().cast("int") for c in cols])


def row_null_count(df: DataFrame, out_col: str = "null_count") -> DataFrame:
    """Append the per-row null count over all columns."""
    return df.withColumn(out_col, null_count_expr(df.columns))


def healthy_row(df: DataFrame) -> Column:
    """True when a row has fewer nulls than half its columns (integer
    division; exactly half is not healthy)."""
    return null_count_expr(df.columns) < F.lit(len(df.columns) // 2)


def drop_sparse_rows(df: DataFrame) -> DataFrame:
    """Row version: keep rows with ``nulls < columns // 2``."""
    return df.filter(healthy_row(df))


def semi_join_healthy_ids(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Id version: keep every row whose id also appears on a healthy row.

    A sparse row that shares its id with a healthy row stays.  Ids match
    null-safely (a null id on a healthy row keeps the null-id rows).  Healthy
    rows stay where they are, only the others are looked up.  The
    id set is de-duplicated by an aggregate before the join; AQE picks a
    broadcast when that set is small and splits skewed partitions of a hot
    id otherwise.
    """
    id_col = id_col or df.columns[0]
    healthy = healthy_row(df)
    ids = df.filter(healthy).select(_q(id_col).alias("__id__")).distinct()
    return df.filter(healthy).union(
        df.filter(~healthy).join(ids, _q(id_col).eqNullSafe(F.col("__id__")), "left_semi"))


def write_bucketed(df: DataFrame, id_col: str, buckets: int, path: str, name: str) -> DataFrame:
    """``df`` stored below ``path`` as table ``name``, bucketed and sorted by
    the id, so that later joins and aggregates on it need no exchange."""
    df.write.format("parquet").option("path", path).bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(name)
    return df.sparkSession.table(name)


def semi_join_bucketed(df: DataFrame, id_col: str) -> DataFrame:
    """:func:`semi_join_healthy_ids` on a table bucketed by the id: both sides
    are read bucket by bucket, without an exchange.

    Null ids are no bucket's key; their rows are kept or not by one look for a
    healthy one.  A bucket is one task, also that of a hot id: its rows stream
    through a merge join, but they are not split (the shuffled form does that).
    """
    known = _q(id_col).isNotNull()
    ids = df.filter(healthy_row(df) & known).select(_q(id_col).alias("__id__")).distinct()
    kept = df.filter(known).join(ids.hint("merge"), _q(id_col) == F.col("__id__"), "left_semi")
    if df.filter(healthy_row(df) & ~known).isEmpty():
        return kept
    return kept.unionByName(df.filter(~known))


# --- imputation -------------------------------------------------------------

def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Mean of the non-null values per column, one aggregate; ``None`` for
    a column with no value."""
    row = df.agg(*[F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(cols)}


def impute_mean(df: DataFrame, cols: Sequence[str] | None = None,
                means: dict[str, float | None] | None = None) -> DataFrame:
    """Fill nulls with the column mean of the rows given.

    The means come from the input rows before any filling (one aggregate for
    all columns); a column with no value at all stays null.
    """
    cols = list(cols) if cols is not None else [
        c for c in columns_by_type(df, "numeric")
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    means = means if means is not None else column_means(df, cols)
    fill = set(cols)
    return df.select(*[
        (F.coalesce(_q(c), F.lit(means[c]).cast(df.schema[c].dataType)) if
         (c in fill and means.get(c) is not None) else _q(c)).alias(c)
        for c in df.columns])


def two_value_modes(df: DataFrame, cols: Sequence[str], first: str = DETECTED,
                    second: str = NOT_DETECTED) -> dict[str, str]:
    """Per column, ``second`` when it occurs strictly more often than
    ``first``, else ``first`` (ties and empty columns give ``first``).
    Other values are not counted."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_if(_q(c) == first).alias(f"a{i}"),
                 F.count_if(_q(c) == second).alias(f"b{i}")]
    row = df.agg(*aggs).first()
    return {c: (second if row[f"b{i}"] > row[f"a{i}"] else first)
            for i, c in enumerate(cols)}


def impute_two_value_mode(df: DataFrame, cols: Sequence[str] | None = None,
                          first: str = DETECTED, second: str = NOT_DETECTED,
                          modes: dict[str, str] | None = None) -> DataFrame:
    """Fill nulls of two-valued string columns with the more frequent value."""
    cols = list(cols) if cols is not None else columns_by_type(df, "string")
    modes = modes if modes is not None else two_value_modes(df, cols, first, second)
    return df.select(*[
        (F.coalesce(_q(c), F.lit(modes[c])) if c in modes else _q(c)).alias(c)
        for c in df.columns])


# --- encoding ---------------------------------------------------------------

def encode_binary_label_expr(c: str | Column, positive: str = POSITIVE,
                             negative: str = NEGATIVE) -> Column:
    """positive -> 1.0, negative -> 0.0, other text parsed leniently."""
    x = _q(c) if isinstance(c, str) else c
    return (F.when(x == positive, F.lit(1.0)).when(x == negative, F.lit(0.0))
            .otherwise(x.try_cast("double")))


def encode_binary_label(df: DataFrame, label_col: str, positive: str = POSITIVE,
                        negative: str = NEGATIVE) -> DataFrame:
    return df.select(*[
        (encode_binary_label_expr(c, positive, negative) if c == label_col else _q(c)).alias(c)
        for c in df.columns])


def encode_string_expr(c: str | Column) -> Column:
    """detected/positive -> 1.0, not_detected/negative -> 0.0, other text
    parsed leniently to double (unparsable -> null)."""
    x = _q(c) if isinstance(c, str) else c
    return (F.when(x.isin(DETECTED, POSITIVE), F.lit(1.0))
            .when(x.isin(NOT_DETECTED, NEGATIVE), F.lit(0.0))
            .otherwise(x.try_cast("double")))


def encode_string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Encode every string column not in ``exclude`` to double, one select."""
    todo = set(columns_by_type(df, "string", exclude))
    return df.select(*[(encode_string_expr(c) if c in todo else _q(c)).alias(c)
                       for c in df.columns])


def drop_unlabeled(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Drop rows whose label is missing (unknown class, fragment lines)."""
    return df.filter(_q(label_col).isNotNull())


# --- the whole cleaning chain -----------------------------------------------

#: Column of the stable row id that splits use.
ROW = "__row"

def fit_fill_values(df: DataFrame, mean_cols: Sequence[str], mode_cols: Sequence[str],
                    first: str = DETECTED, second: str = NOT_DETECTED
                    ) -> tuple[dict[str, float | None], dict[str, str]]:
    """Means and two-value modes from ONE aggregate over ``df``."""
    aggs = [F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(mean_cols)]
    for i, c in enumerate(mode_cols):
        aggs += [F.count_if(_q(c) == first).alias(f"a{i}"),
                 F.count_if(_q(c) == second).alias(f"b{i}")]
    if not aggs:
        return {}, {}
    row = df.agg(*aggs).first()
    means = {c: row[f"m{i}"] for i, c in enumerate(mean_cols)}
    modes = {c: (second if row[f"b{i}"] > row[f"a{i}"] else first)
             for i, c in enumerate(mode_cols)}
    return means, modes


def prepare_table(df: DataFrame, id_col: str, label_col: str,
                  drop_before_encoding: Iterable[str] = (),
                  drop_after: Iterable[str] = (),
                  min_share: float = SPARSE_COLUMN_SHARE,
                  checkpoint: bool = False, row_key: Column | None = None) -> DataFrame:
    """Sparse table -> trainable table, in the reference's order:

    1. label text -> 1.0 / 0.0;
    2. drop columns filled below ``min_share``;
    3. keep rows whose id appears on a row with fewer nulls than half the
       columns;
    4. fill double columns with their mean and two-valued text columns
       with the more frequent value, both measured on the rows of step 3
       before any filling (one aggregate);
    5. drop ``drop_before_encoding``; encode the remaining text columns;
    6. drop the id and ``drop_after``.

    Two small aggregates reach the driver (fill counts, fill values, no
    data); everything else is one lazy plan.  With ``checkpoint`` the rows
    of step 3 are written once to the shared checkpoint folder, so the fill
    aggregate and the final plan read them instead of each re-running the
    self semi join (and lineage stops there).  ``row_key``, an expression over
    the columns of step 3, is kept as text column ``__row``: the stable row id
    that splits use once the id column is gone.
    """
    df = encode_binary_label(df, label_col)
    df = drop_sparse_columns(df, min_share)
    df = semi_join_healthy_ids(df, id_col)
    if row_key is not None:
        df = df.withColumn(ROW, row_key.cast("string"))
    if checkpoint:
        from quarry.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    skip = {id_col, label_col, ROW}
    dbl = [c for c in df.columns if c not in skip
           and isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    txt = [c for c in columns_by_type(df, "string") if c not in skip]
    means, modes = fit_fill_values(df, dbl, txt)
    df = impute_mean(df, dbl, means)
    df = impute_two_value_mode(df, txt, modes=modes)
    df = drop_columns(df, drop_before_encoding)
    df = encode_string_columns(df, exclude=[id_col, ROW])
    return drop_columns(df, [id_col, *drop_after])
