"""Cleaning queries over the masked lineitem ("clinical") table, and the
CSV source that reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import cleaning as C
from quarry.operators import features as FE
from quarry.operators import selection as SE
from quarry.plans.fixtures import (CLINICAL_COLUMNS, CLINICAL_SCHEMA, CLINICAL_SQL, clinical,
                                   clinical_csv, derived)
from quarry.plans.registry import query
from quarry.session import table_version
from quarry.sources import files as FS
from quarry.sources.tables import table

W = "WITH " + CLINICAL_SQL + "\n"
DOUBLE_COLS = ("quantity", "price", "discount", "tax_sparse", "tax")
TEXT_COLS = ("exam_result", "status_test", "flag_test")
NUMERIC_COLS = ("patient_id", "quantity", "price", "discount", "tax_sparse", "linenumber", "tax")


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (results compared across engines)."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), places) if isinstance(f.dataType, T.DoubleType)
         else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields])


def _sel(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in exprs.items())


def _cols(override: dict[str, str] | None = None, cols=CLINICAL_COLUMNS) -> dict[str, str]:
    override = override or {}
    return {c: override.get(c, c) for c in cols}


def _null_count_sql(cols) -> str:
    return "CAST(" + " + ".join(f"({c} IS NULL)::INT" for c in cols) + " AS INTEGER)"


@query("csv_scan", W + "SELECT * FROM clinical")
def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FS.read_csv(spark, clinical_csv(spark, sf_dir), schema=CLINICAL_SCHEMA)


@query("csv_scan_inferred", W + "SELECT * FROM clinical")
def q_csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file with an inferred schema; inferred whole numbers are
    widened to the table's types."""
    inferred = FS.read_csv(spark, clinical_csv(spark, sf_dir), infer=True)
    types = {f.name: f.dataType for f in T.StructType.fromDDL(CLINICAL_SCHEMA).fields}
    return inferred.select(*[F.col(c).cast(types[c]).alias(c) for c in inferred.columns])


@query("drop_columns", W + "SELECT * EXCLUDE (tax_sparse, linenumber) FROM clinical")
def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_columns(clinical(spark, sf_dir),
                          ["tax_sparse", "linenumber", "Influenza A, rapid test"])


@query("select_by_type", W + "SELECT exam_result, status_test, flag_test FROM clinical")
def q_select_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_by_type(clinical(spark, sf_dir), "string")


@query("column_fill_counts", W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n_filled, count(*) AS n_rows FROM clinical"
    for c in CLINICAL_COLUMNS))
def q_column_fill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.column_fill_counts(clinical(spark, sf_dir))


@query("sparse_column_report", W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n_filled, count(*) AS n_rows, "
    f"NOT (count({c}) < count(*) * 0.05::DOUBLE) AS keep FROM clinical"
    for c in CLINICAL_COLUMNS))
def q_sparse_column_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sparse_column_report(clinical(spark, sf_dir))


@query("drop_sparse_columns", W + "SELECT * EXCLUDE (tax_sparse) FROM clinical")
def q_drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_sparse_columns(clinical(spark, sf_dir))


@query("column_summary", W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n_filled, "
    f"round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS stddev, "
    f"min({c}::DOUBLE) AS min, max({c}::DOUBLE) AS max FROM clinical"
    for c in NUMERIC_COLS))
def q_column_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = C.numeric_summary(clinical(spark, sf_dir))
    return s.select("column_name", "n_filled", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"), "min", "max")


@query("column_summary_text", W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n_filled, min({c}) AS min, max({c}) AS max "
    "FROM clinical" for c in TEXT_COLS))
def q_column_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.text_summary(clinical(spark, sf_dir))


@query("column_quartiles")
def q_column_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate quartiles (the sketch ``summary`` uses): rows-only."""
    return C.numeric_quartiles(clinical(spark, sf_dir))


QUARTILE_POINTS = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))


@query("column_quartile_ranks", W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {q}::DOUBLE AS point, count({c}) AS n_filled, TRUE AS within "
    "FROM clinical" for c in ("patient_id", "quantity", "price", "discount", "tax_sparse",
                              "linenumber", "tax") for q, _ in QUARTILE_POINTS))
def q_column_quartile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank check of the quartiles: the rows below and up to each reported
    value enclose the wanted rank within one part in the sketch's accuracy."""
    df = clinical(spark, sf_dir)
    quartiles = C.numeric_quartiles(df).collect()  # one row per numeric column
    aggs, cells = [], []
    for i, r in enumerate(quartiles):
        x = F.col(r["column_name"]).cast("double")
        aggs.append(F.count(x).alias(f"n{i}"))
        for q, name in QUARTILE_POINTS:
            aggs += [F.count_if(x < r[name]).alias(f"lo{i}{name}"), F.count_if(x <= r[name]).alias(f"hi{i}{name}")]
            n, slack = F.col(f"n{i}"), F.col(f"n{i}") / F.lit(C.QUARTILE_ACCURACY) + 1
            cells.append(F.struct(
                F.lit(r["column_name"]).alias("column_name"), F.lit(q).alias("point"), n.alias("n_filled"),
                ((F.col(f"lo{i}{name}") <= n * q + slack) & (F.col(f"hi{i}{name}") >= n * q - slack))
                .alias("within")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


@query("column_quartiles_exact", W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {q}::DOUBLE AS quantile, quantile_disc({c}::DOUBLE, {q}) AS value FROM clinical"
    for c in NUMERIC_COLS for q, _ in QUARTILE_POINTS))
def q_column_quartiles_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of every numeric column."""
    return SE.exact_quantiles(clinical(spark, sf_dir), NUMERIC_COLS)


@query("row_null_count", W + f"SELECT *, {_null_count_sql(CLINICAL_COLUMNS)} AS null_count "
       "FROM clinical")
def q_row_null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.row_null_count(clinical(spark, sf_dir))


@query("drop_sparse_rows", W + f"SELECT * FROM clinical WHERE {_null_count_sql(CLINICAL_COLUMNS)}"
       f" < {len(CLINICAL_COLUMNS) // 2}")
def q_drop_sparse_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_sparse_rows(clinical(spark, sf_dir))


HEALTHY_IDS_SQL = (
    f"ids AS (SELECT DISTINCT patient_id FROM clinical "
    f"WHERE {_null_count_sql(CLINICAL_COLUMNS)} < {len(CLINICAL_COLUMNS) // 2})")


@query("semi_join_healthy_ids", W + ", " + HEALTHY_IDS_SQL + "\nSELECT c.* FROM clinical c "
       "WHERE EXISTS (SELECT 1 FROM ids WHERE ids.patient_id IS NOT DISTINCT FROM c.patient_id)")
def q_semi_join_healthy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.semi_join_healthy_ids(clinical(spark, sf_dir), "patient_id")


#: Buckets of the stored table.
BUCKETS = 16


def bucketed_clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clinical table bucketed by patient, stored once per version of
    lineitem and registered in this session's catalog."""
    name = "quarry_clinical_" + table_version(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    path = derived(spark, "clinical-bucketed", sf_dir, lambda p: C.write_bucketed(
        clinical(spark, sf_dir), "patient_id", BUCKETS, p, name))
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({CLINICAL_SCHEMA}) USING parquet CLUSTERED BY (patient_id) "
                  f"SORTED BY (patient_id) INTO {BUCKETS} BUCKETS LOCATION '{path}'")
    return spark.table(name)


@query("semi_join_bucketed", W + ", " + HEALTHY_IDS_SQL + "\nSELECT c.* FROM clinical c "
       "WHERE EXISTS (SELECT 1 FROM ids WHERE ids.patient_id IS NOT DISTINCT FROM c.patient_id)")
def q_semi_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The healthy-id filter on bucketed storage."""
    return C.semi_join_bucketed(bucketed_clinical(spark, sf_dir), "patient_id")


@query("impute_mean", W + ", m AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}" for c in DOUBLE_COLS) + " FROM clinical)\nSELECT " + _sel(_cols(
        {c: f"round(coalesce({c}, m_{c}), 6)" for c in DOUBLE_COLS})) + " FROM clinical, m")
def q_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(C.impute_mean(clinical(spark, sf_dir), list(DOUBLE_COLS)))


def _mode_sql(c: str) -> str:
    return (f"CASE WHEN count_if({c} = 'not_detected') > count_if({c} = 'detected') "
            f"THEN 'not_detected' ELSE 'detected' END")


@query("impute_two_value_mode", W + ", m AS (SELECT " + ", ".join(
    f"{_mode_sql(c)} AS m_{c}" for c in ("status_test", "flag_test"))
    + " FROM clinical)\nSELECT " + _sel(_cols(
        {c: f"coalesce({c}, m_{c})" for c in ("status_test", "flag_test")}))
    + " FROM clinical, m")
def q_impute_two_value_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.impute_two_value_mode(clinical(spark, sf_dir), ["status_test", "flag_test"])


LABEL_SQL = ("CASE WHEN {c} = 'positive' THEN 1.0::DOUBLE WHEN {c} = 'negative' THEN 0.0::DOUBLE "
             "ELSE TRY_CAST({c} AS DOUBLE) END")
TEXT_SQL = ("CASE WHEN {c} IN ('detected', 'positive') THEN 1.0::DOUBLE "
            "WHEN {c} IN ('not_detected', 'negative') THEN 0.0::DOUBLE "
            "ELSE TRY_CAST({c} AS DOUBLE) END")


@query("encode_binary_label", W + "SELECT " + _sel(_cols(
    {"exam_result": LABEL_SQL.format(c="exam_result")})) + " FROM clinical")
def q_encode_binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.encode_binary_label(clinical(spark, sf_dir), "exam_result")


@query("encode_string_columns", W + "SELECT " + _sel(_cols(
    {c: TEXT_SQL.format(c=c) for c in TEXT_COLS})) + " FROM clinical")
def q_encode_string_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.encode_string_columns(clinical(spark, sf_dir))


@query("drop_unlabeled", """
SELECT d.doc_id, d.lang, CAST(l.quality AS DOUBLE) AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL""")
def q_drop_unlabeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label"))
    return C.drop_unlabeled(docs.join(labels, "doc_id", "left"), "label")


# The whole chain on the clinical table: after the sparse column goes there
# are 9 columns, so a row is healthy with fewer than 4 nulls.
PREPARED_COLS = ("exam_result", "quantity", "price", "discount", "status_test", "flag_test",
                 "linenumber", "tax")
_ENC_COLS = ("patient_id",) + PREPARED_COLS
HEALTHY_SQL = W + ", enc AS (SELECT " + _sel(_cols(
    {"exam_result": LABEL_SQL.format(c="exam_result")}, _ENC_COLS)) + " FROM clinical)" + \
    f", ids AS (SELECT DISTINCT patient_id FROM enc WHERE {_null_count_sql(_ENC_COLS)} < 4)" + \
    ", healthy AS (SELECT e.* FROM enc e WHERE EXISTS (SELECT 1 FROM ids " \
    "WHERE ids.patient_id IS NOT DISTINCT FROM e.patient_id))"
FILL_SQL = HEALTHY_SQL + ", st AS (SELECT " + ", ".join(
        [f"avg({c}) AS m_{c}" for c in ("quantity", "price", "discount", "tax")]
        + [f"{_mode_sql(c)} AS m_{c}" for c in ("status_test", "flag_test")]) + \
    " FROM healthy)"
CLEAN_SQL = FILL_SQL + "\nSELECT " + _sel(_cols({
        **{c: f"round(coalesce({c}, m_{c}), 6)" for c in ("quantity", "price", "discount", "tax")},
        **{c: TEXT_SQL.format(c=f"coalesce({c}, m_{c})") for c in ("status_test", "flag_test")},
    }, PREPARED_COLS)) + " FROM healthy, st"


def prepared(spark: SparkSession, sf_dir: str, keep_row: bool = False) -> DataFrame:
    """The cleaned table; the healthy rows are checkpointed to the shared
    folder so the fill aggregate and the result read them once.  With
    ``keep_row`` the row id (order and line number) stays as ``__row``."""
    key = FE.row_key(["patient_id", "linenumber"]) if keep_row else None
    return C.prepare_table(clinical(spark, sf_dir), "patient_id", "exam_result",
                           checkpoint=True, row_key=key)


@query("clean_table", CLEAN_SQL)
def q_clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(prepared(spark, sf_dir))


# Two more filled columns: 11 columns, so a row is healthy with fewer than 5 nulls.
@query("clean_table_drop_lists", CLEAN_SQL.replace("< 4)", "< 5)"))
def q_clean_table_drop_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain with both drop stages; the dropped columns' names hold
    commas, brackets and dots."""
    df = clinical(spark, sf_dir)
    text, number = "Influenza A, rapid test [v1.0]", "Mix (A, B)"
    df = df.withColumn(text, F.when(F.col("quantity") > 25, "detected").otherwise("not_detected")) \
        .withColumn(number, F.col("quantity") * 2)
    return round_doubles(C.prepare_table(df, "patient_id", "exam_result",
                                         drop_before_encoding=[text], drop_after=[number],
                                         checkpoint=True))


_FEATS = [c for c in CLINICAL_COLUMNS if c != "exam_result"]
_ZERO = {c: "0.0::DOUBLE" for c in ("status_test", "flag_test")}


@query("assemble_features", W + "SELECT " + LABEL_SQL.format(c="exam_result") + " AS label, "
       + ", ".join(f"{_ZERO.get(c, f'coalesce(CAST({c} AS DOUBLE), 0.0::DOUBLE)')} AS f{i}"
                   for i, c in enumerate(_FEATS)) + " FROM clinical")
def q_assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.encode_binary_label(clinical(spark, sf_dir), "exam_result")
    vec = FE.assemble_features(df, "exam_result")
    return FE.unpack_vector(vec, "features", len(_FEATS), keep=("label",))


@query("prepared_label_distribution", "WITH prepared AS (" + CLEAN_SQL + ")\n"
       + "\nUNION ALL\n".join(
           f"SELECT {k}::DOUBLE AS label, CAST(count_if(exam_result = {k}) AS BIGINT) AS n "
           "FROM prepared" for k in (0.0, 1.0)))
def q_prepared_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label ratios of the cleaned table (both classes, 0 when absent)."""
    from quarry.operators.metrics import label_distribution
    return label_distribution(prepared(spark, sf_dir), "exam_result", (0.0, 1.0))
