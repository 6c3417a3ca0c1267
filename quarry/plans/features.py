"""Source, feature-preparation, PCA and regression queries over lineitem,
orders and embeddings."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.strings import parse_double
from quarry.operators import features as FE
from quarry.operators import moments as MO
from quarry.operators import reduce as RD
from quarry.operators import regression as RG
from quarry.operators import subspace as SU
from quarry.plans.fixtures import (FLAG_FEATURES, FLAG_LABEL_SQL, LINE_KEYS, SEVEN_CLASS_SQL, flags,
                                   VECTOR_LABEL_SQL, named_class_lines, numeric_class_lines,
                                   regression_libsvm, vector_libsvm)
from quarry.plans.registry import query
from quarry.sources import delimited as DL
from quarry.sources import files as FS
from quarry.sources.results import result_rows
from quarry.sources.tables import table
from quarry.sources.text import read_text_lines

KEYS_SQL = ", ".join(LINE_KEYS)

# --- sources ----------------------------------------------------------------


@query("delimited_labeled_points", f"SELECT CAST({SEVEN_CLASS_SQL} AS DOUBLE) AS label, "
       + ", ".join(f"{c} AS f{i}" for i, c in enumerate(FLAG_FEATURES)) + " FROM lineitem")
def q_delimited_labeled_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_text_lines(spark, numeric_class_lines(spark, sf_dir))
    return DL.parse_last_label(lines, n_features=4)


@query("delimited_string_label", f"SELECT {FLAG_LABEL_SQL} AS label, "
       + ", ".join(f"{c} AS f{i}" for i, c in enumerate(FLAG_FEATURES)) + " FROM lineitem")
def q_delimited_string_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_text_lines(spark, named_class_lines(spark, sf_dir))
    return DL.parse_text_label(lines, n_features=4)


LIBSVM_LABEL_SQL = "l_quantity / 10.0::DOUBLE + l_extendedprice / 10000.0::DOUBLE"


@query("libsvm_scan", f"SELECT {LIBSVM_LABEL_SQL} AS label, l_quantity AS f0 FROM lineitem")
def q_libsvm_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = FS.read_libsvm(spark, regression_libsvm(spark, sf_dir), num_features=1)
    return FS.vector_columns(pts, "features", 1, prefix="f", keep=("label",))


@query("matrix_scan", "SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, "
       "round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm "
       "FROM embeddings")
def q_matrix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = FS.matrix_vectors(table(spark, sf_dir, "embeddings"), "embedding",
                            keep=("vec_id", "label"))
    arr = vector_to_array(F.col("features"))
    return vec.select("vec_id", "label", F.size(arr).alias("dims"),
                      F.round(F.sqrt(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x)), 6)
                      .alias("norm"))


# --- scalar functions ---------------------------------------------------------


@query("parse_double", "SELECT l_orderkey, l_linenumber, "
       "CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price, "
       "TRY_CAST(l_returnflag AS DOUBLE) AS flag_number FROM lineitem")
def q_parse_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     parse_double(F.col("l_extendedprice").cast("string")).alias("price"),
                     parse_double("l_returnflag", strict=False).alias("flag_number"))


_ARR_SQL = ("[l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE)]")


def _txt_sql(e: str) -> str:
    return f"array_to_string(list_transform({e}, lambda x: printf('%.4f', x)), ',')"


@query("array_slice_ops", f"SELECT {KEYS_SQL}, {_txt_sql('a[1:len(a) - 1]')} AS init, "
       "a[-1] AS last, " + _txt_sql("a[1:2]") + " AS head2, "
       + _txt_sql("list_concat(a[1:2], [a[-1]])") + " AS head2_last "
       f"FROM (SELECT {KEYS_SQL}, {_ARR_SQL} AS a FROM lineitem)")
def q_array_slice_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """init / last / take / concat on a numeric array (rendered to text for
    comparison)."""
    li = table(spark, sf_dir, "lineitem")
    a = F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                F.col("l_linenumber").cast("double"))

    def txt(e):
        return F.array_join(F.transform(e, lambda x: F.format_string("%.4f", x)), ",")

    init = F.slice(F.col("a"), 1, F.size("a") - 1)
    head2 = F.slice(F.col("a"), 1, 2)
    return li.select(*LINE_KEYS, a.alias("a")).select(
        *LINE_KEYS, txt(init).alias("init"), F.element_at("a", -1).alias("last"),
        txt(head2).alias("head2"),
        txt(F.concat(head2, F.array(F.element_at("a", -1)))).alias("head2_last"))


# --- class pairs and splits ----------------------------------------------------

PAIRS = (("01", (0.0, 1.0)), ("02", (0.0, 2.0)), ("12", (1.0, 2.0)))


@query("class_pair_subset", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS pair, {KEYS_SQL}, label FROM (SELECT {KEYS_SQL}, {FLAG_LABEL_SQL} AS label"
    f" FROM lineitem) WHERE label IN ({keep[0]}, {keep[1]})" for name, keep in PAIRS))
def q_class_pair_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = flags(spark, sf_dir).select(*LINE_KEYS, "label")
    return FE.explode_pairs(data, PAIRS).select("pair", *LINE_KEYS, "label")


RELABEL = (("02", (0.0, 2.0), 2.0), ("12", (1.0, 2.0), 1.0))


@query("relabel_pair", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS pair, {KEYS_SQL}, CASE WHEN label = {pos} THEN 1.0::DOUBLE "
    f"ELSE 0.0::DOUBLE END AS label FROM (SELECT {KEYS_SQL}, {FLAG_LABEL_SQL} AS label "
    f"FROM lineitem) WHERE label IN ({keep[0]}, {keep[1]})" for name, keep, pos in RELABEL))
def q_relabel_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = flags(spark, sf_dir).select(*LINE_KEYS, "label")
    pairs = FE.explode_pairs(data, [(name, keep) for name, keep, _ in RELABEL])
    positive = F.create_map(*[F.lit(x) for name, _, pos in RELABEL for x in (name, pos)])[F.col("pair")]
    return pairs.select("pair", *LINE_KEYS, F.when(F.col("label") == positive, 1.0).otherwise(0.0)
                        .alias("label"))


def _hash_sql(key: str) -> str:
    return f"('0x' || substr(md5({key}), 1, 8))::BIGINT"


B80, B90 = FE.split_bounds((80, 10, 10))
B60, = FE.split_bounds((60, 40))


@query("split_80_10_10", f"SELECT o_orderkey, CASE WHEN b < {B80} THEN 'train' WHEN b < {B90} THEN 'cv' "
       "ELSE 'test' END AS split FROM (SELECT o_orderkey, "
       f"{_hash_sql('CAST(o_orderkey AS VARCHAR)')} AS b FROM orders)")
def q_split_80_10_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", FE.split_column(F.col("o_orderkey").cast("string"),
                                                  (80, 10, 10), ("train", "cv", "test"))
                    .alias("split"))


_LINE_KEY_SQL = ("concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                 "CAST(round(l_extendedprice * 100) AS BIGINT), '14')")


@query("split_60_40", f"SELECT {KEYS_SQL}, l_extendedprice, CASE WHEN b < {B60} THEN 'train' "
       f"ELSE 'test' END AS split FROM (SELECT *, {_hash_sql(_LINE_KEY_SQL)} AS b FROM lineitem)")
def q_split_60_40(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in LINE_KEYS],
                      cents.cast("string"), F.lit("14"))
    return li.select(*LINE_KEYS, "l_extendedprice",
                     FE.split_column(key, (60, 40), ("train", "test")).alias("split"))


# --- kernel, min-max, centring ------------------------------------------------

KERNEL_INPUT = ("l_quantity", "price_k", "l_discount", "l_tax")
_KIN_SQL = {"l_quantity": "l_quantity", "price_k": "l_extendedprice / 1000.0::DOUBLE",
            "l_discount": "l_discount", "l_tax": "l_tax"}


def _kernel_sql() -> str:
    out, i = [], 0
    for c in KERNEL_INPUT:
        x = _KIN_SQL[c]
        # Products of doubles are the same bits in both engines: nothing is rounded.
        for t in (f"({x}) * (1.0::DOUBLE / sqrt(3.0::DOUBLE))", f"({x}) * ({x})",
                  f"(({x}) * ({x})) * ({x})"):
            out.append(f"{t} AS k{i}")
            i += 1
    return ", ".join(out)


@query("kernel_expand", f"SELECT {KEYS_SQL}, {_kernel_sql()} FROM lineitem")
def q_kernel_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, "l_quantity", (F.col("l_extendedprice") / F.lit(1000.0)).alias("price_k"),
        "l_discount", "l_tax")
    return FE.kernel_expand(li, KERNEL_INPUT, keep=LINE_KEYS)


@query("feature_min_max", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, min({c}) AS min, max({c}) AS max FROM lineitem"
    for c in FLAG_FEATURES))
def q_feature_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.feature_min_max(table(spark, sf_dir, "lineitem"), FLAG_FEATURES)


@query("min_max_normalize", "WITH s AS (SELECT " + ", ".join(
    f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FLAG_FEATURES) + " FROM lineitem)\n"
    f"SELECT {KEYS_SQL}, " + ", ".join(
        f"round(CASE WHEN hi_{c} = lo_{c} THEN 0.0::DOUBLE ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c})"
        f" END, 6) AS {c}" for c in FLAG_FEATURES) + " FROM lineitem, s")
def q_min_max_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *FLAG_FEATURES)
    out = FE.min_max_normalize(li, FLAG_FEATURES)
    return out.select(*LINE_KEYS, *[F.round(c, 6).alias(c) for c in FLAG_FEATURES])


CENTER_COLS = ("l_quantity", "l_extendedprice")


@query("column_means", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean FROM lineitem" for c in CENTER_COLS))
def q_column_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = FE.column_means_frame(table(spark, sf_dir, "lineitem"), CENTER_COLS)
    return m.select("column_name", F.round("mean", 6).alias("mean"))


@query("mean_center", "WITH m AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}" for c in CENTER_COLS) + " FROM lineitem)\n"
    f"SELECT {KEYS_SQL}, " + ", ".join(f"round({c} - m_{c}, 6) + 0.0 AS {c}" for c in CENTER_COLS)
    + " FROM lineitem, m")
def q_mean_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *CENTER_COLS)
    out = FE.mean_center(li, CENTER_COLS)
    return out.select(*LINE_KEYS, *[F.round(c, 6).alias(c) for c in CENTER_COLS])


# --- PCA ----------------------------------------------------------------------

PCA_SQL = """m AS (SELECT var_samp(l_quantity) AS a, covar_samp(l_quantity, l_extendedprice) AS b,
                 var_samp(l_extendedprice) AS d, avg(l_quantity) AS mx,
                 avg(l_extendedprice) AS my FROM lineitem),
l AS (SELECT *, ((a + d) + sqrt((a - d) * (a - d) + 4.0::DOUBLE * b * b)) / 2.0::DOUBLE AS lam
      FROM m),
v AS (SELECT *,
  CASE WHEN b = 0 THEN (CASE WHEN a >= d THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
       WHEN a >= d THEN lam - d ELSE b END AS vx,
  CASE WHEN b = 0 THEN (CASE WHEN a >= d THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END)
       WHEN a >= d THEN b ELSE lam - a END AS vy FROM l),
s AS (SELECT *, sqrt(vx * vx + vy * vy) AS nrm,
  CASE WHEN abs(vx) >= abs(vy) THEN sign(vx) ELSE sign(vy) END AS sg FROM v),
pc AS (SELECT *, sg * vx / nrm AS xl, sg * vy / nrm AS yl FROM s)"""


@query("pca_top_component", "WITH " + PCA_SQL + """
SELECT round(xl, 9) AS x_loading, round(yl, 9) AS y_loading, round(lam, 3) AS eigenvalue,
       round(lam / (a + d), 9) AS explained_ratio FROM pc""")
def q_pca_top_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    pc = RD.top_component_2d_frame(table(spark, sf_dir, "lineitem"), *CENTER_COLS)
    return pc.select(F.round("x_loading", 9).alias("x_loading"),
                     F.round("y_loading", 9).alias("y_loading"),
                     F.round("eigenvalue", 3).alias("eigenvalue"),
                     F.round("explained_ratio", 9).alias("explained_ratio"))


@query("pca_project", "WITH " + PCA_SQL + f"\nSELECT {KEYS_SQL}, round((l_quantity - mx) * xl + "
       "(l_extendedprice - my) * yl, 6) + 0.0 AS pc1 FROM lineitem, pc")
def q_pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *CENTER_COLS)
    out = RD.pca_project(li, CENTER_COLS, k=1, keep=LINE_KEYS)
    return out.select(*LINE_KEYS, F.round("pc1", 6).alias("pc1"))


@query("pca_embeddings")
def q_pca_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of any length -> top two components (``ml.feature.PCA``): rows-only."""
    vec = FS.matrix_vectors(table(spark, sf_dir, "embeddings"), "embedding", keep=("vec_id", "label"))
    return RD.pca_project_vectors(vec, "features", k=2, keep=("vec_id", "label"))


def _pca_sql(rounds: int = 400) -> str:
    """Covariance matrix, then power iteration for the first eigenvalue and,
    on the deflated matrix, the second."""
    def power(name: str, matrix: str) -> str:
        norm = "sqrt(list_dot_product(u, u))"
        return f"""{name}_it AS (
  SELECT 0 AS it, list_transform(range(64), lambda i: 1.0::DOUBLE + i / 100.0::DOUBLE) AS v
  UNION ALL
  SELECT it + 1, list_transform(u, lambda x: x / {norm}) FROM (
    SELECT it, list_transform(m, lambda r: list_dot_product(r, v)) AS u FROM {name}_it, {matrix} WHERE it < {rounds})),
{name} AS MATERIALIZED (
  SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS ev
  FROM {name}_it, {matrix} WHERE it = {rounds})"""

    return f"""WITH RECURSIVE x AS MATERIALIZED (
  SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
c AS MATERIALIZED (SELECT a.i AS i, b.i AS j, covar_samp(a.x, b.x) AS c FROM x a JOIN x b USING (vec_id) GROUP BY a.i, b.i),
m1 AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(c ORDER BY j) AS r FROM c GROUP BY i)),
total AS (SELECT sum(c) AS t FROM c WHERE i = j),
{power("e1", "m1")},
m2 AS MATERIALIZED (SELECT list_transform(range(64), lambda i: list_transform(range(64),
  lambda j: m[i + 1][j + 1] - ev * v[i + 1] * v[j + 1])) AS m FROM m1, e1),
{power("e2", "m2")}
SELECT 1 AS component, round(e1.ev / t, 3) AS explained, round(t, 6) AS total, TRUE AS holds FROM e1, total
UNION ALL
SELECT 2, round(e2.ev / t, 3), round(t, 6), TRUE FROM e2, total"""


@query("pca_embeddings_checks", _pca_sql())
def q_pca_embeddings_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top two components of the embeddings by subspace iteration: the share
    of the variance each explains, and whether C v = lambda v holds."""
    c = SU.subspace_components(table(spark, sf_dir, "embeddings"), F.col("embedding").cast("array<double>"), 2)
    rows = [(j + 1, round(float(c.eigenvalues[j] / c.total), 3), round(c.total, 6), c.residual < 1e-3)
            for j in range(len(c.eigenvalues))]
    return result_rows(spark, rows, T.StructType([
        T.StructField("component", T.IntegerType()), T.StructField("explained", T.DoubleType()),
        T.StructField("total", T.DoubleType()), T.StructField("holds", T.BooleanType())]))


# --- regression -----------------------------------------------------------------

REG_X, REG_Y = "x", "y"


def regression_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_quantity").alias(REG_X),
                     (F.col("l_quantity") / F.lit(10.0) + F.col("l_extendedprice") / F.lit(10000.0))
                     .alias(REG_Y))


MOMENTS_SQL = f"""d AS (SELECT l_quantity AS x, {LIBSVM_LABEL_SQL} AS y FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, var_pop(y) AS vy,
             covar_pop(x, y) AS cxy FROM d)"""


def _fit_sql(alpha: str, lam: str) -> str:
    slope = (f"(sign(cxy) * greatest(abs(cxy) - {lam} * {alpha} * sqrt(vx), 0.0::DOUBLE) "
             f"/ (vx + {lam} * (1.0::DOUBLE - {alpha}) * vx / sqrt(vy)))")
    return slope


SWEEP_SQL = "WITH RECURSIVE " + MOMENTS_SQL + """,
lam(step, reg_param) AS (SELECT 0, 0.0::DOUBLE UNION ALL
  SELECT step + 1, reg_param + 0.1::DOUBLE FROM lam WHERE reg_param + 0.1::DOUBLE <= 10.05::DOUBLE),
al(elastic_net) AS (VALUES (0.0::DOUBLE), (0.13::DOUBLE), (1.0::DOUBLE)),
fit AS (SELECT elastic_net, step, reg_param, mx, my, vx, vy, cxy, """ + \
    _fit_sql("elastic_net", "reg_param") + " AS b FROM m, al, lam)"

R2_SQL = "1.0::DOUBLE - (vy - 2.0::DOUBLE * b * cxy + b * b * vx) / vy"


@query("lambda_sweep", SWEEP_SQL + f"""
SELECT elastic_net, CAST(step AS INTEGER) AS step, reg_param, round(b, 8) + 0.0 AS coefficient,
       round(my - b * mx, 8) + 0.0 AS intercept, round({R2_SQL}, 8) + 0.0 AS r2 FROM fit""")
def q_lambda_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = RG.lambda_sweep_1d(regression_frame(spark, sf_dir), REG_X, REG_Y)
    return s.select("elastic_net", "step", "reg_param",
                    *[F.round(c, 8).alias(c) for c in ("coefficient", "intercept", "r2")])


@query("lambda_sweep_libsvm", SWEEP_SQL + f"""
SELECT elastic_net, CAST(step AS INTEGER) AS step, reg_param, round({R2_SQL}, 8) + 0.0 AS r2
FROM fit""")
def q_lambda_sweep_libsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep end to end from a libsvm file (label, one feature): read,
    one moment pass, 303 cells."""
    pts = FS.read_libsvm(spark, regression_libsvm(spark, sf_dir), num_features=1)
    data = FS.vector_columns(pts, "features", 1, prefix="x", keep=("label",))
    s = RG.lambda_sweep_1d(data, "x0", "label")
    return s.select("elastic_net", "step", "reg_param", F.round("r2", 8).alias("r2"))


@query("lambda_sweep_report", SWEEP_SQL + f"""
SELECT elastic_net, CAST(step AS INTEGER) AS step, printf('%.1f', reg_param) AS lambda_text,
       round({R2_SQL}, 8) + 0.0 AS r2 FROM fit""")
def q_lambda_sweep_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RG.sweep_report(RG.lambda_sweep_1d(regression_frame(spark, sf_dir), REG_X, REG_Y))


# The sweep on a feature vector.  In standardised units a cell minimises
# b'Cb/2 - r'b + lam/sd(y) * (alpha |b| + (1 - alpha)/2 b'b); the oracle solves it by
# coordinate descent over the correlations C and r.
def _vector_sweep_sql(rounds: int = 300) -> str:
    names = [f"x{i}" for i in range(1, 5)]
    d = ", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate(FLAG_FEATURES, 1))
    corr = [f"corr({a}, {b}) AS c{i}{j}" for i, a in enumerate(names, 1)
            for j, b in enumerate(names, 1) if i < j]
    corr += [f"corr({a}, y) AS r{i}" for i, a in enumerate(names, 1)]
    inner = "SELECT * FROM cd, m WHERE it < " + str(rounds)
    for i in range(1, 5):
        rest = " - ".join(f"c{min(i, j)}{max(i, j)} * {'n' if j < i else 'b'}{j}"
                          for j in range(1, 5) if j != i)
        z = f"(r{i} - {rest})"
        inner = (f"SELECT *, sign({z}) * greatest(abs({z}) - reg_param * elastic_net / sy, 0.0::DOUBLE) "
                 f"/ (1.0::DOUBLE + reg_param * (1.0::DOUBLE - elastic_net) / sy) AS n{i} FROM ({inner})")
    quad = " + ".join(f"b{i} * b{i}" for i in range(1, 5)) + " + 2.0::DOUBLE * (" + " + ".join(
        f"c{i}{j} * b{i} * b{j}" for i in range(1, 5) for j in range(i + 1, 5)) + ")"
    lin = " + ".join(f"r{i} * b{i}" for i in range(1, 5))
    return f"""WITH RECURSIVE d AS (SELECT {d}, {VECTOR_LABEL_SQL} AS y FROM lineitem),
m AS (SELECT stddev_pop(y) AS sy, {", ".join(corr)} FROM d),
lam(step, reg_param) AS (SELECT 0, 0.0::DOUBLE UNION ALL
  SELECT step + 1, reg_param + 0.1::DOUBLE FROM lam WHERE reg_param + 0.1::DOUBLE <= 10.05::DOUBLE),
al(elastic_net) AS (VALUES (0.0::DOUBLE), (0.13::DOUBLE), (1.0::DOUBLE)),
cd(it, elastic_net, step, reg_param, b1, b2, b3, b4) AS (
  SELECT 0, elastic_net, step, reg_param, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM al, lam
  UNION ALL
  SELECT it + 1, elastic_net, step, reg_param, n1, n2, n3, n4 FROM ({inner}))
SELECT elastic_net, CAST(step AS INTEGER) AS step, reg_param,
  round(2.0::DOUBLE * ({lin}) - ({quad}), 6) + 0.0 AS r2 FROM cd, m WHERE it = {rounds}"""


@query("lambda_sweep_vector", _vector_sweep_sql())
def q_lambda_sweep_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 3 x 101 sweep on four features from a libsvm file: one pass for the
    moment matrix, all cells on it."""
    pts = FS.read_libsvm(spark, vector_libsvm(spark, sf_dir), num_features=4)
    data = FS.vector_columns(pts, "features", 4, prefix="x", keep=("label",))
    s = MO.lambda_sweep_moments(spark, data, [f"x{i}" for i in range(4)], "label")
    return s.select("elastic_net", "step", "reg_param", F.round("r2", 6).alias("r2"))


FIT_SCHEMA = T.StructType([
    T.StructField("elastic_net", T.DoubleType()), T.StructField("reg_param", T.DoubleType()),
    T.StructField("coefficient", T.DoubleType()), T.StructField("intercept", T.DoubleType()),
    T.StructField("r2", T.DoubleType())])

ONE_FIT = (0.13, 0.5)  # (elastic net, lambda) of the single-fit query


def _ml_fit_frame(spark: SparkSession, sf_dir: str, alpha: float, lam: float) -> DataFrame:
    model = RG.fit_linear(regression_frame(spark, sf_dir), [REG_X], REG_Y, lam, alpha)
    row = (alpha, lam, round(float(model.coefficients[0]), 6), round(float(model.intercept), 6),
           round(float(model.summary.r2), 8))
    return result_rows(spark, [row], FIT_SCHEMA)


@query("linear_regression", "WITH " + MOMENTS_SQL + f""",
fit AS (SELECT *, {_fit_sql(f"{ONE_FIT[0]}::DOUBLE", f"{ONE_FIT[1]}::DOUBLE")} AS b FROM m)
SELECT {ONE_FIT[0]}::DOUBLE AS elastic_net, {ONE_FIT[1]}::DOUBLE AS reg_param,
       round(b, 6) + 0.0 AS coefficient, round(my - b * mx, 6) + 0.0 AS intercept,
       round({R2_SQL}, 8) + 0.0 AS r2 FROM fit""")
def q_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``LinearRegression`` (maxIter 10) fitted once; the oracle is the
    closed form."""
    return _ml_fit_frame(spark, sf_dir, *ONE_FIT)


@query("regression_r2", "WITH " + MOMENTS_SQL + f""",
fit AS (SELECT *, cxy / vx AS b FROM m)
SELECT round({R2_SQL}, 8) + 0.0 AS r2 FROM fit""")
def q_regression_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training R^2 of the unregularised fit (``LinearRegression``)."""
    return _ml_fit_frame(spark, sf_dir, 0.0, 0.0).select("r2")
