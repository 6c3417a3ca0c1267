"""Feature preparation, PCA, regression closed form and sources."""

import math

import pytest
from pyspark.ml.feature import MinMaxScaler, PCA
from pyspark.sql import functions as F

from quarry.operators import features as FE
from quarry.operators import reduce as RD
from quarry.operators import regression as RG
from quarry.sources import delimited as DL
from tests.conftest import SF001, SF01


def test_kernel_expand_order(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    r = FE.kernel_expand(df, ["a", "b"]).first()
    assert list(r) == pytest.approx([2 / math.sqrt(3), 4.0, 8.0, 3 / math.sqrt(3), 9.0, 27.0])


def test_min_max_constant_column_is_zero_not_half(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, c double")
    out = FE.min_max_normalize(df, ["a", "c"]).collect()
    assert [r["a"] for r in out] == [0.0, 1.0, 0.5]
    assert [r["c"] for r in out] == [0.0, 0.0, 0.0]
    # Spark's MinMaxScaler gives 0.5 for the constant column
    vec = FE.assemble(df.withColumn("label", F.lit(0.0)), ["a", "c"])
    scaled = MinMaxScaler(inputCol="features", outputCol="s").fit(vec).transform(vec)
    assert scaled.first()["s"][1] == 0.5


def test_mean_center(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "a double")
    assert [r["a"] for r in FE.mean_center(df, ["a"]).collect()] == [-2.0, -1.0, 3.0]


def test_hash_split_deterministic_and_partition_invariant(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    key = FE.row_key(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], salt=14)

    def sides(df):
        return sorted(tuple(r) for r in df.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            FE.split_column(key, (60, 40), ("train", "test")).alias("s")).collect())

    a = sides(li.coalesce(1))
    assert a == sides(li.repartition(5))
    share = sum(1 for r in a if r[-1] == "train") / len(a)
    assert 0.55 < share < 0.65
    parts = FE.hash_split(li, (80, 10, 10), key)
    assert sum(p.count() for p in parts) == li.count()


def test_small_shares_get_their_rows(spark):
    a, b = FE.hash_split(spark.range(100_000), (0.997, 0.003), FE.row_key(["id"]))
    assert a.count() + b.count() == 100_000 and 200 < b.count() < 400


def test_exploded_pairs_equal_filtered_pairs(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,), (None,)], "label double")
    pairs = [("01", (0.0, 1.0)), ("12", (1.0, 2.0))]
    got = sorted(map(tuple, FE.explode_pairs(df, pairs).select("pair", "label").collect()))
    assert got == sorted((n, r[0]) for n, k in pairs for r in FE.class_pair_subset(df, k).collect())


def test_class_pairs_and_relabel(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,)], "label double")
    sub = FE.class_pair_subset(df, (1.0, 2.0))
    assert sorted(r["label"] for r in FE.relabel_pair(sub, 1.0).collect()) == [0.0, 0.0, 1.0]
    assert sorted(r["label"] for r in FE.relabel_pair(
        FE.class_pair_subset(df, (0.0, 2.0)), 2.0).collect()) == [0.0, 1.0, 1.0]


def test_assemble_nulls_and_text_become_zero(spark):
    df = spark.createDataFrame([(1.0, None, "x", 2, True)],
                               "y double, a double, s string, i int, b boolean")
    r = FE.assemble_features(df, "y").first()
    assert r["label"] == 1.0 and list(r["features"]) == [0.0, 0.0, 2.0, 1.0]


def test_pca_closed_form_matches_ml_pca(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    comps, ratio = RD.principal_components(li, ["l_quantity", "l_discount"], k=1)
    vec = FE.assemble(li.select(F.col("l_quantity").cast("double"), "l_discount",
                                F.lit(0.0).alias("label")), ["l_quantity", "l_discount"])
    model = PCA(k=1, inputCol="features", outputCol="p").fit(vec)
    ml = list(model.pc.toArray()[:, 0])
    if abs(ml[0]) < abs(ml[1]):
        ml = ml if ml[1] > 0 else [-x for x in ml]
    else:
        ml = ml if ml[0] > 0 else [-x for x in ml]
    assert comps[0] == pytest.approx(ml, abs=1e-9)
    assert ratio[0] == pytest.approx(float(model.explainedVariance[0]), abs=1e-9)


def test_pca_general_path_on_embeddings(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    cols = [f"x{i}" for i in range(8)]
    wide = emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c)
                                  for i, c in enumerate(cols)])
    out = RD.pca_project(wide, cols, k=2, keep=("vec_id",))
    assert out.columns == ["vec_id", "pc1", "pc2"] and out.count() == emb.count()
    # projections of centred data have mean 0
    m = out.agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1]) < 1e-9


def test_pca_of_vectors_equals_pca_of_columns(spark):
    from pyspark.ml.functions import array_to_vector
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").select(
        "vec_id", F.transform(F.slice("embedding", 1, 6), lambda x: x.cast("double")).alias("a"))
    wide = emb.select("vec_id", *[F.col("a")[i].alias(f"x{i}") for i in range(6)])
    want = {r.vec_id: (r.pc1, r.pc2) for r in RD.pca_project(
        wide, [f"x{i}" for i in range(6)], k=2, keep=("vec_id",)).collect()}
    vec = emb.select("vec_id", array_to_vector("a").alias("v"))
    for r in RD.pca_project_vectors(vec, "v", k=2, keep=("vec_id",)).collect():
        assert (r.pc1, r.pc2) == pytest.approx(want[r.vec_id], abs=1e-9)


def test_lambda_grid_is_an_accumulated_sum():
    g = RG.lambda_grid()
    assert len(g) == 101 and g[0] == 0.0 and g[-1] == pytest.approx(9.99999999999998, abs=1e-15)
    assert g[-1] != 10.0


@pytest.mark.parametrize("alpha,lam", [(0.0, 0.0), (0.0, 2.5), (0.13, 0.5), (1.0, 0.3),
                                       (1.0, 9.0)])
def test_closed_form_matches_linear_regression(spark, alpha, lam):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    df = li.select(F.col("l_quantity").alias("x"),
                   (F.col("l_quantity") / 10.0 + F.col("l_extendedprice") / 10000.0).alias("y"))
    cf = RG.linear_regression_1d(df, "x", "y", lam, alpha).first()
    model = RG.fit_linear(df, ["x"], "y", lam, alpha)
    assert cf["r2"] == pytest.approx(model.summary.r2, abs=1e-9)
    assert cf["coefficient"] == pytest.approx(model.coefficients[0], abs=1e-7)
    assert cf["intercept"] == pytest.approx(model.intercept, abs=1e-6)


def test_sweep_ml_path_small_grid(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    df = li.select("l_quantity", "l_discount",
                   (F.col("l_quantity") / 10.0 + F.col("l_extendedprice") / 10000.0).alias("y"))
    out = RG.lambda_sweep_ml(spark, df, ["l_quantity", "l_discount"], "y", alphas=(0.0, 1.0),
                             lambdas=(0.0, 1.0)).collect()
    assert len(out) == 4 and all(0.0 <= r["r2"] <= 1.0 for r in out)


def test_delimited_parsers(spark):
    lines = spark.createDataFrame([("1.5,2,3",), ("0,0,7",)], "line string")
    pts = DL.parse_last_label(lines, 2).collect()
    assert [tuple(r) for r in pts] == [(2.0, 1.5, 2.0), (6.0, 0.0, 0.0)]
    named = spark.createDataFrame([("5.1,3.5,1.4,0.2,Iris-setosa",), ("6,3,4,1,Iris-virginica",),
                                   ("",), ("1,2,3,4,Iris-unknown",)], "line string")
    got = [r["label"] for r in DL.parse_text_label(named, 4).collect()]
    assert got == [0.0, 2.0, None, None]
    vec = DL.fields_vector(lines).first()
    assert vec["label"] == 3.0 and list(vec["features"]) == [1.5, 2.0]
