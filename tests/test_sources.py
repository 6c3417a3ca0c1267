"""Source round trips, labelled lines, derived files."""

import uuid

import pytest
from pyspark.sql import functions as F

from quarry.session import shared_dir
from quarry.sources import delimited as DL
from quarry.sources import files as FS
from quarry.sources.text import read_text_lines


def _folder(spark, name):
    return shared_dir(spark, "test-sources", f"{name}-{uuid.uuid4().hex}")


def test_csv_round_trip_with_schema_and_inference(spark):
    df = spark.createDataFrame([(1, "a b", None, 2.5), (2, None, 3.0, None)],
                               "id long, s string, x double, y double")
    path = FS.write_csv(df, _folder(spark, "csv"))
    back = FS.read_csv(spark, path, schema="id long, s string, x double, y double")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    inferred = FS.read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["x"] == "double"


def test_libsvm_round_trip(spark):
    df = spark.createDataFrame([(1.5, 2.0, 0.0), (0.25, 0.0, 7.0)], "y double, a double, b double")
    path = FS.write_lines(df, FS.libsvm_line(F.col("y"), [F.col("a"), F.col("b")]),
                          _folder(spark, "libsvm"))
    back = FS.read_libsvm(spark, path, num_features=2)
    rows = sorted((r["label"], tuple(r["features"].toArray())) for r in back.collect())
    assert rows == [(0.25, (0.0, 7.0)), (1.5, (2.0, 0.0))]


def test_text_file_lines(spark):
    df = spark.createDataFrame([("x y",), ("",), (" z",)], "value string")
    path = _folder(spark, "text")
    df.coalesce(1).write.text(path)
    assert [r["line"] for r in read_text_lines(spark, path).collect()] == ["x y", "", " z"]


def test_matrix_vectors_and_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 4.0])], "id long, m array<float>")
    vec = FS.matrix_vectors(df, "m", keep=("id",))
    cols = FS.vector_columns(vec, "features", 2, keep=("id",)).orderBy("id").collect()
    assert [tuple(r) for r in cols] == [(1, 1.0, 2.0), (2, 3.0, 4.0)]


def _lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "line string")


def test_labelled_lines_separator_and_trailing_fields(spark):
    df = DL.parse_last_label(_lines(spark, "1|2|3"), 2, sep="|")
    assert [tuple(r) for r in df.collect()] == [(2.0, 1.0, 2.0)]
    df = DL.parse_last_label(_lines(spark, "1,2,3,"), 2)
    assert [tuple(r) for r in df.collect()] == [(2.0, 1.0, 2.0)]
    df = DL.parse_text_label(_lines(spark, "1,2,3,4,Iris-setosa,", "1,2,3,4,other", "1,2"), 4)
    assert [tuple(r) for r in df.collect()] == [
        (0.0, 1.0, 2.0, 3.0, 4.0), (None, 1.0, 2.0, 3.0, 4.0), (None,) * 5]


@pytest.mark.parametrize("line", ["1,2,3,4,5", "1,2", "x,2,3", ""])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_lines_fail_whatever_the_session_says(spark, line, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="expected 3 fields|not a number"):
            DL.parse_last_label(_lines(spark, line), 2).collect()
        lenient = DL.parse_last_label(_lines(spark, line), 2, strict=False).collect()
        assert lenient[0][1] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_derived_files_are_written_once_per_table_version(spark, tmp_path):
    from quarry.plans.fixtures import derived
    spark.range(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    calls = []

    def write(path):
        calls.append(path)
        spark.range(5).write.parquet(path)

    first = derived(spark, "t", str(tmp_path), write)
    assert derived(spark, "t", str(tmp_path), write) == first and len(calls) == 1
    spark.range(4).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert derived(spark, "t", str(tmp_path), write) != first and len(calls) == 2
