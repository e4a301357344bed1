import pytest
from pyspark.sql import functions as F

from lodestone.functions import columns as C


def test_drop_lenient_and_strict(spark):
    df = spark.createDataFrame([(1, 2, "a")], "Id int, id2 int, Species string")
    assert C.drop_cols(df, "extra", "Id").columns == ["id2", "Species"]
    with pytest.raises(KeyError):
        C.drop_strict(df, "extra")
    with pytest.raises(KeyError):
        C.drop_strict(df, "id")  # case matters
    assert C.drop_strict(df, "Id").columns == ["id2", "Species"]


def test_conform_adds_missing_and_drops_extra(spark):
    df = spark.createDataFrame([("x", 1.0, 7)], "_id string, a double, extra int")
    out = C.conform(df, [("a", "double"), ("b", "double"), ("Species", "string")])
    assert out.columns == ["a", "b", "Species"]
    r = out.first()
    assert r["a"] == 1.0 and r["b"] is None and r["Species"] is None


def test_strip_ws_like_python(spark):
    vals = ["  a/b \t", "\n\x0bc ", "d", "\x1ce\x85"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(C.strip_ws(F.col("v"))).collect()]
    assert got == [v.strip() for v in vals]


def test_format_metric_matches_python(spark):
    vals = [0.03125, 0.00015, 0.96666666, 1.0, 0.0, 0.12345, 2.5e-05]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(C.format_metric(F.col("v"))).collect()]
    assert got == [f"{v:.4f}" for v in vals]


def test_decode_label(spark):
    df = spark.createDataFrame([(0,), (2,), (-1,), (5,)], "code int")
    got = [r[0] for r in df.select(C.decode_label(F.col("code"), ["setosa", "versicolor", "virginica"])).collect()]
    assert got == ["setosa", "virginica", None, None]


def test_value_pipeline_doubles(spark):
    from lodestone.plans.etl import value_pipeline
    df = spark.createDataFrame([(42,)], "value long")
    assert value_pipeline(df).first()["value"] == 84


def test_scale_and_split_xy(spark):
    df = spark.createDataFrame([(1, 2.0, 0)], "k int, x double, target int")
    x, y = C.split_xy(df, "target", key="k")
    assert x.columns == ["k", "x"] and y.columns == ["k", "target"]
    assert C.scale(df, "x", 3).first()["x"] == 6.0
