"""Partial dependence invariants."""
import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from lodestone.operators import explain as X
from lodestone.session import read_table


def _scorer(df):
    e0 = F.exp(F.col("a"))
    e1 = F.exp(F.lit(0.5) * F.col("a"))
    return df.withColumn("p0", e0 / (e0 + e1)).withColumn("p1", e1 / (e0 + e1))


def test_unused_feature_is_flat_and_probabilities_sum_to_one(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select(F.col("l_quantity").alias("a"), F.col("l_tax").alias("b"))
    curve = X.partial_dependence(li, ["a", "b"], _scorer, ["p0", "p1"], points=7).collect()
    flat = {}
    for r in curve:
        if r.feature == "b":
            flat.setdefault(r["class"], set()).add(round(r.pd, 9))
    assert all(len(v) == 1 for v in flat.values())
    tot = {}
    for r in curve:
        tot[(r.feature, r.grid_index)] = tot.get((r.feature, r.grid_index), 0) + r.pd
    assert all(v == pytest.approx(1.0) for v in tot.values())
    assert len(curve) == 2 * 7 * 2


def test_grid_and_clip(spark):
    df = spark.createDataFrame([(0.0,), (9.0,)], "a double")
    g = X.pdp_grid(df, ["a"], points=4).collect()
    assert [r.x for r in g] == [0.0, 3.0, 6.0, 9.0]
    c = spark.createDataFrame([(-0.5,), (0.1,), (0.4,)], "pd double")
    assert X.clip_curve(c).count() == 2


def test_centred_curve_has_zero_mean(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select(F.col("l_quantity").alias("a"))
    curve = X.partial_dependence(li, ["a"], _scorer, ["p0", "p1"], points=5, centre=True)
    for r in curve.groupBy("class").agg(F.avg("pd").alias("m")).collect():
        assert abs(r.m) < 1e-12


def test_features_without_values_have_no_curve(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = X.partial_dependence(df, ["a", "b"], _scorer, ["p0", "p1"], points=3).collect()
    assert {r.feature for r in got} == {"a"} and len(got) == 6
    assert X.partial_dependence(df.limit(0), ["a"], _scorer, ["p0", "p1"], points=3).count() == 0
    assert X.pdp_grid(df, ["a", "b"], points=3).count() == 3


def test_python_model_reads_each_row_once_per_curve(spark):
    """The worker gets rows, not rows x points, and the curves are those of
    scoring every row at every point (nulls, NaN results, unused columns)."""
    from lodestone.operators.training import pandas_scorer
    rows = [(None if i % 7 == 0 else i % 5, None if i % 11 == 0 else i / 100, str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b double, other string").repartition(4)
    sent = spark.sparkContext.accumulator(0)

    def predict(model, X):
        import numpy as np
        sent.add(len(X))
        a, b = X["a"].to_numpy(), X["b"].to_numpy()
        e = np.stack([np.exp(a * model), np.exp(0.5 * a - b), np.where(a > 3, np.nan, 1.0)], axis=1)
        X["a"] = 0.0  # a model may change its input
        return e / e[:, :2].sum(axis=1, keepdims=True)
    scorer = pandas_scorer(predict, ["a", "b"], 3, load=lambda: 0.3)
    cols = ["p0", "p1", "p2"]
    key = lambda r: (r.feature, r.grid_index, r["class"])
    plan = X.partial_dependence(df, ["a", "b"], scorer, cols, points=6)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" not in text and "ArrowEvalPython" not in text
    got = {key(r): r for r in plan.collect()}
    assert sent.value == 300 * 12
    want = {key(r): r for r in X.partial_dependence(df, ["a", "b"], lambda d: scorer(d), cols, points=6).collect()}
    assert got.keys() == want.keys() and len(got) == 36
    for k, r in want.items():
        assert got[k].x == r.x and (got[k].pd is None if r.pd is None else got[k].pd == pytest.approx(r.pd, abs=1e-12))
    none = df.select("a", F.lit(None).cast("double").alias("b"), "other")
    assert X.partial_dependence(none, ["a", "b"], scorer, cols, points=6).count() == 18
    two = X.partial_dependence(df, ["b"], scorer, ["p1", "p0"], points=6).collect()
    assert all(r.pd == pytest.approx(got["b", r.grid_index, 1 - r["class"]].pd) for r in two)
