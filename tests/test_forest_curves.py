"""Forest curves from leaf counts equal the curves by scoring rows x points."""
import random
import time

import numpy as np
import pytest

from lodestone.operators import explain, forest_curves as C, training


@pytest.fixture(scope="module")
def fitted(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(1500):
        a, b, c = rnd.random(), float(rnd.randrange(6)), rnd.gauss(0, 1)
        rows.append((i, a, b, c, 1.0, int(a + 0.2 * b + 0.1 * c > 1) + int(b > 4)))
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, flat double, y int").repartition(4).cache()
    return df, training.fit_forest(df, ["a", "b", "c", "flat"], "y", 12, 5, 7, n_classes=3, key="k")


FEATURES = ["a", "b", "c", "flat"]


def keyed(df):
    return {(r["feature"], r["grid_index"], r["class"]): (r["x"], r["pd"]) for r in df.collect()}


@pytest.mark.parametrize("points", [1, 2, 30, 200])
def test_equal_to_scoring_every_point(spark, fitted, points):
    df, model = fitted
    plain = keyed(explain.partial_dependence(df.select(*FEATURES), FEATURES, explain.model_scorer(model, FEATURES, 3), ["p0", "p1", "p2"], points))
    fast = keyed(C.curves(df, model, FEATURES, points))
    assert plain.keys() == fast.keys()
    for k, (x, pd) in plain.items():
        assert fast[k][0] == x and abs(fast[k][1] - pd) < 1e-9


def test_every_row_is_in_one_leaf_of_a_free_feature_at_every_point(spark, fitted):
    df, model = fitted
    trees = C.forest_trees(spark, model.stages[-1])
    x = np.array(df.select(*FEATURES).collect(), float)
    for t in trees:
        assert t.reach(x, -1).sum() == len(x)
        for f in t.used():
            low, high = t.intervals(f)
            n = t.reach(x, f)
            for v in np.unique(x[:, f])[:20]:
                assert n[(low < v) & (v <= high)].sum() == len(x)


def test_points_cost_next_to_nothing(spark, fitted):
    df, model = fitted
    took = {}
    for points in (30, 30, 1000):
        t = time.time()
        C.curves(df, model, FEATURES, points).count()
        took[points] = time.time() - t
    assert took[1000] < 3 * took[30] + 2


def test_empty_rows_and_null_features(spark, fitted):
    df, model = fitted
    assert C.curves(df.limit(0), model, FEATURES).count() == 0
    with pytest.raises(Exception, match="null"):
        C.curves(df.limit(1).selectExpr("k", "cast(null as double) as a", "b", "c", "flat"), model, FEATURES, ranges={f: (0.0, 1.0) for f in FEATURES}).count()
