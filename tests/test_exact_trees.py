"""Exact trees against a brute-force search of every split."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import exact_trees as X, explain, forest_curves

FEATURES = ["a", "b", "c"]


def table(n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.choice([None, math.nan, *range(30)]) if i % 9 == 0 else rnd.random() * 10, float(rnd.randrange(4)), rnd.gauss(0, 1)
        a = float(a) if a is not None else None
        hot = 2.5 if i % 3 == 0 else b  # a value that a third of all rows hold
        rows.append((i, a, hot, c, int((0 if a is None or math.isnan(a) else a) + c > 5) + int(b > 2)))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "k long, a double, b double, c double, y int").repartition(parts)


def arrays(rows):
    x = np.array([[math.nan if v is None else v for v in r[1:4]] for r in rows])
    return x, np.array([r[4] for r in rows])


def brute(x, y, k, depth):
    """The same tree by trying every threshold of every feature on the rows of a node."""
    total = np.bincount(y, minlength=k)
    if depth == 0 or np.count_nonzero(total) < 2:
        return total.tolist()
    best = None
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])  # NaN once, last
        for lo, hi in zip(v, v[1:]):
            t = X.middle(float(lo), float(hi))
            left = np.bincount(y[x[:, f] <= t], minlength=k)
            gain = (float(X.gini_score(left, total)) - (total.astype(float) ** 2).sum() / total.sum()) / total.sum()
            if gain > X.LEAST_GAIN and (best is None or gain > best[0]):
                best = (gain, f, t)
    if best is None:
        return total.tolist()
    _, f, t = best
    go = x[:, f] <= t
    return [f, t, brute(x[go], y[go], k, depth - 1), brute(x[~go], y[~go], k, depth - 1)]


def nested(tree, n=0, counts=None):
    if tree.feature[n] < 0:
        return tree.prob[n].tolist()
    return [int(tree.feature[n]), float(tree.threshold[n]), nested(tree, int(tree.left[n])), nested(tree, int(tree.right[n]))]


def shares(b):
    return [b[0], b[1], shares(b[2]), shares(b[3])] if len(b) == 4 and isinstance(b[2], list) else (np.array(b) / max(sum(b), 1)).tolist()


@pytest.mark.parametrize("file_rows,parts", [(X.FILE_ROWS, 3), (70, 5)])  # 70: files end among equal values
def test_every_split_equals_the_brute_force_search(spark, file_rows, parts):
    rows = table()
    (tree,) = X.fit_exact(frame(spark, rows, parts), FEATURES, "y", "k", 3, max_depth=4, file_rows=file_rows)
    assert nested(tree) == shares(brute(*arrays(rows), 3, 4)) and len(tree.feature) > 12


def test_scorer_and_curves(spark):
    rows = [r for r in table() if r[1] is not None and not math.isnan(r[1])]
    df = frame(spark, rows)
    trees = X.fit_exact(df, FEATURES, "y", "k", 3, trees=4, max_depth=3)
    x, y = arrays(rows)
    want = np.mean([t.prob[X.where_rows_are([X.Node(None, 0, 0, feature=int(f), threshold=float(c), left=int(a), right=int(b))
                                             for f, c, a, b in zip(t.feature, t.threshold, t.left, t.right)], x)] for t in trees], axis=0)
    got = {r["k"]: [r["p0"], r["p1"], r["p2"]] for r in X.tree_scorer(trees, FEATURES)(df).collect()}
    assert np.abs(np.array([got[r[0]] for r in rows]) - want).max() < 1e-12
    assert (want.argmax(axis=1) == y).mean() > 0.8
    plain = explain.partial_dependence(df.select(*FEATURES), FEATURES, X.tree_scorer(trees, FEATURES), ["p0", "p1", "p2"], 12)
    fast = {(r["feature"], r["grid_index"], r["class"]): r["pd"] for r in forest_curves.curves(df, trees, FEATURES, 12).collect()}
    assert all(abs(fast[r["feature"], r["grid_index"], r["class"]] - r["pd"]) < 1e-9 for r in plain.collect())


def test_a_forest_does_not_depend_on_the_layout(spark):
    rows = table(200)
    a, b = (X.fit_exact(frame(spark, rows, p), FEATURES, "y", "k", 3, trees=3, max_depth=3, file_rows=f) for p, f in ((1, 1000), (6, 50)))
    assert [nested(t) for t in a] == [nested(t) for t in b] and len({str(nested(t)) for t in a}) > 1
    w = X.poisson_weights(np.arange(20000), 1, 42)
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05


def test_edges(spark):
    df = frame(spark, table(50))
    assert X.fit_exact(df.limit(0), FEATURES, "y", "k", 3)[0].prob.tolist() == [[1 / 3] * 3]
    (one,) = X.fit_exact(df.withColumn("y", F.lit(1)), FEATURES, "y", "k", 3)
    assert one.feature.tolist() == [-1] and one.prob.tolist() == [[0, 1, 0]]
    (none,) = X.fit_exact(df.withColumn("y", F.when(F.col("k") % 2 == 0, -1)), FEATURES, "y", "k", 3)
    assert len(none.feature) == 1
    assert X.middle(1.0, np.nextafter(1.0, 2)) == 1.0 and X.middle(3.0, math.nan) == 3.0 and X.middle(1.0, 2.0) == 1.5


def test_a_list_is_sent_by_tasks_of_its_own(spark):
    """A task that sends holds a split's rows once, not once per feature, and no
    feature vectors where only the roots are split."""
    rows = [(i, i % 3, float(i % 7), None if i % 5 == 0 else i / 3, 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double, c double").repartition(2)
    held = X.attribute_lists(df, ["a", "b", "c"], "y", "k", 150, False)
    assert held.columns == ["part", "f", "v", "y", "row"] and held.count() == 1200
    text = X.attribute_lists(df, ["a", "b", "c"], "y", "k", 150)
    assert [r[0] for r in text.groupBy("f").count().orderBy("f").select("count").collect()] == [400] * 3
    assert all(len(r.x) == 3 and (r.x[r.f] == r.v or r.v != r.v) for r in text.collect())
    one = X.fit_exact(df, ["a", "b", "c"], "y", "k", 3, max_depth=1, file_rows=150)[0]
    deep = X.fit_exact(df, ["a", "b", "c"], "y", "k", 3, max_depth=2, file_rows=150)[0]
    assert (one.feature[0], one.threshold[0]) == (deep.feature[0], deep.threshold[0])
    assert one.prob[0].tolist() == deep.prob[0].tolist()
