"""Partial-dependence curves of a forest from leaf counts.

The curve of feature f at x is the mean over all rows of the forest's class
probabilities with f set to x.  In a tree, a row with f set to x ends in the one
leaf whose conditions on other features the row meets and whose interval of f,
along its path, holds x.  So all a curve needs of the rows is, per tree, feature
and leaf, *how many rows meet the leaf's conditions on the other features*:

    pd(f, x) = 1 / (n T) * sum over trees and leaves of
               count(tree, f, leaf) * p(leaf) * [low(leaf, f) < x <= high(leaf, f)]

The counts come from one pass over the rows, whatever the number of grid
points, and each task sends one number per (tree, feature, leaf).  The result
is exact: rows x points are never formed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.explain import DEFAULT_POINTS, feature_ranges, grid_points
from lodestone.session import scratch_path


@dataclass
class Tree:
    """Nodes by number; leaves have feature -1."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prob: np.ndarray   # per node the class shares of its training rows

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.feature < 0)

    def used(self) -> list[int]:
        return sorted(set(self.feature[self.feature >= 0].tolist()))

    def order(self) -> list[int]:
        """Parents before their children."""
        out = [0]
        for n in out:
            if self.feature[n] >= 0:
                out += [int(self.left[n]), int(self.right[n])]
        return out

    def reach(self, x: np.ndarray, free: int) -> np.ndarray:
        """Per leaf, the number of rows that meet its conditions on all
        features but ``free`` (-1: on all)."""
        at = {0: np.ones(len(x), bool)}
        for n in self.order():
            f = int(self.feature[n])
            if f < 0:
                continue
            mine = at[n]
            if f == free:
                at[int(self.left[n])] = at[int(self.right[n])] = mine
            else:
                go = x[:, f] <= self.threshold[n]  # NaN goes right, as in the forest
                at[int(self.left[n])], at[int(self.right[n])] = mine & go, mine & ~go
        return np.array([np.count_nonzero(at[int(n)]) for n in self.leaves], np.int64)

    def intervals(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) of feature ``f`` on the path to each leaf: low < x <= high."""
        low, high = np.full(len(self.feature), -np.inf), np.full(len(self.feature), np.inf)
        for n in self.order():
            if self.feature[n] < 0:
                continue
            a, b, cut = int(self.left[n]), int(self.right[n]), self.threshold[n]
            for c in (a, b):
                low[c], high[c] = low[n], high[n]
            if self.feature[n] == f:
                high[a], low[b] = min(high[n], cut), max(low[n], cut)
        return low[self.leaves], high[self.leaves]


def forest_trees(spark: SparkSession, forest) -> list[Tree]:
    """The trees of a fitted MLlib forest, from its saved form (as many rows as
    the model has nodes).  Splits on categories are not supported."""
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    nodes = (spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect())
    by: dict[int, list] = {}
    for r in nodes:
        if r["split"]["numCategories"] != -1:
            raise ValueError("the forest splits on categories")
        by.setdefault(r["treeID"], []).append(r)
    out = []
    for t in sorted(by):
        rows = by[t]
        stats = np.array([r["impurityStats"] for r in rows], float)
        out.append(Tree(np.array([r["split"]["featureIndex"] for r in rows]),
                        np.array([(r["split"]["leftCategoriesOrThreshold"] or [0.0])[0] for r in rows], float),
                        np.array([r["leftChild"] for r in rows]), np.array([r["rightChild"] for r in rows]),
                        stats / np.maximum(stats.sum(axis=1, keepdims=True), 1e-300)))
    return out


def leaf_counts(df: DataFrame, trees: list[Tree], features: list[str]) -> DataFrame:
    """(tree, feature, leaf, n): rows that reach a leaf with the feature free;
    feature -1 for those that the tree does not ask."""
    shared = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        trees = shared.value
        total = None
        keys = [(t, f) for t, tree in enumerate(trees) for f in [-1, *tree.used()]]
        for b in batches:
            if any(c.null_count for c in b.columns):
                raise ValueError("a feature is null")
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            got = [trees[t].reach(x, f) for t, f in keys]
            total = got if total is None else [a + c for a, c in zip(total, got)]
        if total is not None:
            size = [len(c) for c in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([t for t, _ in keys], size).astype(np.int32)), pa.array(np.repeat([f for _, f in keys], size).astype(np.int32)),
                 pa.array(np.concatenate([np.arange(s) for s in size]).astype(np.int32)), pa.array(np.concatenate(total))],
                names=["tree", "feature", "leaf", "n"])
    x = df.select(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    return (x.mapInArrow(run, "tree int, feature int, leaf int, n long").groupBy("tree", "feature", "leaf").agg(F.sum("n").alias("n")))


def curves(df: DataFrame, model, features: list[str], points: int = DEFAULT_POINTS, ranges: dict | None = None) -> DataFrame:
    """(feature, grid_index, x, class, pd) of a fitted pipeline whose last
    stage is a forest over ``features``, or of a list of trees: as
    ``explain.partial_dependence``."""
    spark = df.sparkSession
    schema = "feature string, grid_index int, x double, class int, pd double"
    ranges = ranges or feature_ranges(df, features)
    trees = model if isinstance(model, list) else forest_trees(spark, model.stages[-1])
    count = {(r["tree"], r["feature"], r["leaf"]): r["n"] for r in leaf_counts(df, trees, features).collect()}  # model-sized
    n = sum(count.get((0, -1, k), 0) for k in range(len(trees[0].leaves)))
    rows = []
    for i, f in enumerate(features):
        xs = np.array(grid_points(*ranges[f], points), float)
        if not len(xs) or not n:
            continue
        # a leaf adds its share between two places of the ascending grid
        step = np.zeros((len(xs) + 1, trees[0].prob.shape[1]))
        for t, tree in enumerate(trees):
            own = i if i in tree.used() else -1
            low, high = tree.intervals(i)
            for k, leaf in enumerate(tree.leaves.tolist()):
                share = count.get((t, own, k), 0) / (n * len(trees)) * tree.prob[leaf]
                a, b = np.searchsorted(xs, [low[k], high[k]], side="right")
                step[a] += share
                step[b] -= share
        pd = np.cumsum(step, axis=0)[:-1]
        rows += [(f, j, float(xs[j]), c, float(pd[j, c])) for j in range(len(xs)) for c in range(pd.shape[1])]
    return spark.createDataFrame(rows, schema)


def is_plain_forest(model) -> bool:
    """Whether a fitted pipeline ends in a classification forest."""
    from pyspark.ml.classification import RandomForestClassificationModel
    return bool(getattr(model, "stages", None)) and isinstance(model.stages[-1], RandomForestClassificationModel)
