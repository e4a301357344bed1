"""Decision trees with exact splits, grown level by level (H5).

MLlib looks for a split among at most ``maxBins`` values of a feature.  Here
every place between two neighbouring values is tried.  The rows are written
once per feature in the order of its values (an *attribute list*: value, label
and, below the roots, the row's whole feature vector), range-partitioned into files of bounded
size.  A level of all trees is two scans of the lists, without a shuffle of rows:

1. each file counts the classes of every open node it holds (a row's node
   follows from its features and the tree so far); running sums of these small
   counts over the files say what stands left of each file;
2. each file walks its values in order with the counts left of them, and keeps
   per node the split that lowers the Gini impurity most; an aggregate takes the
   best of all files and features.

Ties take the smaller feature number, then the smaller threshold.  A threshold
is the middle of its neighbours, and a row goes left at ``x <= threshold``.  The
files may end among equal values; a place is a split only if the next value,
wherever it is stored, is another.

A forest draws for every tree a weight per row (Poisson, from a hash of the
row's key) and for every node a subset of the features (from a hash of its
path), so the same rows and seed give the same forest in any layout.

Defined results: null features count as NaN, NaN is greater than all numbers
and goes right; rows whose label is null or below 0 are left out; no rows give
one leaf with equal shares.  What comes to the driver are counts per (file, open node), and
the trees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.forest_curves import Tree
from lodestone.session import materialize

#: Rows of one file of the attribute lists (one Parquet row group, so one task).
FILE_ROWS = 250_000
#: A split must lower the impurity by more than this.
LEAST_GAIN = 1e-12


@dataclass
class Node:
    """A node while it grows: ``feature`` -1 is a leaf so far."""
    counts: np.ndarray
    depth: int
    path: int
    open: bool = True
    feature: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1
    gain: float = 0.0


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of numbers."""
    x = np.asarray(x).astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mul)
    return x ^ (x >> np.uint64(31))


def poisson_weights(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson with mean 1."""
    u = mixed(key, seed * 1_000_003 + tree + 1).astype(float) / 2.0 ** 64
    edges = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(edges, u, side="right")


def node_features(path: int, tree: int, seed: int, n: int, take: int) -> list[int]:
    """The features that a node may split on."""
    h = mixed(np.arange(n) + path * 1009, seed * 7919 + tree)
    return sorted(np.argsort(h, kind="stable")[:take].tolist())


def where_rows_are(nodes: list[Node], x: np.ndarray) -> np.ndarray:
    """The node of each row."""
    at = np.zeros(len(x), np.int64)
    for i, n in enumerate(nodes):  # children have larger numbers
        if n.feature >= 0:
            mine = at == i
            at[mine] = np.where(x[mine, n.feature] <= n.threshold, n.left, n.right)
    return at


def attribute_lists(df: DataFrame, features: list[str], label: str, key: str, file_rows: int = FILE_ROWS, vectors: bool = True) -> DataFrame:
    """(part, f, v, y, row, x): a row per row and feature, in the order of the
    feature's values, stored.  The rows are stored first, a column per feature, and
    each feature's list is sent by scans of its own, so a task that sends holds
    one list's part of its split, not all of them.  Without ``vectors`` (only the
    roots are split, so no row's node is asked) ``x`` is left out."""
    vec = [F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, f in enumerate(features)]
    rows = materialize(df.where(F.col(label) >= 0).select(F.xxhash64(key).alias("row"), F.col(label).cast("int").alias("y"), *vec))
    x = [F.array(*[f"x{i}" for i in range(len(features))]).alias("x")] if vectors else []
    lists = [rows.select(F.lit(i).alias("f"), F.col(f"x{i}").alias("v"), "y", "row", *x) for i in range(len(features))]
    files = max(1, -(-rows.count() * len(features) // file_rows))
    order = ["f", "v", "row", "y"]
    return materialize(reduce(DataFrame.unionAll, lists).repartitionByRange(files, *order).sortWithinPartitions(*order)
                       .withColumn("part", F.spark_partition_id()).select("part", "f", "v", "y", "row", *["x"][:len(x)]))


def _parts(batches):
    """The rows of each file, as one table."""
    held, part = [], None
    for b in batches:
        p = b.column(0).to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(p)) + 1).tolist(), len(p)]
        for a, z in zip(cut, cut[1:]):
            if z > a:
                if part is not None and p[a] != part:
                    yield part, pa.Table.from_batches(held)
                    held = []
                part = int(p[a])
                held.append(b.slice(a, z - a))
    if held:
        yield part, pa.Table.from_batches(held)


def _columns(table: pa.Table, n_features: int):
    f, v, y, row = (table.column(c).to_numpy() for c in ("f", "v", "y", "row"))
    if "x" not in table.column_names:  # all rows are at the roots
        return f, v, y, row, np.broadcast_to(0.0, (len(v), n_features))
    x = table.column("x").combine_chunks()
    x = (x if isinstance(x, pa.ListArray) else x.chunk(0)).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)
    return f, v, y, row, x


def _runs(nodes, tree, f, y, row, x, k, seed, bootstrap, per_node):
    """(feature, node, places, weighted class counts) of a file's rows by open
    node, places in the order of the values."""
    at = where_rows_are(nodes, x)
    w = poisson_weights(row, tree, seed) if bootstrap else np.ones(len(y), np.int64)
    is_open = np.array([n.open for n in nodes])[at] & (w > 0)
    for feature in np.unique(f):
        for node in np.unique(at[is_open & (f == feature)]):
            if feature in node_features(nodes[node].path, tree, seed, x.shape[1], per_node):
                i = np.flatnonzero(is_open & (f == feature) & (at == node))
                one = np.zeros((len(i), k), np.int64)
                one[np.arange(len(i)), y[i]] = w[i]
                yield int(feature), int(node), i, one


def gini_score(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What a split keeps: sum of squared class counts over their number, on
    both sides (the larger, the purer)."""
    right = total - left
    a, b = left.sum(axis=-1), right.sum(axis=-1)
    return (left.astype(float) ** 2).sum(axis=-1) / np.maximum(a, 1) + (right.astype(float) ** 2).sum(axis=-1) / np.maximum(b, 1)


def middle(a: float, b: float) -> float:
    """Between two neighbouring values; below NaN the number itself."""
    if math.isnan(b):
        return a
    m = a + (b - a) / 2
    return a if not math.isfinite(m) or m >= b else m


def _different(a, b):
    return ~((a == b) | (np.isnan(a) & np.isnan(b))) & ~np.isnan(a)


def grow_level(lists: DataFrame, trees: list[list[Node]], n_features: int, k: int, seed: int, bootstrap: bool, per_node: int) -> list:
    """The best split of every open node: rows (tree, node, gain, f, threshold, left)."""
    spark = lists.sparkSession
    shared = spark.sparkContext.broadcast(trees)
    ask = (k, seed, bootstrap, per_node)

    def count(batches):
        for part, table in _parts(batches):
            f, v, y, row, x = _columns(table, n_features)
            out = [(part, t, feature, node, float(v[i[0]]), one.sum(axis=0).tolist())
                   for t, nodes in enumerate(shared.value) for feature, node, i, one in _runs(nodes, t, f, y, row, x, *ask)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out), (
                    pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int64())))], names=["part", "tree", "f", "node", "first", "counts"])
    counts = materialize(lists.mapInArrow(count, "part int, tree int, f int, node int, first double, counts array<bigint>"))
    along = Window.partitionBy("tree", "node", "f").orderBy("part")  # a row per file
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    known = counts.select("part", "tree", "f", "node", F.lead("first").over(along).alias("next"),
                          F.array(*[F.coalesce(F.sum(F.col("counts")[c]).over(before), F.lit(0)) for c in range(k)]).alias("left"))
    held = {(r["part"], r["tree"], r["f"], r["node"]): (r["next"], r["left"]) for r in known.collect()}
    given = spark.sparkContext.broadcast(held)

    def best(batches):
        for part, table in _parts(batches):
            f, v, y, row, x = _columns(table, n_features)
            out = []
            for t, nodes in enumerate(shared.value):
                for feature, node, i, one in _runs(nodes, t, f, y, row, x, *ask):
                    after, left = given.value[part, t, feature, node]
                    after = math.nan if after is None else after
                    left = np.cumsum(one, axis=0) + np.array(left, np.int64)
                    value, total = v[i], nodes[node].counts
                    nxt = np.append(value[1:], after)
                    place = _different(value, nxt)
                    place[-1] &= given.value[part, t, feature, node][0] is not None
                    c = np.flatnonzero(place)
                    if len(c):
                        score = gini_score(left[c], total)
                        j = int(np.argmax(score))  # the first of equals: the smallest threshold
                        gain = (score[j] - (total.astype(float) ** 2).sum() / total.sum()) / total.sum()
                        out.append((t, node, float(gain), feature, middle(float(value[c[j]]), float(nxt[c[j]])), left[c[j]].tolist()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(col, ty) for col, ty in zip(zip(*out), (
                    pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64(), pa.list_(pa.int64())))], names=["tree", "node", "gain", "f", "threshold", "left"])
    splits = lists.mapInArrow(best, "tree int, node int, gain double, f int, threshold double, left array<bigint>")
    rank = F.struct((-F.col("gain")).alias("a"), F.col("f").alias("b"), F.col("threshold").alias("c"))
    return (splits.groupBy("tree", "node").agg(F.min_by(F.struct("gain", "f", "threshold", "left"), rank).alias("s"))
            .select("tree", "node", "s.*").collect())


def fit_exact(df: DataFrame, features: list[str], label: str, key: str, n_classes: int, trees: int = 1, max_depth: int = 5,
              seed: int = 42, bootstrap: bool | None = None, per_node: int | None = None, file_rows: int = FILE_ROWS) -> list[Tree]:
    """Exact trees over the feature columns, label codes 0..n_classes-1.  One
    tree uses all rows and features; a forest a bootstrap of the rows per tree
    and the square root of the features per node, unless told otherwise."""
    bootstrap = trees > 1 if bootstrap is None else bootstrap
    per_node = per_node or (max(1, int(math.sqrt(len(features)))) if trees > 1 else len(features))
    lists = attribute_lists(df, features, label, key, file_rows, max_depth > 1)
    grown = [[Node(c, 0, 1)] for c in _root_counts(lists, len(features), n_classes, trees, seed, bootstrap)]
    for nodes in grown:
        nodes[0].open = max_depth > 0 and np.count_nonzero(nodes[0].counts) > 1
    while any(n.open for nodes in grown for n in nodes):
        found = {(r["tree"], r["node"]): r for r in grow_level(lists, grown, len(features), n_classes, seed, bootstrap, per_node)}
        for t, nodes in enumerate(grown):
            for i in [i for i, n in enumerate(nodes) if n.open]:
                n, s = nodes[i], found.get((t, i))
                n.open = False
                if s is None or s["gain"] <= LEAST_GAIN:
                    continue
                n.feature, n.threshold, n.gain = s["f"], s["threshold"], s["gain"]
                left = np.array(s["left"], np.int64)
                n.left, n.right = len(nodes), len(nodes) + 1
                for side, (c, bit) in enumerate(((left, 0), (n.counts - left, 1))):
                    nodes.append(Node(c, n.depth + 1, 2 * n.path + bit, n.depth + 1 < max_depth and np.count_nonzero(c) > 1))
    return [as_tree(nodes, n_classes) for nodes in grown]


def _root_counts(lists, n_features, k, trees, seed, bootstrap) -> list[np.ndarray]:
    def run(batches):
        total = np.zeros((trees, k), np.int64)
        for b in batches:
            y, row = b.column(0).to_numpy(), b.column(1).to_numpy()
            for t in range(trees):
                w = poisson_weights(row, t, seed) if bootstrap else np.ones(len(y))
                total[t] += np.bincount(y, weights=w, minlength=k).astype(np.int64)
        at = np.argwhere(total > 0)
        yield pa.RecordBatch.from_arrays([pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)), pa.array(total[total > 0])], names=["t", "y", "n"])
    out = np.zeros((trees, k), np.int64)
    for r in lists.where("f = 0").select("y", "row").mapInArrow(run, "t int, y int, n long").groupBy("t", "y").agg(F.sum("n").alias("n")).collect():
        out[r["t"], r["y"]] = r["n"]
    return list(out)


def as_tree(nodes: list[Node], k: int) -> Tree:
    counts = np.array([n.counts for n in nodes], float)
    total = counts.sum(axis=1, keepdims=True)
    return Tree(np.array([n.feature for n in nodes]), np.array([n.threshold for n in nodes]), np.array([n.left for n in nodes]),
                np.array([n.right for n in nodes]), np.where(total > 0, counts / np.maximum(total, 1), 1.0 / k))


def tree_scorer(trees: list[Tree], features: list[str], prefix: str = "p"):
    """Scorer of exact trees for ``explain.partial_dependence`` and batch
    prediction: class probabilities ``p0..`` as plain expressions."""
    k = trees[0].prob.shape[1]

    def value(t: Tree, node: int, c: int):
        if t.feature[node] < 0:
            return F.lit(float(t.prob[node, c]))
        x = F.col(f"`{features[int(t.feature[node])]}`").cast("double")
        left = F.coalesce(~F.isnan(x) & (x <= F.lit(float(t.threshold[node]))), F.lit(False))
        return F.when(left, value(t, int(t.left[node]), c)).otherwise(value(t, int(t.right[node]), c))

    def score(df: DataFrame) -> DataFrame:
        return df.select("*", *[(sum(value(t, 0, c) for t in trees) / len(trees)).alias(f"{prefix}{c}") for c in range(k)])
    return score


def tree_table(spark, trees: list[Tree], features: list[str]) -> DataFrame:
    """(tree, node, feature, threshold, left, right): the splits of the trees."""
    rows = [(t, n, features[int(x.feature[n])], float(x.threshold[n]), int(x.left[n]), int(x.right[n]))
            for t, x in enumerate(trees) for n in range(len(x.feature)) if x.feature[n] >= 0]
    return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, left int, right int")
