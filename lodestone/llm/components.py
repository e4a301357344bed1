"""Connected components of a link table, by Spark joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import stored


def lowest(low: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component: those of ``low``, which holds the
    same for earlier links, after the links (u, v)."""
    while True:
        m = np.minimum(low[u], low[v])
        new = low.copy()
        for end in (u, v):
            np.minimum.at(new, end, m)
            np.minimum.at(new, low[end], m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of a task's own links as (node, smallest node): as many
    links as nodes at most, and every path one step long."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = lowest(np.arange(len(nodes)), at[:len(a)], at[len(a):])
    far = low != np.arange(len(nodes))
    return nodes[far], nodes[low[far]]


def _finished(edges: DataFrame) -> bool:
    """Whether the links are stars: each node but the centres has one link, and
    no centre has a centre of its own."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                                          F.struct(F.col("b").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))).alias("e"))
    odd = (ends.groupBy("e.n").agg(F.sum("e.out").alias("out"), F.max("e.into").alias("into"))
           .where("out > 1 or (out = 1 and into = 1)"))
    return odd.isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node
    reachable.  Alternates large-star and small-star steps, each a minimum per
    node joined back, until only stars are left; every round is a stored table,
    so the lineage stays short, and a node with many links is one small row per
    link, never one large row.  The minima are stored before they are joined: a
    small table of them is broadcast, and beyond that the links of a node
    with very many can be split over tasks (they share no shuffle with the minimum).
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _finished(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        edges = stored(small.distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
