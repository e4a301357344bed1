import random

import numpy as np

from lodestone.llm.components import connected_components, stars


def brute(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        return x if up[x] == x else root(up[x])
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {n: root(n) for n in up}


def graphs():
    rnd = random.Random(5)
    path = list(range(0, 400, 2))
    rnd.shuffle(path)  # long paths in no order
    yield list(zip(path, path[1:])) + [(1, 3), (5, 3), (7, 7)]
    yield [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    yield [(0, i) for i in range(1, 200)] + [(900 + i, 900) for i in range(100)]
    yield [(-5, 3), (3, -9)]


def test_stars_and_components_against_union_find(spark):
    for edges in graphs():
        want = {n: c for n, c in brute([e for e in edges if e[0] != e[1]]).items()}
        a, b = stars(*(np.array(x) for x in zip(*edges)))
        assert {n: c for n, c in zip(a.tolist(), b.tolist())} == {n: c for n, c in want.items() if n != c}
        df = spark.createDataFrame(edges, "a long, b long").repartition(4)
        assert {r["node"]: r["component"] for r in connected_components(df).collect()} == want


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert [len(x) for x in stars(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]
