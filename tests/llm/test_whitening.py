import math

import numpy as np
import pytest
from sf_dirs import SF_SMALL

from lodestone.llm import bidiagonal as D
from lodestone.llm import whitening as W
from lodestone.llm.common import read_table

SCHEMA = "vec_id long, embedding array<float>, n string, x string, key string"


def brute(rows, k=4):
    """{(vec_id, component): ...} by the eigenvectors of the covariance."""
    x = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
         if v and all(c is not None and math.isfinite(c) for c in v)]
    own = sorted({tuple(v) for _, v in x})
    n, s = len(own), [sum(c) for c in zip(*own)]
    centred = np.array([[c - t / n for c, t in zip(v, s)] for v in own])
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1], vec[:, ::-1]
    out = []
    for i, v in x:
        dev = sum((n * c - t) ** 2 for c, t in zip(v, s))
        w = np.array([c - t / n for c, t in zip(v, s)]) @ vec[:, :k] / np.sqrt(e[:k])
        out += [(i, j + 1, n, dev, w[j], e[j] / e.sum()) for j in range(k)]
    return out


def check(df, rows, k=4):
    got = sorted(df.collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"], r["component"]))
    want = sorted(brute(rows, k), key=lambda r: (r[0] is None, r[0], r[1]))
    assert [tuple(r)[:4] for r in got] == [r[:4] for r in want]
    for j in range(1, k + 1):
        a = np.array([r["whitened"] for r in got if r["component"] == j])
        b = np.array([r[4] for r in want if r[1] == j])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert {round(r["explained"], 12) for r in got if r["component"] == j} == {round(r[5], 12) for r in want if r[1] == j}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_given_table_against_numpy(spark):
    df = read_table(spark, SF_SMALL, "embeddings")
    check(W.whiten(df), [(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_awkward_rows_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=6) * [9, 5, 3, 1, .5, .2]]) for i in range(50)]
    rows += [(i, rows[0][1]) for i in range(100, 130)]  # a third are one vector
    rows += [(None, rows[1][1]), (7, rows[2][1]), (200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0, 5.0]),
             (203, [math.nan] * 6), (204, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (205, [-0.0, 0.0, 0.0, 0.0, -1e-9, 0.0])]
    df = spark.createDataFrame([(*r, "n", "x", "k") for r in rows], SCHEMA).repartition(7)
    check(W.whiten(df), rows)


def test_other_lengths_are_dropped(spark):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(9)] + [(50, [1.0, 2.0, 3.0])]
    got = W.whiten(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == set(range(9)) and {r["component"] for r in got} == {1, 2}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])] * 3])
def test_nothing_to_whiten(spark, rows):
    out = W.whiten(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA))
    assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]


def test_lower_rank_gives_fewer_components(spark):
    rows = [(i, [float(i % 5), 2.0 * (i % 5), float(i % 3)]) for i in range(30)]
    got = W.whiten(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-10


def test_large_entries_stay_exact(spark):
    rows = [(i, [2.0 ** 40 * i, 3.0 * i * i]) for i in range(8)]
    m = W.Whitening(8, [sum(int(v[k] * 256) for _, v in rows) for k in (0, 1)], np.zeros((2, 0)), np.zeros(0), 1.0)
    x = np.array([[int(c * 256) for c in v] for _, v in rows])
    want = [sum((8 * int(c) - s) ** 2 for c, s in zip(v, m.sums)) for v in x.tolist()]
    assert W.deviations(x, m) == [w if w < 2 ** 63 else None for w in want] and None in W.deviations(x, m)
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    assert W.exact_sums(W.distinct_vectors(W.vectors_of(df, "vec_id", "embedding")), 2) == m.sums


def test_factors_are_stacked_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(W, "GROUP_BYTES", 1)
    rows = [(i, [float(i % 11), float(i % 7), i / 9, float(i % 5)]) for i in range(200)]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA).repartition(9)
    check(W.whiten(df), rows)


@pytest.mark.parametrize("seed", range(40))
def test_solver_against_numpy(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 60))
    x = rng.standard_normal((int(rng.integers(1, 150)), d))
    if seed % 5 == 1:
        x *= 10.0 ** rng.uniform(-3, 3, d)
    elif seed % 5 == 2:
        x = x @ rng.standard_normal((d, d // 2 + 1)) @ rng.standard_normal((d // 2 + 1, d))
    elif seed % 5 == 3:
        x = np.repeat(np.eye(d), 3, axis=0) * 7  # all values equal
    elif seed % 5 == 4:
        x[:, rng.integers(0, d, d // 2)] = 0
    r = np.linalg.qr(x, mode="r")
    r = np.vstack([r, np.zeros((d - len(r), d))])
    a, b, w = D.bidiagonalise(r)
    want = np.zeros(d)
    want[:min(x.shape)] = np.linalg.svd(x, compute_uv=False)
    assert np.abs(D.dqds_values(a, b) - want).max() < 1e-12 * max(want[0], 1)
    assert np.abs(w.T @ w - np.eye(d)).max() < 1e-12
    val, v = D.right_vectors(r, 4)
    assert np.abs(v.T @ v - np.eye(len(val))).max(initial=0) < 1e-11
    for s, u in zip(val, v.T):
        assert np.linalg.norm(x.T @ (x @ u) - s * s * u) < 1e-12 * want[0] ** 2
