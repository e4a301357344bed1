import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures_llm import awkward, awkward_rows, empty
from pyspark.sql import functions as F
from sf_dirs import SF_SMALL

from lodestone.llm import ngram_lm as L
from lodestone.session import scratch_path


def tokens(t):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t) + [None]


def brute(rows, trains, order=2):
    tok = [tokens(t) for _, t in rows]
    c = Counter(w for x, on in zip(tok, trains) if on for w in x)
    b = Counter(p for x, on in zip(tok, trains) if on for p in zip([None, *x], x))
    t3 = Counter(t for x, on in zip(tok, trains) if on for t in zip([None, *x], x, x[1:]))
    n, v = sum(c.values()), len(c)
    out = []
    for x in tok:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)
        score = 0.0
        for i, (h, w) in enumerate(zip([None, *x], x)):
            k = c[h] ** L.CONCENTRATION if c[h] else 1.0
            p = (b[h, w] + k * (c[w] + 1) / (n + v + 1)) / (c[h] + k)
            if order == 3 and i:
                g = x[i - 2] if i > 1 else None
                k = b[g, h] ** L.CONCENTRATION if b[g, h] else 1.0
                p = (t3[g, h, w] + k * p) / (b[g, h] + k)
            score += math.log10(p)
        out.append((len(x), sum(c[w] > 0 for w in x), n, base, score))
    return out


def check(spark, df, rows, trains, train, order=2):
    got = L.corpus_scores(df, train, order=order).collect()
    key = lambda r: (r[0], round(r[1], 6))
    want = sorted((n, k, t, b, s) for n, k, t, b, s in brute(rows, trains, order))
    have = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 and abs(a[4] - b[4]) < 0.02 * b[0] + 1e-6
    assert key


@pytest.mark.parametrize("order", [2, 3])
def test_awkward_rows_against_brute_force(spark, order):
    rows = awkward_rows()
    check(spark, awkward(spark), rows, [d is not None and zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows],
          F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, order)


@pytest.mark.parametrize("order", [2, 3])
def test_given_table_against_brute_force(spark, order):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, [d % 5 != 1 for d, _ in rows], F.col("doc_id") % 5 != 1, order)


def test_order_3_edges(spark):
    assert L.corpus_scores(empty(spark), F.lit(True), order=3).count() == 0
    got = L.corpus_scores(awkward(spark), F.lit(False), order=3).collect()
    assert all(abs(r["score"] - r["base_score"]) < 1e-9 for r in got)
    rows = [(i, " ".join(f"the same w{(i * 7 + j) % 90}" for j in range(30))) for i in range(40)]  # a hot pair of words
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows, [True] * 40, F.lit(True), 3)
    with pytest.raises(ValueError):
        L.corpus_scores(awkward(spark), F.lit(True), order=4)


def test_no_training_rows_and_empty(spark):
    got = L.corpus_scores(awkward(spark), F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["score"] - r["base_score"]) < 1e-9 for r in got)
    assert L.corpus_scores(empty(spark), F.lit(True)).count() == 0


def test_hot_context_is_spread_and_levels_can_be_mapped(spark, tmp_path):
    rows = [(i, " ".join(f"the w{(i * 7 + j) % 90}" for j in range(30))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(spark, df, rows, [True] * 40, F.lit(True))
    path = scratch_path(spark, "levels")
    L.corpus_scores(df, F.lit(True), levels_to=path).count()
    levels = [bytes(r["blob"]) for r in spark.read.parquet(path).collect()]
    assert len(levels) > 1  # one context holds half of all tokens, and no shard holds it alone
    (tmp_path / "level").write_bytes(levels[0])
    mapped = L.TrieLevel.view(np.memmap(tmp_path / "level", dtype=np.uint8, mode="r"))
    assert len(mapped.codes) > 0


def test_trie_search_is_relative_to_the_context():
    key = np.array([(h << 32) | w for h in (1, 5, 9) for w in (2, 3, 7)], dtype=np.uint64)
    t = L.TrieLevel.view(L.TrieLevel.build(key, np.linspace(1, 2, 9)).to_bytes())
    assert np.abs(t.delta(key) - np.linspace(1, 2, 9)).max() < 0.01
    ask = np.array([(1 << 32) | 4, (2 << 32) | 2, (5 << 32) | 1000, (9 << 32) | 8, (10 << 32) | 2], dtype=np.uint64)
    assert (t.delta(ask) == 0).all()


def test_the_model_sums_to_one():
    c, b = {"a": 5, "b": 3, None: 2}, {("a", "b"): 3, ("a", None): 2}
    n, v = 10, 3
    k = c["a"] ** L.CONCENTRATION
    p = lambda w: (c.get(w, 0) + 1) / (n + v + 1)
    total = sum((b.get(("a", w), 0) + k * p(w)) / (c["a"] + k) for w in ("a", "b", None, "unseen"))
    assert abs(total - 1) < 1e-12


def test_words_a_polynomial_cannot_tell_apart_are_two(spark):
    x, y = "a", "b"
    for _ in range(11):
        x, y = x + y, y + x
    rows = [(1, f"{x} {x} {y}"), (2, y), (3, x)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows, [True, True, False], F.col("doc_id") < 3)
