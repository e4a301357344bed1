import math
import re
from collections import Counter

import pytest
from fixtures_llm import awkward, empty
from pyspark.sql import functions as F
from sf_dirs import SF_SMALL

from lodestone.llm import ranked_search as R
from lodestone.llm.common import read_table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in TERM.findall(t or "")]


def brute(docs, items, k=10):
    """(item, rank, doc, score) by the contract, one pair at a time."""
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    bags = [x for x in bags if x[2]]
    n_docs, total = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in wanted.items():
        found = []
        for d, bag, n in bags:
            m = 10 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m))
                    for t in own if t in bag)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=str)


ITEMS = [(1, "the quick BROWN fox"), (2, None), (3, ""), (4, "alpha1 beta2 alpha1"), (4, "gamma3"), (None, "x tail 123"), (5, "日本語 é"),
         (6, "no such words"), (7, "a" * 3000)]


def test_awkward_rows_against_brute_force(spark):
    df = awkward(spark)
    items = spark.createDataFrame([(i, t, "n", "b") for i, t in ITEMS], "item_id long, text string, bag string, cls string")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert got(R.search(df, items)) == brute(docs, ITEMS)
    assert got(R.search(df, items, k=2, item_bytes=20)) == brute(docs, ITEMS, 2)


def test_given_table_against_brute_force(spark):
    d, b = (read_table(spark, SF_SMALL, t) for t in ("documents", "benchmark"))
    items = [(r["item_id"], r["text"]) for r in b.collect()]
    assert got(R.search(d, b)) == brute([(r["doc_id"], r["text"]) for r in d.collect()], items)


def test_a_third_in_one_class_and_ties(spark):
    rows = [(i, "hot words here") for i in range(60, 0, -1)] + [(100 + i, f"cold words {i % 7} there") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = [(1, "hot"), (2, "words"), (3, "cold 3 there")]
    assert got(R.search(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(rows, items)


def test_equal_bags_are_scored_once(spark):
    df = spark.createDataFrame([(i, f"apple pear filler{i}") for i in range(40)], "doc_id long, text string")
    held = R.bags(df, [b"apple", b"pear"], "doc_id", "text")
    assert held.select("bag", "n").distinct().count() == 1 and held.count() == 40


def test_sums_are_exact_beyond_a_slice(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 3)
    words = [f"w{i}" for i in range(40)]
    s = R.Scorer(R.np.zeros(40, int), R.np.arange(40), 1, 40, R.np.full(40, 30_000), 10, 8, cells=8)
    one = R.np.ones(40, int)
    s.add(R.np.zeros(40, int), R.np.arange(40), one, R.np.array([100]), R.np.array([7]), R.np.array([1]))
    assert s.top[1].tolist() == [len(words) * 30_000 * (10 ** 9 // 1800)]


def test_long_texts_are_read_whole(monkeypatch):
    text = b"Abc d9 " * 2000 + b"z" * 500
    monkeypatch.setattr(R, "PIECE", 64)
    assert [t for p in R.pieces_of(text) for t in p] == text.lower().split()


@pytest.mark.parametrize("docs,items", [(True, False), (False, True), (False, False)])
def test_empty_tables(spark, docs, items):
    d = awkward(spark) if docs else empty(spark)
    i = spark.createDataFrame(ITEMS if items else [], "item_id long, text string")
    out = R.search(d, i)
    assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_all_blank_texts(spark):
    d = spark.createDataFrame([(1, " .,"), (2, None)], "doc_id long, text string")
    assert R.search(d, spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("m", F.lit(1))).count() == 0
