"""Substring search by trigram posting lists."""
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodestone.operators import text_index as X
from lodestone.session import read_table
from sf_dirs import SF_MID


@given(st.lists(st.integers(0, 2 ** 40), max_size=60, unique=True))
@settings(max_examples=80, deadline=None)
def test_lists_round_trip(xs):
    a = np.array(sorted(xs), dtype=np.int64)
    assert (X.unpacked(X.packed(a)) == a).all()


@pytest.fixture(scope="module")
def held(spark):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice("abcdé日 ") for _ in range(rnd.randrange(0, 60)))) for i in range(600)]
    rows += [(600, None), (601, ""), (602, "ab"), (603, "abc" * 5000), (603, "abc" * 5000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "k long, text string, trigram string").repartition(3)
    return rows, X.build(df, "text", segment_bytes=3000)


@pytest.mark.parametrize("terms", [["abc"], ["é日"], ["dé a"], ["ab"], [""], ["abcab"], ["zzz"], ["cab", "日日日"], ["abc", "b"]])
def test_equal_to_a_scan(spark, held, terms):
    rows, index = held
    got = sorted(r["k"] for r in index.containing(terms).collect())
    assert got == sorted(k for k, t in rows if any(x in (t or "") for x in terms) and t is not None)
    assert index.containing(terms).columns == ["k", "text", "trigram"]


def test_segments_are_bounded_and_lists_of_a_segment_complete(held):
    rows, index = held
    per = index.lists.groupBy("segment").agg(F.count("trigram").alias("n"), F.count_distinct("trigram").alias("d")).collect()
    assert len(per) > 3 and all(r["n"] == r["d"] for r in per)


def test_few_texts_are_read(spark):
    docs = read_table(spark, SF_MID, "documents").select("doc_id", "text")
    index = X.build(docs, "text")
    for term in ("under the MIT License", "GNU General Public"):
        want = docs.where(F.contains("text", F.lit(term))).count()
        assert index.containing([term]).count() == want > 0
        assert index.share_read([term]) < 0.2
    assert index.share_read(["ab"]) == 1.0


def test_empty_table(spark):
    index = X.build(spark.createDataFrame([], "k long, text string"), "text")
    assert index.containing(["abc"]).count() == 0 and index.share_read(["abc"]) == 1.0
