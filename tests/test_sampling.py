import math

import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_MID
from lodestone.operators import sampling as S
from lodestone.session import read_table


def _events(spark):
    return read_table(spark, SF_MID, "events").select("event_id", "event_type")


def test_split_sizes_disjoint_cover(spark):
    e = _events(spark)
    train, test = S.train_test_split(e, "event_id", 0.2, 42)
    n = e.count()
    tr = {r[0] for r in train.select("event_id").collect()}
    te = {r[0] for r in test.select("event_id").collect()}
    assert len(te) == math.ceil(0.2 * n) and len(tr) == n - len(te)
    assert not (tr & te) and len(tr | te) == n


def test_split_multi_level_histogram(spark, monkeypatch):
    """Force the refinement passes and compare with the one-pass answer."""
    e = _events(spark)
    want = {r[0] for r in S.train_test_split(e, "event_id", 0.2, 7)[1].collect()}
    monkeypatch.setattr(S, "_FINISH_ROWS", 1)
    got = {r[0] for r in S.train_test_split(e, "event_id", 0.2, 7)[1].collect()}
    assert got == want


def test_split_independent_of_partitioning(spark):
    e = _events(spark)
    a = {r[0] for r in S.train_test_split(e.repartition(1), "event_id")[1].collect()}
    b = {r[0] for r in S.train_test_split(e.repartition(13), "event_id")[1].collect()}
    assert a == b


def test_folds_balanced_per_class(spark):
    f = S.stratified_folds(_events(spark), "event_type", "event_id", 3, 42)
    counts = f.groupBy("event_type", "fold").count().collect()
    by = {}
    for r in counts:
        by.setdefault(r["event_type"], []).append(r["count"])
    for sizes in by.values():
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1


def test_bucketed_rank_equals_plain_window(spark):
    e = _events(spark)
    plain = {r["event_id"]: r["fold"] for r in S.stratified_folds(e, "event_type", "event_id", 3, 42).collect()}
    bucketed = {r["event_id"]: r["fold"] for r in
                S.stratified_folds(e, "event_type", "event_id", 3, 42, group_rows=50).collect()}
    assert plain == bucketed


def test_rank_with_null_class(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 2).alias("c"))
    a = {r["id"]: r["_rank"] for r in S.exact_rank(df, "id", 1, by=["c"]).collect()}
    b = {r["id"]: r["_rank"] for r in S.exact_rank(df, "id", 1, by=["c"], group_rows=5).collect()}
    assert a == b
    assert sorted(v for k, v in a.items() if k % 4 == 0) == list(range(1, 51))


def test_bucketed_global_rank_equals_plain(spark):
    df = spark.range(3000).select(F.col("id").alias("k"))
    a = {r.k: r._rank for r in S.exact_rank(df, "k", 3).collect()}
    b = {r.k: r._rank for r in S.exact_rank(df, "k", 3, group_rows=7).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 3001))


def test_null_keys_are_kept_in_every_form(spark):
    df = spark.range(100).select(F.when(F.col("id") >= 10, F.col("id")).alias("k"), (F.col("id") % 2).alias("c"))
    train, test = S.train_test_split(df, "k", 0.2, 42)
    assert (train.count(), test.count()) == (80, 20)
    tagged = S.with_split(df, "k", 0.2, 42)
    assert {r[0]: r[1] for r in tagged.groupBy("split").count().collect()} == {"train": 80, "test": 20}
    assert test.where("k is null").count() == tagged.where("split = 'test' and k is null").count() == 10
    for group_rows in (S.GROUP_ROWS, 7):
        f = S.stratified_folds(df, "c", "k", 3, 42, group_rows=group_rows)
        assert f.count() == 100 and f.where("fold is null").count() == 0


def plain_order(rows, seed=42):
    """Rows (key, other) in the seeded order, by the definition."""
    import hashlib
    h = lambda k: "" if k is None else hashlib.md5(f"{seed}:{k}".encode()).hexdigest()
    return sorted(rows, key=lambda r: (h(r[0]), r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))


@pytest.mark.parametrize("finish", [S._FINISH_ROWS, 3])
def test_a_cut_among_equal_keys_is_exact(spark, monkeypatch, finish):
    monkeypatch.setattr(S, "_FINISH_ROWS", finish)
    rows = [(i % 10 if i % 10 else None, i // 20 if i % 3 else None) for i in range(200)]  # some rows equal in all columns
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "k long, v long").repartition(parts)
        for size in (1, 37, 0.25, 0.5, 199):
            n = size if isinstance(size, int) else math.ceil(size * 200)
            train, test = S.train_test_split(df, "k", size)
            want = sorted(plain_order(rows)[:n], key=str)
            assert sorted(map(tuple, test.collect()), key=str) == want and train.count() == 200 - n
            tagged = S.with_split(df, "k", size)
            assert sorted(((r.k, r.v) for r in tagged.where("split = 'test'").collect()), key=str) == want and tagged.count() == 200


def test_seventy_percent_null_keys(spark):
    rows = [(None if i % 10 < 7 else i % 40, i if i % 2 else None, i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long, c int").repartition(6)
    train, test = S.train_test_split(df, "k", 0.2)
    assert (test.count(), train.count()) == (600, 2400)
    a = S.exact_rank(df, "k", 42, by=["c"]).collect()
    b = S.exact_rank(df, "k", 42, by=["c"], group_rows=100).collect()
    key = lambda r: (str(r["k"]), str(r["v"]), r["c"], r["_rank"])
    assert sorted(map(key, a)) == sorted(map(key, b))
    for c in range(3):
        own = plain_order([(k, v) for k, v, x in rows if x == c])
        assert [(r["k"], r["v"]) for r in sorted((r for r in b if r["c"] == c), key=lambda r: r["_rank"])] == own


def test_many_equal_rows_are_dealt_over_ranges(spark):
    df = spark.range(4000).select(F.lit(None).cast("long").alias("k"), F.lit(1).alias("c")).repartition(4)
    f = S.stratified_folds(df, "c", "k", 3, group_rows=100)
    assert sorted(r["count"] for r in f.groupBy("fold").count().collect()) == [1333, 1333, 1334]
    _, ties = S._cut_key(df, "k", (1, "", None, 1))
    assert ties.select(F.spark_partition_id().alias("p")).distinct().count() > 1 or ties.count() == 4000
    assert [r["_index"] for r in ties.orderBy("_index").collect()] == list(range(4000))


def test_split_edges(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    for size, n in ((0, 0), (0.0, 0), (10, 10), (1.0, 10), (25, 10), (3, 3)):
        assert S.with_split(df, "k", size).where("split = 'test'").count() == n
    assert S.with_split(df.limit(0), "k", 0.2).count() == 0
