"""Skewed inputs: one class / key holding a third of all rows, and results
that must not depend on the number of partitions."""
from pyspark.sql import functions as F

from sf_dirs import SF_MID
from lodestone.operators import sampling as S
from lodestone.operators.selection import crawl_select
from lodestone.session import read_table
from lodestone.sources import collections as K


def _skewed(spark, n=3000):
    # class "hot" holds a third of the rows
    return spark.range(n).select(F.col("id").alias("k"),
                                 F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string"))
                                 .alias("c"))


def test_bucketed_folds_on_hot_class_equal_plain(spark):
    df = _skewed(spark)
    plain = {r.k: r.fold for r in S.stratified_folds(df, "c", "k", 3, 5).collect()}
    bucketed = {r.k: r.fold for r in S.stratified_folds(df, "c", "k", 3, 5, group_rows=40).collect()}
    assert plain == bucketed
    hot = [f for k, f in bucketed.items() if k % 3 == 0]
    assert max(hot.count(i) for i in range(3)) - min(hot.count(i) for i in range(3)) <= 1


def test_insert_if_absent_hot_key(spark):
    target = spark.createDataFrame([("t", 0)], "_id string, stars long")
    source = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
                                      .alias("_id"), F.col("id").alias("stars"))
    out = {r._id: r.stars for r in K.insert_if_absent(target, source, "_id", order="stars").collect()}
    assert out["hot"] == 0 and out["t"] == 0 and len(out) == 1 + 1 + 2000


def test_split_cuts_inside_one_key(spark, monkeypatch):
    monkeypatch.setattr(S, "_FINISH_ROWS", 10)
    df = spark.range(100).select(F.lit(1).alias("k"))
    train, test = S.train_test_split(df, "k", 0.5)
    assert train.count() == test.count() == 50


def test_top_k_same_under_1_and_8_partitions(spark):
    d = read_table(spark, SF_MID, "documents")
    cat = d.select(F.col("doc_id").cast("string").alias("_id"), (F.col("n_chars") % 50).alias("stars"),
                   (F.col("lang") != "de").alias("ok"))
    seen = read_table(spark, SF_MID, "labels").select(F.col("doc_id").cast("string").alias("_id"))
    a = [tuple(r) for r in crawl_select(cat.repartition(1), seen, 40).collect()]
    b = [tuple(r) for r in crawl_select(cat.repartition(8), seen.repartition(8), 40).collect()]
    assert a == b and len(a) == 40


def test_split_and_folds_same_under_shuffle_partitions(spark):
    e = read_table(spark, SF_MID, "events").select("event_id", "event_type")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = {tuple(r) for r in S.stratified_folds(S.with_split(e, "event_id"), "event_type", "event_id").collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = {tuple(r) for r in S.stratified_folds(S.with_split(e, "event_id"), "event_type", "event_id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_top_k_is_one_contract_in_both_plans(spark):
    from lodestone.operators.selection import top_k
    d = read_table(spark, SF_MID, "documents")
    cat = d.select(F.when(F.col("doc_id") % 31 != 0, F.col("doc_id").cast("string")).alias("_id"),
                   F.when(F.col("doc_id") % 17 == 0, None).otherwise(F.col("n_chars") % 40).alias("stars"))
    cat = cat.unionByName(cat.limit(20))  # repeated keys
    for k in (0, 1, 37, 990, 1015, 1500):
        a = [tuple(r) for r in top_k(cat, k, "stars", "_id").collect()]
        b = [tuple(r) for r in top_k(cat, k, "stars", "_id", merge_rows=-1).collect()]
        assert a == b and len(a) == min(k, 1020), k


def test_first_n_is_one_contract_in_both_plans(spark):
    from lodestone.operators.selection import first_n
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (2,)], "k int")
    for n, want in ((2, [None, 1]), (4, [None, 1, 2, 2]), (9, [None, 1, 2, 2, 3])):
        for merge in (10_000, -1):
            assert [r.k for r in first_n(df, n, "k", merge_rows=merge).collect()] == want


def test_global_index_numbers_all_rows_in_order(spark):
    from lodestone.session import global_index
    df = spark.range(5000).select(((F.col("id") * 37) % 5000).alias("v"))
    got = global_index(df, F.col("v").desc()).collect()
    assert sorted((r["_index"], r["v"]) for r in got) == [(i, 4999 - i) for i in range(5000)]


def test_shared_folder_is_required_off_local_mode(monkeypatch):
    import pytest
    from lodestone import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_broadcast_is_bounded_by_bytes(spark):
    from lodestone.session import join_small
    big = spark.range(10).select(F.col("id").alias("k"))
    wide = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 200_000).alias("t"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda s: join_small(big, s, "k")._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan(wide)
        spark.conf.set("lodestone.broadcast.maxBytes", "1000000")
        assert "BroadcastHashJoin" not in plan(wide) and "BroadcastHashJoin" in plan(wide.select("k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("lodestone.broadcast.maxBytes")
