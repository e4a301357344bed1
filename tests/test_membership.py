"""Bloom filter in front of the anti join."""
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import membership as M
from lodestone.operators.selection import unseen


def keys(spark, ids, name="_id"):
    return spark.createDataFrame([(i if i is None else f"k{i}",) for i in ids], f"{name} string")


@pytest.mark.parametrize("filter_bytes", [M.FILTER_BYTES, 256])  # 256: several slices
def test_result_is_exact_and_few_rows_reach_the_join(spark, filter_bytes):
    rnd = random.Random(1)
    df = keys(spark, [*range(8000), None, 5, 5]).withColumn("v", F.lit(1)).repartition(4)
    seen = keys(spark, [rnd.randrange(6000) * 2 for _ in range(900)], "done")
    got, want = M.unseen_filtered(df, seen, "_id", "done", filter_bytes=filter_bytes), unseen(df, seen, "_id", "done")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns
    new, maybe = M.split_by_filter(df, seen, "_id", "done", filter_bytes=filter_bytes)
    n_new, n_maybe, members = new.count(), maybe.count(), df.count() - want.count()
    assert n_new + n_maybe == df.count()
    assert members <= n_maybe <= members + 0.02 * want.count() + 1  # what is shuffled: members and false alarms


def test_false_alarm_rate(spark):
    seen, other = spark.range(20_000).selectExpr("cast(id as string) as k"), spark.range(100_000, 300_000).selectExpr("cast(id as string) as k")
    for fp in (0.1, 0.01, 0.001):
        _, maybe = M.split_by_filter(other, seen, "k", fp=fp)
        assert maybe.count() / 200_000 <= 1.5 * fp


def test_size_is_bounded_and_beyond_it_the_plain_join(spark):
    assert M.filter_size(0) == (64, 12) and M.filter_size(1_000_000)[0] <= 1 << 24
    df, seen = keys(spark, range(50)), keys(spark, range(0, 50, 2))
    assert M.split_by_filter(df, seen, "_id", filter_bytes=1) is None
    assert M.unseen_filtered(df, seen, "_id", filter_bytes=1).count() == 25


def test_empty_sides(spark):
    df = keys(spark, [1, None])
    assert M.unseen_filtered(df, keys(spark, []), "_id").count() == 2
    assert M.unseen_filtered(keys(spark, []), df, "_id").count() == 0


def test_the_misses_are_not_shuffled(spark):
    df, seen = spark.range(1000).selectExpr("cast(id as string) as _id"), keys(spark, range(10))
    new, _ = M.split_by_filter(df, seen, "_id")
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" not in plan
