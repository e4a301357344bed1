"""Top-k that reads only the leading files of sorted runs."""
import random

import pytest

from lodestone.operators import sorted_runs as R
from lodestone.operators.selection import crawl_select, top_k
from lodestone.streaming import incremental as I

SCHEMA = "_id string, stars long, ok boolean"


def catalog(spark, n=900, seed=1):
    rnd = random.Random(seed)
    return spark.createDataFrame([(f"d{i:04d}", rnd.choice([None, 0, 5, 5, 7, *range(100)]), rnd.choice([True, True, False, None])) for i in range(n)], SCHEMA)


@pytest.fixture()
def runs(spark, tmp):
    cat = catalog(spark)
    for part in cat.randomSplit([1.0, 1.0, 1.0], 3):
        R.add_run(part, f"{tmp}/runs", "stars", "_id", file_rows=20)
    return cat, f"{tmp}/runs"


@pytest.mark.parametrize("k", [1, 10, 100, 880, 900, 2000])
def test_equal_to_top_k_of_all_rows(spark, runs, k):
    cat, root = runs
    got, _ = R.top_k_of_runs(spark, root, k, "stars", "_id")
    assert got.collect() == top_k(cat, k, "stars", "_id").collect()


def test_only_leading_files_are_read(spark, runs):
    _, root = runs
    files = R.run_files(spark, R.snapshots.current(spark, root))
    got, read = R.top_k_of_runs(spark, root, 10, "stars", "_id")
    assert files.count() >= 40 and len(read) <= 8 and got.count() == 10
    # what was not read holds nothing better
    least = min(r.stars for r in got.collect())
    assert all(f["high"] is None or f["high"] <= least for f in files.collect() if f["file"] not in read)


def test_seen_and_failed_rows_just_take_more_files(spark, runs):
    cat, root = runs
    seen = top_k(cat, 300, "stars", "_id").select("_id")
    got, read = R.top_k_of_runs(spark, root, 15, "stars", "_id", ok="ok", seen=seen)
    assert [r._id for r in got.collect()] == [r._id for r in crawl_select(cat, seen, 15).collect()]
    assert len(read) < R.run_files(spark, R.snapshots.current(spark, root)).count()


def test_incremental_runs_equal_those_over_the_whole_catalog(spark, runs, tmp):
    cat, root = runs
    for r in range(3):
        a = I.incremental_select(cat, f"{tmp}/log-a", 40, batch_id=f"r{r}")
        b = I.incremental_select_runs(spark, root, f"{tmp}/log-b", 40, batch_id=f"r{r}")
        assert [x._id for x in a.collect()] == [x._id for x in b.collect()]
    assert sorted(I.read_key_log(spark, f"{tmp}/log-a").collect()) == sorted(I.read_key_log(spark, f"{tmp}/log-b").collect())


def test_empty_runs(spark, tmp):
    R.add_run(spark.createDataFrame([], SCHEMA), f"{tmp}/runs", "stars", "_id")
    got, read = R.top_k_of_runs(spark, f"{tmp}/runs", 5, "stars", "_id")
    assert got.count() == 0 and read == []
