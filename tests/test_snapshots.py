"""Versioned tables: atomic refresh, conflict-checked inserts, merged tiers."""
import os
import threading

import pytest
from pyspark.sql import functions as F

from lodestone.plans import etl
from lodestone.sources import collections as K
from lodestone.sources import snapshots as S

SCHEMA = "_id string, v long"


def rows(df):
    return sorted(map(tuple, df.collect()))


def table(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def test_a_failed_refresh_leaves_the_old_rows(spark, tmp):
    S.replace(table(spark, ("a", 1), ("b", 2)), tmp)

    def boom(batches):
        for b in batches:
            yield b
        raise RuntimeError("task lost")
    dying = spark.range(1000, numPartitions=4).selectExpr("cast(id as string) as _id", "id as v").mapInArrow(boom, SCHEMA)
    with pytest.raises(Exception):
        S.replace(dying, tmp)
    assert rows(S.read(spark, tmp)) == [("a", 1), ("b", 2)] and S.current(spark, tmp).version == 1
    assert S.replace(table(spark, ("c", 3)), tmp) == 1 and rows(S.read(spark, tmp)) == [("c", 3)]
    assert S.vacuum(spark, tmp, keep=1) >= 1 and rows(S.read(spark, tmp)) == [("c", 3)]


def test_a_reader_keeps_its_version(spark, tmp):
    S.replace(table(spark, ("a", 1)), tmp)
    before = S.read(spark, tmp)
    S.replace(table(spark, ("b", 2)), tmp)
    assert rows(before) == [("a", 1)] and rows(S.read(spark, tmp)) == [("b", 2)]


def test_a_table_may_be_refreshed_from_itself(spark, tmp):
    S.replace(table(spark, ("a", 1)), tmp)
    S.replace(S.read(spark, tmp).withColumn("v", F.col("v") + 1), tmp)
    assert rows(S.read(spark, tmp)) == [("a", 2)]


def test_a_commit_is_never_overwritten(spark, tmp):
    path = f"{tmp}/x.json"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if S.create_new(spark, path, f"by {i}") else None) for i in range(12)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and open(path).read() == f"by {won[0]}"
    assert [f for f in os.listdir(tmp) if not f.startswith(".")] == ["x.json"]


def test_a_lost_hint_costs_nothing_but_a_listing(spark, tmp):
    for i in range(3):
        S.append(table(spark, (str(i), i)), tmp)
    for text in ("1", "garbage", "99"):
        S._write_text(spark, f"{tmp}/_commits/_last", text, overwrite=True)
        assert S.current(spark, tmp).version == 3
    os.remove(f"{tmp}/_commits/_last")
    assert S.current(spark, tmp).version == 3 and S.read(spark, tmp).count() == 3


def insert(spark, root, *pairs, tag=None):
    source = table(spark, *pairs)
    return S.Insert(spark, root, ["_id"], lambda held: source if held is None else source.join(held, "_id", "left_anti"), source.schema, tag)


def test_interleaved_inserts_add_a_key_once(spark, tmp):
    S.replace(table(spark, ("a", 1)), tmp)
    one, two = insert(spark, tmp, ("a", 9), ("b", 1), ("c", 1)), insert(spark, tmp, ("b", 2), ("d", 2))
    assert two.commit() == 2 and one.commit() == 1
    assert rows(S.read(spark, tmp)) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert S.current(spark, tmp).version == 3


def test_an_insert_over_a_refresh_looks_at_the_whole_table_again(spark, tmp):
    S.replace(table(spark, ("a", 1), ("b", 1)), tmp)
    one = insert(spark, tmp, ("a", 9), ("c", 9))
    S.replace(table(spark, ("b", 5), ("c", 5)), tmp)
    assert one.commit() == 1 and rows(S.read(spark, tmp)) == [("a", 9), ("b", 5), ("c", 5)]


def test_the_first_insert_into_nothing_also_conflicts(spark, tmp):
    one, two = insert(spark, tmp, ("a", 1), ("b", 1)), insert(spark, tmp, ("b", 2))
    assert one.commit() == 2 and two.commit() == 0
    assert rows(S.read(spark, tmp)) == [("a", 1), ("b", 1)]


def test_inserts_from_many_threads(spark, tmp):
    def work(i):
        insert(spark, tmp, *[(str(k), i) for k in range(i, i + 4)]).commit()
    threads = [threading.Thread(target=work, args=(i,)) for i in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    keys = [r._id for r in S.read(spark, tmp).collect()]
    assert sorted(map(int, keys)) == list(range(8))


def test_a_repeated_tag_takes_the_place_of_its_part(spark, tmp):
    S.append(table(spark, ("a", 1), ("b", 1)), tmp, tag="e0")
    S.append(table(spark, ("c", 1)), tmp, tag="e1")
    S.append(table(spark, ("a", 2)), tmp, tag="e0")
    assert rows(S.read(spark, tmp)) == [("a", 2), ("c", 1)]
    with pytest.raises(ValueError):
        S.append(spark.range(3), tmp)


def test_parts_are_logarithmic_in_appends(spark, tmp):
    seen = []
    for i in range(30):
        S.append(table(spark, (f"k{i % 7}", i)), tmp, tag=f"e{i}")
        S.merge(spark, tmp, fan=3)
        seen.append(len(S.current(spark, tmp).parts))
    assert max(seen) <= 1 + 2 * 4 and S.current(spark, tmp).rows == 30  # two parts a tier and the last one
    assert rows(S.read(spark, tmp)) == sorted((f"k{i % 7}", i) for i in range(30))


def test_a_merge_gives_way_to_a_refresh(spark, tmp, monkeypatch):
    for i in range(4):
        S.append(table(spark, (str(i), i)), tmp)
    real = S.write_part

    def refreshed(df, root, tier=0, **about):
        part = real(df, root, tier, **about)
        if tier == 1:
            monkeypatch.setattr(S, "write_part", real)
            S.replace(table(spark, ("new", 0)), tmp)
        return part
    monkeypatch.setattr(S, "write_part", refreshed)
    S.merge(spark, tmp, fan=3)
    assert rows(S.read(spark, tmp)) == [("new", 0)]


def test_collections_and_stages_as_snapshots(spark, tmp):
    assert K.write_collection(table(spark, ("a", 1)), "db", "t", tmp, fmt="snapshot") == 1
    assert K.write_collection(table(spark, ("b", 1)), "db", "t", tmp, fmt="snapshot", mode="append") == 1
    assert K.insert_if_absent_into(table(spark, ("b", 7), ("c", 8), ("c", 9)), "db", "t", "_id", tmp, order="v", fmt="snapshot") == 1
    assert rows(K.read_collection(spark, "db", "t", tmp, fmt="snapshot")) == [("a", 1), ("b", 1), ("c", 8)]
    src = f"{tmp}/in"
    spark.createDataFrame([(1, "x", "n"), (2, "y", "m")], "k int, v string, extra string").write.option("header", True).csv(src)
    stages = etl.Stages(db="s", root=tmp, fmt="snapshot")
    for _ in range(2):  # re-runnable
        out = etl.run_etl(spark, src, stages, key="k")
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "x"), (2, "y")] and "extra" not in out.columns
