import pytest
from pyspark.sql import functions as F

from lodestone.sources import collections as K


def test_copy_refuses_same_collection(spark, tmp):
    with pytest.raises(ValueError):
        K.copy_collection(spark, ("db", "a"), ("db", "a"), root=tmp)


def test_stage_copy_keeps_ids(spark, tmp):
    df = K.with_identity(spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), "k")
    K.write_collection(df, "db", "a", tmp)
    out = K.copy_collection(spark, ("db", "a"), ("db", "b"), root=tmp)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_empty_overwrite_writes_empty_table(spark, tmp):
    df = spark.createDataFrame([(1,)], "k int")
    K.write_collection(df, "db", "e", tmp)
    K.write_collection(df.limit(0), "db", "e", tmp)
    assert K.read_collection(spark, "db", "e", tmp).count() == 0


def test_identity_forms(spark):
    df = spark.createDataFrame([("o", "r", 3)], "owner string, repo string, k int")
    assert K.with_identity(df, ["owner", "repo"]).first()["_id"] == "o/r"
    assert len(K.with_identity(df, "k").first()["_id"]) == 32
    assert K.with_identity(K.with_identity(df, "k"), None).columns == ["_id", "owner", "repo", "k"]


def test_insert_if_absent_leaves_existing_rows(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, stars long")
    source = spark.createDataFrame([("b", 99), ("c", 5), ("c", 4), ("d", 7)], "_id string, stars long")
    out = {r._id: r.stars for r in K.insert_if_absent(target, source, "_id", order="stars").collect()}
    assert out == {"a": 1, "b": 2, "c": 4, "d": 7}


def test_samples_and_reports(spark, tmp):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    K.write_sample(df, f"{tmp}/s", "k", 10)
    back = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp}/s")
    assert [r.k for r in back.collect()] == list(range(10))
    doc = spark.createDataFrame([('{"a \\"b\\"": 1.5}',)], "report string")
    K.write_report(doc, f"{tmp}/r")
    assert [r[0] for r in spark.read.text(f"{tmp}/r").collect()] == ['{"a \\"b\\"": 1.5}']


def test_line_set_missing_is_empty(spark, tmp):
    from lodestone.sources.files import line_set
    assert line_set(spark, f"{tmp}/nope.txt").count() == 0
    with open(f"{tmp}/log.txt", "w") as fh:
        fh.write(" a/b\n a/b \nc/d\t\n")
    assert sorted(r[0] for r in line_set(spark, f"{tmp}/log.txt").collect()) == ["a/b", "c/d"]


def test_insert_if_absent_into_stored_collection(spark, tmp):
    first = spark.createDataFrame([("a", 1), ("b", 2)], "_id string, stars long")
    more = spark.createDataFrame([("b", 99), ("c", 3), ("c", 4)], "_id string, stars long")
    for fmt in ("snapshot", "parquet"):
        assert K.insert_if_absent_into(first, fmt, "repos", "_id", tmp, fmt=fmt) == 2
        assert K.insert_if_absent_into(more, fmt, "repos", "_id", tmp, order="stars", fmt=fmt) == 1
        assert K.insert_if_absent_into(more, fmt, "repos", "_id", tmp, order="stars", fmt=fmt) == 0  # second run adds nothing
        got = {r._id: r.stars for r in K.read_collection(spark, fmt, "repos", tmp, fmt).collect()}
        assert got == {"a": 1, "b": 2, "c": 3}


def test_materialize_keeps_callers_cache(spark):
    from pyspark import StorageLevel
    from lodestone.session import materialize
    df = spark.range(100).cache()
    df.count()
    out = materialize(df)
    assert out.count() == 100 and df.storageLevel != StorageLevel.NONE
    df.unpersist()


@pytest.mark.parametrize("spelling", ["{r}", "{r}/", "file:{r}", "{r}/../{b}"])
def test_overwrite_of_its_own_input_is_refused(spark, tmp, spelling):
    import os
    df = spark.createDataFrame([(1,), (2,)], "k int")
    K.write_collection(df, "db", "same", tmp, "parquet")
    same = K.read_collection(spark, "db", "same", tmp, "parquet")
    root = spelling.format(r=tmp, b=os.path.basename(tmp))
    with pytest.raises(ValueError):
        K.write_collection(same.where("k > 1"), "db", "same", root, "parquet")
    assert K.read_collection(spark, "db", "same", tmp, "parquet").count() == 2


def test_etl_with_one_name_for_two_stages_destroys_nothing(spark, tmp):
    from lodestone.plans import etl
    spark.createDataFrame([(1, "x")], "Id int, v string").write.option("header", True).csv(f"{tmp}/in")
    stages = etl.Stages(db="d", extract="same", transform="same", root=tmp, fmt="parquet")
    with pytest.raises(ValueError):
        etl.run_etl(spark, f"{tmp}/in", stages, key="Id")
    assert K.read_collection(spark, "d", "same", tmp, "parquet").count() == 1
    # a versioned table is replaced in one step, whatever reads it
    stages = etl.Stages(db="v", extract="same", transform="same", root=tmp)
    assert etl.run_etl(spark, f"{tmp}/in", stages, key="Id").count() == 1


def test_first_write_keeps_fields_when_the_order_is_null(spark):
    rows = spark.createDataFrame([("a", None, "repo-a"), ("b", None, "x"), ("b", 3, "y"), ("c", 1, "z"), ("c", 1, "w")],
                                 "_id string, stars long, repo string")
    for n in (1, 5):
        got = sorted(map(tuple, K.dedupe_first(rows.repartition(n), "_id", "stars").collect()))
        assert got == [("a", None, "repo-a"), ("b", 3, "y"), ("c", 1, "w")]  # ties: the smaller row


def test_first_write_with_a_map_column(spark):
    rows = spark.createDataFrame([("a", 1, {"k": "2"}), ("a", 1, {"k": "1"})], "_id string, stars long, m map<string,string>")
    assert K.dedupe_first(rows, "_id", "stars").first()["m"] == {"k": "1"}


def test_log_tables_append_and_missing_is_empty(spark, tmp):
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("a string, b int")
    assert K.read_log(spark, f"{tmp}/log", schema).count() == 0
    for i in range(2):
        K.append_log(spark.createDataFrame([("x", i)], schema), f"{tmp}/log")
    assert sorted(map(tuple, K.read_log(spark, f"{tmp}/log", schema).collect())) == [("x", 0), ("x", 1)]


def test_many_small_appends_are_few_parts(spark, tmp):
    import threading
    from lodestone.sources import snapshots
    from pyspark.sql import types as T
    schema = T._parse_datatype_string("a string, b int")

    def work(i):
        for k in range(4):
            K.append_log(spark.createDataFrame([(f"w{i}", k)], schema).coalesce(1), f"{tmp}/log", ["a"])
    threads = [threading.Thread(target=work, args=(i,)) for i in range(3)]  # at the same time: no row is lost
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(map(tuple, K.read_log(spark, f"{tmp}/log", schema).collect())) == [(f"w{i}", k) for i in range(3) for k in range(4)]
    assert len(snapshots.current(spark, f"{tmp}/log").parts) < 12
