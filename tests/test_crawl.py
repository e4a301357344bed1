"""Top-k selection against a log, incremental runs and the streaming form (F1, F2, L1)."""
from pyspark.sql import functions as F

from sf_dirs import SF_SMALL
from lodestone.operators.selection import crawl_select
from lodestone.session import read_table
from lodestone.streaming import incremental as I


def _catalog(spark):
    d = read_table(spark, SF_SMALL, "documents")
    return d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("_id"),
                    F.col("n_chars").alias("stars"), (F.col("lang") != "de").alias("ok"))


def test_skipped_and_failed_do_not_use_up_k(spark):
    cat = spark.createDataFrame([("a", 10, True), ("b", 9, True), ("c", 8, False), ("d", 7, True), ("e", 7, True)],
                                "_id string, stars long, ok boolean")
    seen = spark.createDataFrame([("a",)], "_id string")
    assert [r._id for r in crawl_select(cat, seen, 3).collect()] == ["b", "d", "e"]  # tie on stars -> by _id


def test_incremental_runs_until_exhausted(spark, tmp):
    cat = _catalog(spark)
    ok_total = cat.where("ok").count()
    log = f"{tmp}/log"
    sizes = []
    for i in range(4):
        I.incremental_select(cat, log, 60, batch_id=f"r{i}")
        sizes.append(I.read_key_log(spark, log).count())
    keys = [r[0] for r in I.read_key_log(spark, log).collect()]
    assert len(keys) == len(set(keys)) == ok_total
    assert sizes[-1] == sizes[-2] == ok_total  # the last run adds nothing


def test_replayed_run_is_idempotent(spark, tmp):
    cat = _catalog(spark)
    log = f"{tmp}/log"
    I.incremental_select(cat, log, 20, batch_id="r0")
    first = {r._id for r in I.incremental_select(cat, log, 20, batch_id="r1").collect()}
    again = {r._id for r in I.incremental_select(cat, log, 20, batch_id="r1").collect()}  # retry
    assert first == again
    keys = [r[0] for r in I.read_key_log(spark, log).collect()]
    assert len(keys) == len(set(keys)) == 40


def _arrivals(spark, tmp, n=5):
    """The documents as ``n`` files that a stream takes in one by one."""
    docs = read_table(spark, SF_SMALL, "documents")
    docs.repartition(n, "doc_id").write.parquet(f"{tmp}/src")
    return docs


def _stream(spark, docs, tmp, files=1):
    s = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", files).parquet(f"{tmp}/src")
    return s.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("_id"),
                    F.col("n_chars").alias("stars"), (F.col("lang") != "de").alias("ok"))


def _keys(spark, log):
    return sorted(r[0] for r in I.read_key_log(spark, log).collect())


def test_stream_does_not_depend_on_batches_and_takes_the_next_k(spark, tmp):
    """One run logs the k best of all that has arrived, however the input is cut
    into micro-batches; the next run takes the next k, although nothing new came."""
    docs = _arrivals(spark, tmp)
    batch_log = f"{tmp}/batch-log"
    want = []
    for r in range(3):
        I.incremental_select(_catalog(spark), batch_log, 30, batch_id=f"r{r}")
        want.append(_keys(spark, batch_log))
    for files in (1, 4):
        log = f"{tmp}/log{files}"
        for r in range(3):
            picked = I.run_incremental_stream(_stream(spark, docs, tmp, files), f"{tmp}/cand{files}", log, f"{tmp}/ck{files}", 30)
            assert picked.count() == 30 and _keys(spark, log) == want[r]


def test_stream_offers_old_and_new_rows(spark, tmp):
    """Files that arrive later compete with the rows not picked before."""
    docs = read_table(spark, SF_SMALL, "documents")
    docs.where("doc_id < 100").write.parquet(f"{tmp}/src/part1")
    s = lambda: spark.readStream.schema(docs.schema).parquet(f"{tmp}/src/*").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("_id"), F.col("n_chars").alias("stars"), F.lit(True).alias("ok"))
    run = lambda: I.run_incremental_stream(s(), f"{tmp}/cand", f"{tmp}/log", f"{tmp}/ck", 10)
    first = {r._id for r in run().collect()}
    docs.where("doc_id >= 100").write.parquet(f"{tmp}/src/part2")
    second = {r._id for r in run().collect()}
    rows = sorted(((-r.n_chars, f"d{r.doc_id}", r.doc_id) for r in docs.select("doc_id", "n_chars").collect()))
    assert first == {i for _, i, _ in [x for x in rows if x[2] < 100][:10]}
    assert second == {i for _, i, _ in [x for x in rows if x[1] not in first][:10]}


def test_replayed_batch_rewrites_its_part(spark, tmp):
    df = spark.createDataFrame([("a", 1, True), ("b", 2, True)], "_id string, stars long, ok boolean")
    for rows in (df, df.where("_id = 'a'")):  # batch 0 again, with another outcome
        I.store_epoch(rows, f"{tmp}/cand", 0)
    I.store_epoch(df.withColumn("stars", F.lit(9).cast("long")), f"{tmp}/cand", 1)
    got = {r._id: r.stars for r in I.read_candidates(spark, f"{tmp}/cand").collect()}
    assert got == {"a": 9, "b": 9}


def test_stream_without_any_input(spark, tmp):
    import os
    os.makedirs(f"{tmp}/src")
    s = spark.readStream.schema("_id string, stars long, ok boolean").parquet(f"{tmp}/src")
    assert I.run_incremental_stream(s, f"{tmp}/cand", f"{tmp}/log", f"{tmp}/ck", 3).count() == 0


def test_two_runs_at_a_time_log_no_key_twice(spark, tmp, monkeypatch):
    """A second run logs its picks while the first one is about to: the first
    picks anew and both together log the best 2k."""
    cat, log = _catalog(spark), f"{tmp}/log"
    real, other = I.snapshots.Insert.commit, []

    def commit(self):
        if not other:
            other.append(True)
            I.incremental_select(cat, log, 20, batch_id="second")
        return real(self)
    monkeypatch.setattr(I.snapshots.Insert, "commit", commit)
    first = {r._id for r in I.incremental_select(cat, log, 20, batch_id="first").collect()}
    keys = _keys(spark, log)
    assert len(keys) == len(set(keys)) == 40 and first <= set(keys)
    best = crawl_select(cat, spark.createDataFrame([], "_id string"), 40)
    assert keys == sorted(r._id for r in best.collect())


def test_history_does_not_grow_a_run(spark, tmp):
    """Parts of the candidates and the log are merged: logarithmic in epochs,
    same candidates as without merging."""
    want, most = {}, 0
    for e in range(40):
        rows = [(f"k{(e * 7 + j) % 50}", e * 3 + j, j != 2) for j in range(4)]
        want.update({r[0]: r for r in rows})
        I.store_epoch(spark.createDataFrame(rows, "_id string, stars long, ok boolean").coalesce(1), f"{tmp}/cand", e)
        most = max(most, len(I.snapshots.current(spark, f"{tmp}/cand").parts))
    assert most <= 2 * I.snapshots.FAN  # 40 epochs: one tier of fewer than FAN parts above another
    assert sorted(map(tuple, I.read_candidates(spark, f"{tmp}/cand").collect())) == sorted(want.values())
