"""Incremental selection against a log of handled keys (L1).

Each run handles only keys the log does not hold: anti join against the log,
keep successful rows, take the top k, append the picked keys to the log.  Rows
that were not picked are offered again on the next run.

The log and the stored candidates are versioned tables (``sources/snapshots``):

* a run's keys become visible in one commit, checked against what other runs
  have logged since it began, so two runs at a time never log a key twice: the
  later one picks anew;
* a run or micro-batch that is repeated takes the place of its own part;
* parts are merged by size tiers, so a run reads O(log runs) files of log and
  candidates, and a merge of candidates keeps one row per key.

The streaming form separates arrival from selection: every micro-batch is
merged into a stored candidate table (one part per batch id, so a replayed
batch rewrites its own part), and a run picks from all candidates not handled
yet.  How the input is cut into batches therefore never changes a result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.operators.selection import crawl_select
from lodestone.operators.sorted_runs import top_k_of_runs
from lodestone.session import materialize
from lodestone.sources import snapshots

EPOCH = "_epoch"


def log_schema(key: str = "_id") -> T.StructType:
    return T.StructType([T.StructField(key, T.StringType()), T.StructField("batch", T.StringType())])


def read_key_log(spark: SparkSession, log_path: str, key: str = "_id",
                 exclude_batch: str | None = None) -> DataFrame:
    """The log as a one-column set of keys; empty when never written.
    ``exclude_batch`` leaves out one run's keys."""
    snap = snapshots.current(spark, log_path)
    if snap is None:
        return spark.createDataFrame([], log_schema(key)).select(key)
    df = snapshots.read_parts(spark, snap)
    if exclude_batch is not None:
        df = df.where(F.col("batch") != F.lit(exclude_batch))
    return df.select(key)


def _log_rows(keys: DataFrame, key: str, batch_id: str) -> DataFrame:
    return keys.select(F.col(key).cast("string").alias(key), F.lit(batch_id).alias("batch"))


def write_log_part(keys: DataFrame, log_path: str, batch_id: str, key: str = "_id") -> None:
    """(Re)write the log part of one run, as it is given."""
    snapshots.append(_log_rows(keys, key, batch_id), log_path, tag=batch_id)


def _logged(spark: SparkSession, log_path: str, key: str, batch_id: str, pick) -> DataFrame:
    """Log what ``pick(seen)`` picks; asked again when another run has logged
    one of the keys in between.  Returns the picked rows."""
    last: list[DataFrame] = []

    def rows(held: DataFrame | None) -> DataFrame:
        seen = held if held is not None else spark.createDataFrame([], log_schema(key)).select(key)
        last[:] = [materialize(pick(seen))]
        return _log_rows(last[0], key, batch_id)
    # the run's own part is left out, so a retry sees the log as the first
    # attempt saw it and picks the same rows
    snapshots.Insert(spark, log_path, [key], rows, log_schema(key), tag=batch_id, refill=True).commit()
    snapshots.merge(spark, log_path, sort=[key])
    return last[0]


def incremental_select(catalog: DataFrame, log_path: str, k: int, key: str = "_id",
                       order: str = "stars", ok: str = "ok", batch_id: str | None = None) -> DataFrame:
    """One run: pick up to k new, successful rows by ``order`` and log them.
    Returns the picked rows."""
    batch_id = batch_id or f"r{uuid.uuid4().hex[:12]}"
    return _logged(catalog.sparkSession, log_path, key, batch_id,
                   lambda seen: crawl_select(catalog, seen, k, key, order, ok))


def incremental_select_runs(spark: SparkSession, runs_path: str, log_path: str, k: int, key: str = "_id",
                            order: str = "stars", ok: str = "ok", batch_id: str | None = None) -> DataFrame:
    """``incremental_select`` from a catalog stored as runs sorted by ``order``
    (``operators/sorted_runs``): only their leading files are read."""
    batch_id = batch_id or f"r{uuid.uuid4().hex[:12]}"
    return _logged(spark, log_path, key, batch_id,
                   lambda seen: top_k_of_runs(spark, runs_path, k, order, key, ok=ok, seen=seen)[0])


def _latest(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the latest epoch's."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), EPOCH).alias("_r"))
    return best.select(*[F.col("_r").getField(c).alias(c) if c != key else F.col(key) for c in df.columns])


def store_epoch(batch: DataFrame, candidates_path: str, epoch: int, key: str = "_id") -> None:
    """Add one micro-batch to the candidates, in place of its earlier attempt,
    and merge full tiers (the last epochs stay parts of their own)."""
    snapshots.append(batch.withColumn(EPOCH, F.lit(epoch).cast("long")), candidates_path, tag=f"epoch={epoch}")
    snapshots.merge(batch.sparkSession, candidates_path, lambda df: _latest(df, key), sort=[key])


def read_candidates(spark: SparkSession, candidates_path: str, key: str = "_id") -> DataFrame:
    """All candidates that have arrived, one row per key: the latest batch's."""
    return _latest(snapshots.read(spark, candidates_path), key).drop(EPOCH)


def gather_candidates(stream: DataFrame, candidates_path: str, checkpoint_location: str,
                      available_now: bool = True, key: str = "_id"):
    """Start the stream that stores every micro-batch as a part of the
    candidate table; returns the streaming query."""
    def store(batch: DataFrame, epoch_id: int) -> None:
        store_epoch(batch, candidates_path, epoch_id, key)

    w = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def run_incremental_stream(stream: DataFrame, candidates_path: str, log_path: str, checkpoint_location: str,
                           k: int, key: str = "_id", order: str = "stars", ok: str = "ok",
                           batch_id: str | None = None) -> DataFrame:
    """One run over a stream: take in everything that has arrived, then pick
    up to k rows from all candidates the log does not hold and log them.
    Returns the picked rows.  Runs may be repeated; without new input a run
    picks the next k."""
    gather_candidates(stream, candidates_path, checkpoint_location, key=key).awaitTermination()
    spark = stream.sparkSession
    if snapshots.current(spark, candidates_path) is None:  # nothing has ever arrived
        return spark.createDataFrame([], stream.schema)
    return incremental_select(read_candidates(spark, candidates_path, key), log_path, k, key, order, ok, batch_id)
