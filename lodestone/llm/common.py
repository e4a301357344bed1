"""Small Spark helpers of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.session import read_table, scratch_path

__all__ = ["read_table", "stored", "narrow", "filtered", "fold_of", "fold_ascii", "small_batches", "batches_of", "running_blocks"]

BATCH_ROWS = 1000


def stored(df: DataFrame, *name: str) -> DataFrame:
    """``df`` as a Parquet table below the shared folder, read back.  Cuts the
    lineage and survives lost executors; later plans read only the columns
    they need."""
    path = scratch_path(df.sparkSession, "llm", *name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, **columns) -> DataFrame:
    """Only the named columns, ``new=old`` (a name or a Column): extra columns
    of the input, whatever their names, never meet ours."""
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def filtered(df: DataFrame, keep) -> DataFrame:
    """The rows of ``df`` for which ``keep(batch)``, a boolean array per Arrow
    batch, holds.  Columns travel under neutral names, so any name is allowed."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(keep(b), pa.bool_()))
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def fold_of(doc_id, n: int):
    """``crc32`` of the id as text, modulo ``n`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def fold_ascii(c: Column) -> Column:
    """A-Z in lower case, all other characters as they are.  ``lower`` does that for
    texts of ASCII alone (as many bytes as characters) and is much faster."""
    slow = F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(slow)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let at most ``rows`` rows travel to Python at a time in this session: with
    whole texts in the rows, Spark's default of 10,000 makes batches of tens
    of megabytes on both sides of every running task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int = BATCH_ROWS):
    """``small_batches`` for the jobs run inside the ``with`` block only."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def running_blocks(df: DataFrame, size: str, limit: int, *order) -> DataFrame:
    """``df`` as a stored table with a ``block`` and a unique ``row`` number: rows in
    the given order, cut where the running sum of ``size`` passes a multiple of
    ``limit``.  A block holds less than ``limit`` plus its last row.  One number
    per partition of the sorted table comes to the driver."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = stored(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                  .withColumn("at_", F.monotonically_increasing_id()), "ordered").withColumn("part_", F.shiftright("at_", 33))
    rows, before = [], 0
    for r in held.groupBy("part_").agg(F.sum(size).alias("n")).orderBy("part_").collect():
        rows.append((r["part_"], before))
        before += r["n"] or 0
    offsets = df.sparkSession.createDataFrame(rows, "part_ long, before_ long")
    inside = F.sum(size).over(Window.partitionBy("part_").orderBy("at_").rowsBetween(Window.unboundedPreceding, -1))
    return stored(held.join(F.broadcast(offsets), "part_")
                  .withColumn("block", F.floor((F.col("before_") + F.coalesce(inside, F.lit(0))) / F.lit(limit)))
                  .withColumnRenamed("at_", "row").drop("part_", "before_"), "blocks")
