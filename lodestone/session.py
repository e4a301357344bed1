"""Session, shared scratch folder and size-checked join helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured size is at most this many bytes;
# above it the join is left to Catalyst/AQE (sort-merge or shuffled hash).
DEFAULT_BROADCAST_BYTES = 64 << 20
_BROADCAST_CONF = "lodestone.broadcast.maxBytes"
#: Rows of one partition when a small input is laid out anew.
ROWS_PER_PARTITION = 50_000


def get_session(master: str | None = None, app: str = "lodestone",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Return the active session or build one with AQE and skew handling on.

    On a cluster the caller normally passes its own session; this builder is
    what tests, the bench and the examples use.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of frames that are no longer referenced are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Stage tables, logs, model versions and intermediate tables all live below
    it.  A folder of our own is created only in local mode, where driver and
    executors are one process; on a cluster a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lodestone-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared folder."""
    return "/".join([shared_dir(spark), "lodestone", uuid.uuid4().hex, *parts])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of its own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def broadcast_byte_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(_BROADCAST_CONF, str(DEFAULT_BROADCAST_BYTES)))


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: strings and binaries by their length,
    nested values by the length of their JSON, others eight."""
    total = F.lit(8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0))
    return total


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with ``small`` broadcast only when its bytes, measured by one
    aggregate over it, are within the limit."""
    size = small.agg(F.sum(_row_bytes(small)).alias("b")).first()["b"] or 0
    if size <= broadcast_byte_limit(big.sparkSession):
        small = F.broadcast(small)
    return big.join(small, on, how)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows over at least ``partitions`` partitions (default: the
    session's ``spark.sql.shuffle.partitions``) before CPU-heavy row work.  A
    scan with as many splits is returned unchanged (no shuffle).  Results must
    not depend on the layout; where they would (forest fits), ``laid_out`` is
    used instead."""
    target = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def laid_out(df: DataFrame, key: str, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """The rows in a layout that follows from the data alone: as many hash
    partitions by ``key`` as the row count asks for, each sorted by ``key``.
    The same rows give the same partitions on any cluster."""
    n = max(1, -(-df.count() // rows_per_partition))
    return df.repartition(n, F.col(key)).sortWithinPartitions(key)


def materialize(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table below the shared folder, read back: computed
    once, lineage cut, column-pruned reads, and statistics for the planner.
    Survives executor loss."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_index(df: DataFrame, *order: Column, out: str = "_index") -> DataFrame:
    """Number the rows from 0 in the given order, at any size: a range
    partitioning sorts the rows, each partition's row count (a number per
    partition) gives the offsets, and no task holds more than a partition."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                       .withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = held.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_p").collect()
    rows, before = [], 0
    for r in counts:
        rows.append((r["_p"], before))
        before += r["_n"]
    offsets = df.sparkSession.createDataFrame(rows, "_p long, _before long")
    return (held.withColumn("_p", part).join(F.broadcast(offsets), "_p")
            .withColumn(out, F.col("_before") + F.col("_at") - F.shiftleft(F.col("_p"), 33))
            .drop("_p", "_before", "_at"))


def small_table(df: DataFrame) -> DataFrame:
    """A small intermediate result that several later steps read: computed
    once and kept as a table (its size tells the planner to broadcast it)."""
    return materialize(df)
