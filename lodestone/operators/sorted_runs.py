"""Top-k from stored runs that are sorted by the ranking column (F2).

``add_run`` stores rows as a part of a versioned table: range-partitioned and
sorted by (order descending, key), with a small side table of each file's
largest and smallest value and row count.  ``top_k_of_runs`` takes the files of
all runs in falling order of their largest value, wave by wave, and stops when
``k`` rows are held and no file that is left can hold a better one.  A catalog
of any size is read as far as its leading files; a run that skips many rows
(seen before, failed) just takes more waves, each four times the last.

Every key is expected once over all runs (insert-if-absent keeps it so).  Order
of the result: order descending, nulls last, then key, as ``top_k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.predicates import succeeded
from lodestone.operators.selection import top_k, unseen
from lodestone.session import materialize
from lodestone.sources import snapshots

#: Rows of one file of a run.
FILE_ROWS = 1_000_000
#: Files named in one wave, whatever their size.
WAVE_FILES = 10_000


def add_run(df: DataFrame, root: str, order: str, key: str, file_rows: int = FILE_ROWS) -> int:
    """Store the rows as one more sorted run; returns their number."""
    spark, root = df.sparkSession, root.rstrip("/")
    files = max(1, -(-df.count() // file_rows))
    sort = [F.col(order).desc_nulls_last(), F.col(key).asc_nulls_first()]
    part = snapshots.write_part(df.repartitionByRange(files, *sort).sortWithinPartitions(*sort), root)
    rows = spark.read.schema(df.schema).parquet(f"{root}/{part['path']}").select(order, F.input_file_name().alias("file"))
    stats = rows.groupBy("file").agg(F.max(order).alias("high"), F.min(order).alias("low"), F.count(F.lit(1)).alias("rows"))
    part["files"] = part["path"].replace("data/", "files/")
    stats.coalesce(1).write.parquet(f"{root}/{part['files']}")
    snapshots.append_part(spark, root, df.schema, part)
    return part["rows"]


def run_files(spark: SparkSession, snap: snapshots.Snapshot) -> DataFrame:
    """(file, high, low, rows) of every file of a version's runs."""
    return spark.read.parquet(*[f"{snap.root}/{p['files']}" for p in snap.parts if p["rows"]])


def _wave(files: DataFrame, after: tuple | None, rows: int) -> list:
    """The next files in falling order of ``high`` (null last), then name: as
    many as hold ``rows`` rows, one at least.  ``after`` is the last one taken."""
    order = [F.col("high").desc_nulls_last(), F.col("file")]
    if after is not None:
        high, name = after
        same = F.col("high").eqNullSafe(F.lit(high)) & (F.col("file") > F.lit(name))
        lower = F.lit(False) if high is None else F.col("high").isNull() | (F.col("high") < F.lit(high))
        files = files.where(same | lower)
    taken, n = [], 0
    for f in files.orderBy(*order).limit(WAVE_FILES).collect():
        taken.append(f)
        n += f["rows"]
        if n >= rows:
            break
    return taken


def top_k_of_runs(spark: SparkSession, root: str, k: int, order: str, key: str, ok: str | None = None,
                  seen: DataFrame | None = None, seen_key: str | None = None) -> tuple[DataFrame, list[str]]:
    """(rows, files read): the ``k`` best rows of the latest version that are
    successful (``ok``) and not in ``seen``, both optional."""
    snap = snapshots.current(spark, root)
    if snap is None:
        raise FileNotFoundError(f"no runs at {root}")
    best = spark.createDataFrame([], snap.schema)
    if not snap.rows or k <= 0:
        return best, []
    files, read, rows = materialize(run_files(spark, snap)), [], 2 * k
    wave = _wave(files, None, rows)
    while wave:
        read += [f["file"] for f in wave]
        df = spark.read.schema(snap.schema).parquet(*[f["file"] for f in wave])
        df = succeeded(df, ok) if ok else df
        df = unseen(df, seen, key, seen_key) if seen is not None else df
        best = materialize(top_k(df.select(*snap.schema.names).unionByName(best), k, order, key))
        held = best.agg(F.count(F.lit(1)).alias("n"), F.count(order).alias("v"), F.min(order).alias("least")).first()
        last, rows = wave[-1], 4 * rows
        wave = _wave(files, (last["high"], last["file"]), rows)
        # full, and what is left is smaller than the smallest held (equal values may still win by their key)
        if wave and held["v"] == k and (wave[0]["high"] is None or wave[0]["high"] < held["least"]):
            break
    return top_k(best, k, order, key), read
