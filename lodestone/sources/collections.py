"""Named collections: the stage store between pipeline steps.

A collection ``db.name`` is a table below a store root (by default a folder
under the shared ``spark.checkpoint.dir``).  By default it is a versioned table
(``snapshot``): refreshes and inserts are atomic and checked for conflicts
(``snapshots.py``).  The format is pluggable: ``parquet`` and other file formats
for plain folders that any tool reads, ``table`` for a catalog table
``db.name``, or any Spark data source such as a document-store connector, which
then receives ``database``/``collection`` options.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.session import materialize, path_exists, shared_dir
from lodestone.sources import snapshots

FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro"}


def store_root(spark: SparkSession) -> str:
    root = spark.conf.get("lodestone.store.root", None)
    return (root or f"{shared_dir(spark)}/lodestone-store").rstrip("/")


def collection_path(spark: SparkSession, db: str, name: str, root: str | None = None) -> str:
    return f"{(root or store_root(spark)).rstrip('/')}/{db}/{name}"


def read_collection(spark: SparkSession, db: str, name: str, root: str | None = None,
                    fmt: str = "snapshot", **options) -> DataFrame:
    """Match-all scan of a collection; filters and projections applied later
    are pushed into the scan by Catalyst."""
    if fmt == "snapshot":
        return snapshots.read(spark, collection_path(spark, db, name, root))
    if fmt in FILE_FORMATS:
        return spark.read.format(fmt).options(**options).load(collection_path(spark, db, name, root))
    if fmt == "table":  # a catalog table db.name
        return spark.table(f"`{db}`.`{name}`")
    return (spark.read.format(fmt).option("database", db).option("collection", name)
            .options(**options).load())


def write_collection(df: DataFrame, db: str, name: str, root: str | None = None,
                     fmt: str = "snapshot", mode: str = "overwrite", **options) -> int:
    """Overwrite (full refresh) or append a collection; returns the number of
    rows written (E1), observed during the write, not by a second pass.

    Old rows of a versioned table stay readable until the new ones are
    committed, so a write that fails changes nothing.  An overwrite of plain
    files first removes the old ones, so a frame that reads the very collection
    it would overwrite is refused there: the write would destroy its own input.
    An empty frame writes an empty table.
    """
    spark = df.sparkSession
    if fmt == "snapshot":
        change = snapshots.replace if mode == "overwrite" else snapshots.append
        return change(df, collection_path(spark, db, name, root))
    if mode == "overwrite" and fmt in FILE_FORMATS:
        _refuse_own_input(df, collection_path(spark, db, name, root))
    elif mode == "overwrite" and fmt == "table" and spark.catalog.tableExists(f"`{db}`.`{name}`"):
        _refuse_own_input(df, *spark.table(f"`{db}`.`{name}`").inputFiles())
    obs = Observation(f"rows_{db}_{name}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if fmt in FILE_FORMATS:
        counted.write.format(fmt).mode(mode).options(**options).save(
            collection_path(spark, db, name, root))
    elif fmt == "table":  # a catalog table db.name in the session's warehouse
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        counted.write.mode(mode).options(**options).saveAsTable(f"`{db}`.`{name}`")
    else:
        (counted.write.format(fmt).mode(mode).option("database", db).option("collection", name)
         .options(**options).save())
    return int(obs.get.get("rows", 0))


def _refuse_own_input(df: DataFrame, *targets: str) -> None:
    """Raise when a frame reads files at or below one of the target paths
    (compared as the file system names them, so another spelling of the same
    place counts)."""
    spark = df.sparkSession
    conf = spark._jsc.hadoopConfiguration()

    def plain(path: str) -> str:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        u = p.getFileSystem(conf).makeQualified(p).toUri()
        return f"{u.getScheme()}://{u.getAuthority() or ''}{posixpath.normpath(u.getPath())}"
    wanted = [plain(t) for t in targets]
    for f in df.inputFiles():
        f = plain(f)
        if any(f == w or f.startswith(w + "/") for w in wanted):
            raise ValueError(f"the frame reads {f}, which overwriting its target would delete")


def copy_collection(spark: SparkSession, src: tuple[str, str], dst: tuple[str, str],
                    root: str | None = None, fmt: str = "snapshot") -> DataFrame:
    """Load stage: read one collection and overwrite another with the same
    rows (``_id`` included).  Refuses ``src == dst``: overwriting a file table
    while reading it deletes its input before the read."""
    if tuple(src) == tuple(dst):
        raise ValueError(f"source and target collection are the same: {src[0]}.{src[1]}")
    df = read_collection(spark, *src, root=root, fmt=fmt)
    write_collection(df, *dst, root=root, fmt=fmt)
    return read_collection(spark, *dst, root=root, fmt=fmt)


def with_identity(df: DataFrame, key=None, name: str = "_id") -> DataFrame:
    """Give each row a string identity unless it already has ``name``.

    ``key`` a column name -> md5 of its text (repeatable); a list of names ->
    the parts joined by ``/`` (``owner/repo``); None -> a random uuid, fixed
    once the stage is written.
    """
    if name in df.columns:
        return df
    if key is None:
        ident = F.expr("uuid()")
    elif isinstance(key, (list, tuple)):
        ident = F.concat_ws("/", *[F.col(k).cast("string") for k in key])
    else:
        ident = F.md5(F.col(key).cast("string"))
    return df.select(ident.alias(name), *[F.col(f"`{c}`") for c in df.columns])


def dedupe_first(df: DataFrame, key: str | list[str], order: str | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` value (the first
    write wins).  An aggregate, not a window, so partial aggregation keeps a
    hot key from landing whole in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    # a total order over the row: a null order value comes last, ties are
    # settled by the other columns (a map as its sorted entries)
    parts = [F.col(f"`{order}`").isNull(), F.col(f"`{order}`")] if order else []
    for f in df.schema.fields:
        if f.name not in keys:
            c = F.col(f"`{f.name}`")
            c = F.array_sort(F.map_entries(c)) if isinstance(f.dataType, T.MapType) else c
            parts += [c.isNull(), c]
    rank = F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), rank).alias("_r"))
    return picked.select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest]).select(*[F.col(f"`{c}`") for c in df.columns])


def insert_if_absent(target: DataFrame, source: DataFrame, key: str | list[str],
                     order: str | None = None) -> DataFrame:
    """Upsert with set-on-insert: rows of ``source`` whose key is not in
    ``target`` are added; existing target rows are left untouched."""
    keys = [key] if isinstance(key, str) else list(key)
    new = dedupe_first(source.select(*target.columns), keys, order)
    delta = new.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(delta)


def insert_if_absent_delta(target: DataFrame, source: DataFrame, key: str | list[str],
                           order: str | None = None) -> DataFrame:
    """Only the rows ``insert_if_absent`` would add (append them to the
    stored target instead of rewriting it)."""
    keys = [key] if isinstance(key, str) else list(key)
    new = dedupe_first(source.select(*target.columns), keys, order)
    return new.join(target.select(*keys), keys, "left_anti")


def insert_if_absent_into(source: DataFrame, db: str, name: str, key: str | list[str],
                          root: str | None = None, order: str | None = None, fmt: str = "snapshot") -> int:
    """Insert-if-absent into a stored collection: only the rows whose key is
    not stored yet are appended; stored rows are never rewritten.  The delta
    is stored before the append, so the write does not read the table
    it extends.  Returns the number of rows added.  Of two writers at a time a key
    is added once; only writers of plain files do not see each other."""
    spark = source.sparkSession
    if fmt == "snapshot":
        return begin_insert(source, db, name, key, root, order).commit()
    if not path_exists(spark, collection_path(spark, db, name, root)):  # the first insert creates it
        keys = [key] if isinstance(key, str) else list(key)
        return write_collection(dedupe_first(source, keys, order), db, name, root, fmt)
    target = read_collection(spark, db, name, root, fmt)
    delta = materialize(insert_if_absent_delta(target, source, key, order))
    return write_collection(delta, db, name, root, fmt, mode="append")


def begin_insert(source: DataFrame, db: str, name: str, key: str | list[str], root: str | None = None,
                 order: str | None = None) -> snapshots.Insert:
    """Insert-if-absent into a versioned collection, begun now and added by its
    ``commit()``: a key that another writer commits in between stays theirs."""
    spark, path = source.sparkSession, collection_path(source.sparkSession, db, name, root)
    keys = [key] if isinstance(key, str) else list(key)
    have = snapshots.current(spark, path)
    schema = have.schema if have else source.schema
    new = dedupe_first(source.select(*[f"`{f.name}`" for f in schema.fields]), keys, order)
    return snapshots.Insert(spark, path, keys, lambda held: new if held is None else new.join(held, keys, "left_anti"), schema)


def append_log(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """Append rows to a log table (A13): a versioned table, so an append is seen
    whole or not at all, appends at the same time all stay, and the many small
    parts of many appends are merged by size tiers (rows ordered by ``sort``, a
    column that readers filter on, so that files can be left out)."""
    snapshots.append(df, path)
    snapshots.merge(df.sparkSession, path, sort=sort)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A log table, empty with ``schema`` when it was never written."""
    snap = snapshots.current(spark, path)
    if snap is None:
        return spark.createDataFrame([], schema)
    return snapshots.read_parts(spark, snap).select(*[F.col(f"`{f.name}`") for f in schema.fields])


def write_sample(df: DataFrame, path: str, key: str, n: int = 10) -> None:
    """First ``n`` rows by ``key`` as one CSV file with header, no index."""
    df.orderBy(key).limit(n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """JSON report sink: the one-row, one-column document of
    ``metrics.report_json`` as a text file."""
    report.coalesce(1).write.mode("overwrite").text(path)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.count(), len(df.columns)

