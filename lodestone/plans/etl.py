"""Staged extract -> transform -> load between named collections.

Each step is a ``DataFrame -> DataFrame`` function; the stage writes are the
only actions.  Row identity (``_id``) is set on the first write and carried
through the later stages unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.columns import conform, drop_cols, drop_strict, identity, scale
from lodestone.sources.collections import copy_collection, read_collection, write_collection, with_identity
from lodestone.sources.files import csv_scan


@dataclass(frozen=True)
class Stages:
    """Where the three stage collections live."""
    db: str = "etl"
    extract: str = "extract"
    transform: str = "transform"
    load: str = "load"
    root: str | None = None
    fmt: str = "snapshot"


def extract(spark: SparkSession, csv_path: str, stages: Stages, key: str | None = None,
            delimiter: str = ",", schema=None) -> DataFrame:
    """CSV -> extract collection, each row given an ``_id``."""
    df = with_identity(csv_scan(spark, csv_path, delimiter=delimiter, schema=schema), key)
    write_collection(df, stages.db, stages.extract, stages.root, stages.fmt)
    return read_collection(spark, stages.db, stages.extract, stages.root, stages.fmt)


def transform(spark: SparkSession, stages: Stages, drop=("extra", "Id"), strict: bool = False) -> DataFrame:
    """Extract collection -> drop columns -> transform collection."""
    df = read_collection(spark, stages.db, stages.extract, stages.root, stages.fmt)
    out = drop_strict(df, *drop) if strict else drop_cols(df, *drop)
    write_collection(out, stages.db, stages.transform, stages.root, stages.fmt)
    return read_collection(spark, stages.db, stages.transform, stages.root, stages.fmt)


def load(spark: SparkSession, stages: Stages) -> DataFrame:
    """Transform collection copied to the load collection (values and ids equal)."""
    return copy_collection(spark, (stages.db, stages.transform), (stages.db, stages.load),
                           stages.root, stages.fmt)


def run_etl(spark: SparkSession, csv_path: str, stages: Stages, key: str | None = None,
            drop=("extra", "Id"), strict: bool = False, delimiter: str = ",") -> DataFrame:
    """The three steps in order; returns the load collection."""
    extract(spark, csv_path, stages, key, delimiter)
    transform(spark, stages, drop, strict)
    return load(spark, stages)


def run_etl_counted(spark: SparkSession, csv_path: str, stages: Stages, key: str | None = None,
                    drop=("extra", "Id"), delimiter: str = ",") -> DataFrame:
    """The chain with the row count of every stage, each observed while the
    stage is written: (stage, n)."""
    counts = []
    df = with_identity(csv_scan(spark, csv_path, delimiter=delimiter), key)
    counts.append(("extract", write_collection(df, stages.db, stages.extract, stages.root, stages.fmt)))
    ext = read_collection(spark, stages.db, stages.extract, stages.root, stages.fmt)
    counts.append(("transform", write_collection(drop_cols(ext, *drop), stages.db, stages.transform,
                                                 stages.root, stages.fmt)))
    tr = read_collection(spark, stages.db, stages.transform, stages.root, stages.fmt)
    counts.append(("load", write_collection(tr, stages.db, stages.load, stages.root, stages.fmt)))
    return spark.createDataFrame(counts, "stage string, n long")


def expl_pipeline(spark: SparkSession, src: DataFrame, columns, stages: Stages, key: str | None = None) -> DataFrame:
    """Explainability pipeline stages: extract (with ids) -> identity
    preprocess -> "train" stage = the conformed columns (label left as
    text) (H9).  Returns the train collection."""
    write_collection(with_identity(src, key), stages.db, stages.extract, stages.root, stages.fmt)
    pre = identity(read_collection(spark, stages.db, stages.extract, stages.root, stages.fmt))
    write_collection(pre, stages.db, stages.transform, stages.root, stages.fmt)
    train = conform(read_collection(spark, stages.db, stages.transform, stages.root, stages.fmt), columns)
    write_collection(train, stages.db, stages.load, stages.root, stages.fmt)
    return read_collection(spark, stages.db, stages.load, stages.root, stages.fmt)


def value_pipeline(df: DataFrame, value: str = "value", k=2) -> DataFrame:
    """extract -> transform -> load of a value record: the record is passed
    as a struct, its field is read and doubled."""
    rec = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("data"))
    cols = [F.col(f"data.{c}") for c in df.columns if c != value]
    return scale(rec.select(*cols, F.col(f"data.{value}").alias(value)), value, k)
