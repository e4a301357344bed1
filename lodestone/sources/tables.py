"""Table-shaped sources: literal records and the repository catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Repository catalog record (one row per repository, keyed by "owner/name").
CATALOG_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType(), False),
    T.StructField("repo_name", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("stars", T.LongType()),
    T.StructField("clone_url", T.StringType()),
    T.StructField("has_pandas", T.BooleanType(), True),
    T.StructField("is_downloaded", T.BooleanType()),
    T.StructField("is_run", T.BooleanType()),
    T.StructField("dataset_name", T.StringType(), True),
])


def literal_source(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A few records given in code (for example ``{"value": 42}``)."""
    return spark.createDataFrame(rows, schema)


def catalog_scan(df: DataFrame) -> DataFrame:
    """Conform a table to the catalog record: exact columns and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CATALOG_SCHEMA.fields])


def catalog_from_documents(documents: DataFrame, seen: DataFrame | None = None,
                           seen_key: str = "doc_id") -> DataFrame:
    """Stand-in catalog built from the ``documents`` table: owner = source,
    name = ``doc<id>``, stars = ``n_chars``; ``is_downloaded`` marks ids
    present in ``seen``; ``has_pandas`` stays unknown (null)."""
    d = documents.select("doc_id", "source", "n_chars", "lang")
    if seen is not None:
        s = seen.select(F.col(seen_key).alias("doc_id")).distinct().withColumn("_seen", F.lit(True))
        d = d.join(s, "doc_id", "left")
    else:
        d = d.withColumn("_seen", F.lit(False))
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    return catalog_scan(d.select(
        F.concat_ws("/", F.col("source"), name).alias("_id"),
        name.alias("repo_name"),
        F.col("source").alias("owner"),
        F.col("n_chars").alias("stars"),
        F.concat(F.lit("https://example.org/"), F.col("source"), F.lit("/"), name, F.lit(".git")).alias("clone_url"),
        F.lit(None).cast("boolean").alias("has_pandas"),
        F.coalesce(F.col("_seen"), F.lit(False)).alias("is_downloaded"),
        F.lit(False).alias("is_run"),
        F.lit(None).cast("string").alias("dataset_name"),
    ))
