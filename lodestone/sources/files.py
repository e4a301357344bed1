"""File scans: CSV with header and inferred types, line files used as sets,
and nested notebook documents."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.columns import strip_ws
from lodestone.session import path_exists

# One notebook document: the fields the content test reads.  ``source`` (in the
# older layout ``input``) is a string; when a file holds it as a list of strings
# the JSON reader stores the raw JSON text of the list, which still answers a
# substring test.
_CELLS = T.ArrayType(T.StructType([T.StructField("cell_type", T.StringType()), T.StructField("source", T.StringType()),
                                   T.StructField("input", T.StringType())]))
NOTEBOOK_SCHEMA = T.StructType([
    T.StructField("cells", _CELLS),
    T.StructField("worksheets", T.ArrayType(T.StructType([T.StructField("cells", _CELLS)]))),
])


#: Tasks per core that list the files of a scan.
LISTING_TASKS = 8


def csv_scan(spark: SparkSession, path: str, delimiter: str = ",",
             header: bool = True, infer: bool = True,
             schema: T.StructType | str | None = None,
             sampling_ratio: float | None = None) -> DataFrame:
    """CSV with a header row and inferred column types (empty field = null).

    Inference costs one extra pass over the files; at scale pass ``schema``
    (or a ``sampling_ratio``) so the scan is a single pass.
    """
    r = spark.read.option("delimiter", delimiter).option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer)
        if sampling_ratio:
            r = r.option("samplingRatio", sampling_ratio)
    return r.csv(path)


def labelled_source(df: DataFrame, feature_cols: list[str], target_col: str,
                    target_name: str = "target") -> DataFrame:
    """Feature columns plus an integer target under ``target_name``."""
    return df.select(*[F.col(c) for c in feature_cols],
                     F.col(target_col).cast("int").alias(target_name))


def line_set(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Lines of a text file as a set: stripped, distinct; missing file -> empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType())]))
    return spark.read.text(path).select(strip_ws(F.col("value")).alias(name)).distinct()


@contextmanager
def _listing_tasks(spark: SparkSession):
    """Let many paths be listed by a few tasks per core; Spark's default is a task
    per path up to 10,000, which take longer to start than to list."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def notebook_scan(spark: SparkSession, path: str, with_path: bool = True) -> DataFrame:
    """One JSON notebook per file -> ``(path, cells)``: a row per file.  The
    older layout (``worksheets[].cells[]`` with ``input``) is read as the newer
    one; files that are not one JSON object get null ``cells``."""
    with _listing_tasks(spark):
        files = spark.read.option("wholetext", True).text(path)
    raw = files.select(F.col("_metadata.file_path").alias("path"), "value")
    # a document is an object; an array at the top is no notebook
    doc = F.when(F.ltrim(F.regexp_replace("value", r"^[\s\uFEFF]+", "")).startswith("{"), F.col("value"))
    parsed = raw.select("path", F.from_json(doc, NOTEBOOK_SCHEMA).alias("d"))
    sheets = F.flatten(F.transform("d.worksheets", lambda w: F.coalesce(w["cells"], F.array().cast(_CELLS))))
    cells = F.transform(F.coalesce("d.cells", sheets), lambda c: F.struct(
        c["cell_type"].alias("cell_type"), F.coalesce(c["source"], c["input"]).alias("source")))
    out = parsed.select("path", cells.alias("cells"))
    return out if with_path else out.select("cells")
