"""Repository-crawl selection as one plan over tables.

The ranked search result is a catalog table; the download log is a line
file (or a log folder); a run picks the top k new and successful entries.
Fetching and cloning are outside Spark and not part of this plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.predicates import search
from lodestone.operators.selection import crawl_select
from lodestone.sources.files import line_set

# The default search (term in file, file extension) and the
# number of repositories one run keeps.
SEARCH_TERM = "pandas"
SEARCH_EXTENSION = "ipynb"
TARGET_COUNT = 5


def load_seen(spark: SparkSession, log_file: str, key: str = "_id") -> DataFrame:
    """Names already handled: the stripped, distinct lines of the log file;
    a missing file is an empty set."""
    return line_set(spark, log_file, key)


def select_run(catalog: DataFrame, seen: DataFrame, k: int = TARGET_COUNT, key: str = "_id",
               order: str = "stars", ok: str = "ok") -> DataFrame:
    """Top-k new and successful catalog rows in star order."""
    return crawl_select(catalog, seen, k, key, order, ok)


def search_hits(files: DataFrame, term: str = SEARCH_TERM, extension: str = SEARCH_EXTENSION,
                text_col: str = "text", path_col: str = "path") -> DataFrame:
    """Files matching ``term in:file extension:<ext>`` and the hit count."""
    hits = search(files, term, extension, text_col, path_col)
    return hits.agg(F.count(F.lit(1)).alias("total_count"))
