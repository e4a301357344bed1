"""Set membership, ranking and top-k selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.predicates import succeeded
from lodestone.session import global_index


def unseen(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """Rows whose key is not in ``seen`` (anti join).  No hint: AQE turns it
    into a broadcast join at run time while the seen-set is small and keeps
    the shuffled join once it is not."""
    s = seen.select(F.col(seen_key or key).alias(key))
    return df.join(s, key, "left_anti")


def rank_desc(df: DataFrame, order: str, key: str) -> DataFrame:
    """Sort by ``order`` descending, ties by ``key``."""
    return df.orderBy(F.col(order).desc(), F.col(key).asc())


TOPK_MERGE_ROWS = 10_000  # up to here one task merges k rows per partition; a choice of plan only


def top_k(df: DataFrame, k: int, order: str, key: str, merge_rows: int = TOPK_MERGE_ROWS) -> DataFrame:
    """The k largest by ``order`` (nulls last, ties by ``key``): exactly
    ``min(k, rows)`` rows, in that order, whatever k is.

    A small k plans as a per-partition top-k and a merge
    (``TakeOrderedAndProject``).  For a large k the rows are numbered in order
    on a range partitioning (``session.global_index``) and cut by number, so no
    task ever holds more than a partition."""
    return _first_rows(df, k, [F.col(order).desc_nulls_last(), F.col(key).asc_nulls_first()], merge_rows)


def first_n(df: DataFrame, n: int, key: str, merge_rows: int = TOPK_MERGE_ROWS) -> DataFrame:
    """The first n rows in key order (nulls first): ``head(n)`` with an
    explicit order, by the same two plans as ``top_k``."""
    return _first_rows(df, n, [F.col(key).asc_nulls_first()], merge_rows)


def _first_rows(df: DataFrame, k: int, sort: list, merge_rows: int) -> DataFrame:
    if k <= merge_rows:
        return df.orderBy(*sort).limit(k)
    numbered = global_index(df, *sort)
    return numbered.where(F.col("_index") < k).orderBy("_index").drop("_index")


def crawl_select(catalog: DataFrame, seen: DataFrame, k: int, key: str = "_id",
                 order: str = "stars", ok: str = "ok", seen_key: str | None = None) -> DataFrame:
    """Top-k of new and successful rows: already-seen rows and failed rows are
    removed before the cut, so they do not use up k."""
    return top_k(succeeded(unseen(catalog, seen, key, seen_key), ok), k, order, key)
