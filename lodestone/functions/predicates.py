"""Filters and predicates: nested content tests, search, status flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the content test: a code cell counts when its source holds
# either literal (case-sensitive; the dot is a literal dot).
PANDAS_TERMS = ("import pandas", "pd.")
CODE_CELL = "code"


def _any_contains(text: Column, terms) -> Column:
    if isinstance(terms, str) or not terms:
        raise ValueError("terms must be a non-empty list of strings")
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def cells_contain(cells: Column, terms=PANDAS_TERMS, cell_type: str = CODE_CELL) -> Column:
    """Some cell of ``cell_type`` whose source holds one of ``terms``.

    A document that failed to parse (null ``cells``) counts as "does not
    contain" rather than null."""
    hit = F.exists(cells, lambda c: (c["cell_type"] == F.lit(cell_type))
                   & _any_contains(c["source"], terms))
    return F.coalesce(hit, F.lit(False))


def notebook_contains(df: DataFrame, terms=PANDAS_TERMS, cell_type: str = CODE_CELL,
                      cells: str = "cells", out: str = "contains") -> DataFrame:
    """Per notebook row: does it use the library (nested form)."""
    return df.withColumn(out, cells_contain(F.col(cells), terms, cell_type))


def cells_contain_grouped(df: DataFrame, key: str | list[str], type_col: str, text_col: str,
                          terms=PANDAS_TERMS, cell_type: str = CODE_CELL,
                          out: str = "contains") -> DataFrame:
    """The same test over cells stored one per row: an OR-aggregate per
    document.  Partial aggregation makes a document with very many cells as
    cheap as any other; no cell list is built."""
    keys = [key] if isinstance(key, str) else list(key)
    hit = (F.col(type_col) == F.lit(cell_type)) & _any_contains(F.col(text_col), terms)
    return df.groupBy(*keys).agg(F.coalesce(F.bool_or(hit), F.lit(False)).alias(out))


def search(df: DataFrame, term: str, extension: str, text_col: str = "text",
           path_col: str = "path") -> DataFrame:
    """Content-and-extension search: ``term in:file extension:ext``."""
    return df.where(F.contains(F.col(text_col), F.lit(term))
                    & F.endswith(F.col(path_col), F.lit("." + extension.lstrip("."))))


def succeeded(df: DataFrame, ok_col: str = "ok") -> DataFrame:
    """Keep successful outcomes only."""
    return df.where(F.col(ok_col))


def not_downloaded(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_downloaded"))


def pandas_unknown(df: DataFrame) -> DataFrame:
    """Rows whose ``has_pandas`` is not yet known (three-valued: null)."""
    return df.where(F.col("has_pandas").isNull())


def pending_run(df: DataFrame) -> DataFrame:
    """Downloaded, known to use pandas, not run yet."""
    return df.where(F.col("is_downloaded") & F.col("has_pandas") & ~F.col("is_run"))
