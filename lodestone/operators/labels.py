"""Label tables: distinct sorted labels, category codes, code -> name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import global_index, join_small


def distinct_labels(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null labels, sorted (E4).  Partial aggregation per
    partition before the shuffle, so the exchange carries at most
    (partitions x labels) rows."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def label_list(df: DataFrame, *cols: str) -> list:
    """Sorted distinct non-null values over one or more columns as a driver
    list.  For callers who want names in hand (a pivot, ``decode_label``); no
    operator of this package needs it."""
    parts = [df.select(F.col(c).alias("_l")) for c in cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return [r[0] for r in u.where(F.col("_l").isNotNull()).distinct().orderBy("_l").collect()]


def label_codes(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Label table: each distinct non-null label with its index in sorted
    order, for any number of labels."""
    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_index(labels, F.col(col), out=code).select(col, F.col(code).cast("int").alias(code))


def category_codes(df: DataFrame, col: str, out: str | None = None, missing: int = -1,
                   names: list | None = None) -> DataFrame:
    """Replace a label by its category code: index among the sorted distinct
    labels, ``missing`` (-1) for null (W1).  The label table is joined
    (broadcast when its bytes allow), so the number of labels is not limited."""
    out = out or col
    if names is not None:
        return encode_with_list(df, col, names, out, missing)
    codes = label_codes(df, col, "_code").select(F.col(col).alias("_lab"), "_code")
    return _coded(df, codes, col, out, missing)


def _coded(df: DataFrame, codes: DataFrame, col: str, out: str, missing: int) -> DataFrame:
    joined = join_small(df, codes, F.col(f"`{col}`") == F.col("_lab"), "left")
    code = F.coalesce(F.col("_code"), F.lit(missing)).cast("int")
    cols = [code.alias(out) if c == out else F.col(f"`{c}`") for c in df.columns]
    if out not in df.columns:
        cols.append(code.alias(out))
    return joined.select(*cols)


def encode_with_list(df: DataFrame, col: str, names: list, out: str | None = None,
                     missing: int = -1) -> DataFrame:
    """Category code from a known label list (no pass over the data)."""
    codes = df.sparkSession.createDataFrame([(n, i) for i, n in enumerate(names)],
                                            f"_lab {df.schema[col].dataType.simpleString()}, _code int")
    return _coded(df, codes, col, out or col, missing)
