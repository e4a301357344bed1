"""Projections and scalar functions.  All built-in Spark expressions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters Python's str.strip() removes (whitespace by str.isspace):
# ASCII whitespace, the separators \x1c-\x1f, NEL and the Unicode separators.
_WS = r"[\s\x1c-\x1f\x85\p{Z}]"


def _q(name: str) -> Column:
    """Exact, quoted column reference."""
    return F.col(f"`{name}`")


def drop_cols(df: DataFrame, *names: str) -> DataFrame:
    """Lenient drop: names not present are ignored (Spark's own ``drop``)."""
    return df.drop(*names)


def drop_strict(df: DataFrame, *names: str) -> DataFrame:
    """Strict drop: every name must be a column, compared case-sensitively.

    Only the exact names are removed, even when the session resolves names
    case-insensitively (``Id`` and ``id`` are different columns here).
    """
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}; available: {df.columns}")
    return df.select(*[_q(c) for c in df.columns if c not in names])


def identity(df: DataFrame) -> DataFrame:
    return df


def conform(df: DataFrame, columns) -> DataFrame:
    """Conform to a column list: order as given, drop extra columns, add the
    missing ones as typed nulls.  ``columns`` is a list of ``(name, type)``
    pairs or a ``StructType``; names compare exactly."""
    if isinstance(columns, T.StructType):
        columns = [(f.name, f.dataType) for f in columns.fields]
    have = set(df.columns)
    out = []
    for name, typ in columns:
        if name in have:
            c = _q(name)
            out.append((c.cast(typ) if typ is not None else c).alias(name))
        else:
            out.append(F.lit(None).cast(typ or "string").alias(name))
    return df.select(*out)


def split_xy(df: DataFrame, target: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Features and target as two frames; both keep ``key`` when given so they
    can be paired again by join (position carries no meaning in Spark)."""
    keep = [key] if key else []
    x = df.select(*[_q(c) for c in df.columns if c != target])
    y = df.select(*[_q(c) for c in keep], _q(target))
    return x, y


def scale(df: DataFrame, column: str, k=2, out: str | None = None) -> DataFrame:
    """``column * k`` (replacing the column unless ``out`` is given)."""
    return df.withColumn(out or column, F.col(column) * F.lit(k))


def class_probability(i: int, prob_col: str = "probability") -> Column:
    """Probability of class ``i`` from a probability vector column."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(prob_col))[i]


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing whitespace the way Python's ``strip`` does
    (tabs, newlines and Unicode separators too, not only spaces)."""
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def format_metric(c: Column, digits: int = 4) -> Column:
    """Fixed-precision text of a number (``f"{x:.4f}"``): half-even rounding
    of the exact binary value, no digit grouping."""
    pattern = "0." + "0" * digits if digits > 0 else "0"
    return F.call_function("format_number", c, F.lit(pattern))


def format_name(template: str, *cols: Column) -> Column:
    """Formatted name from parts, ``format_name("Child_Run_CV_%d", idx)``."""
    return F.format_string(template, *cols)


def decode_label(code: Column, names: list[str]) -> Column:
    """Class code -> class name from a fixed name list (codes outside the list,
    and the missing code -1, give null)."""
    arr = F.array(*[F.lit(n) for n in names])
    return F.when((code >= 0) & (code < len(names)), F.element_at(arr, (code + 1).cast("int")))
