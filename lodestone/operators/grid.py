"""Parameter grids and fold-score tables for grid search."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The grid searched by the training pipeline.
DEFAULT_GRID = {"n_estimators": [50, 100], "max_depth": [3, 5], "random_state": [42]}


def param_grid(grid: dict) -> list[dict]:
    """Candidates of a parameter grid in search order: keys sorted by name,
    the last key varying fastest.  Bounded by the product of list lengths."""
    keys = sorted(grid)
    return [dict(zip(keys, vals)) for vals in product(*[list(grid[k]) for k in keys])]


def grid_frame(spark: SparkSession, grid: dict) -> DataFrame:
    """The candidates as a table: ``candidate`` index plus one column per
    parameter."""
    cands = param_grid(grid)
    keys = sorted(grid)
    rows = [(i, *[c[k] for k in keys]) for i, c in enumerate(cands)]
    schema = ", ".join(["candidate int", *[f"`{k}` {_sql_type(grid[k])}" for k in keys]])
    return spark.createDataFrame(rows, schema)


def _sql_type(values) -> str:
    vals = list(values)
    if all(isinstance(v, bool) for v in vals):
        return "boolean"
    if all(isinstance(v, int) and not isinstance(v, bool) for v in vals):
        return "int" if all(-2**31 <= v < 2**31 for v in vals) else "bigint"
    if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vals):
        return "double"
    return "string"


def fold_scores(df: DataFrame, fold: str, candidates: list[dict], correct) -> DataFrame:
    """Score of every candidate on every fold in one aggregation pass.

    ``correct(params) -> Column`` says per row whether the candidate's
    prediction is right; the per-candidate means are computed side by side in
    one grouped aggregate and unpivoted to (candidate, fold, score), so the
    rows are never multiplied by the number of candidates."""
    aggs = [F.avg(correct(p).cast("double")).alias(f"c{i}") for i, p in enumerate(candidates)]
    wide = df.groupBy(fold).agg(*aggs)
    pairs = ", ".join(f"{i}, c{i}" for i in range(len(candidates)))
    return wide.select(F.col(fold), F.expr(f"stack({len(candidates)}, {pairs}) as (candidate, score)")) \
        .select(F.col("candidate").cast("int").alias("candidate"), F.col(fold).alias("fold"), "score")
