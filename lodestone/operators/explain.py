"""Partial-dependence curves for any scorer.

For each feature f and grid point x, the curve value is the mean over all
rows of the scorer's class probabilities with f replaced by x.  The plan:

1. one aggregate gives min/max of every feature (E9) -> grid points;
2. every row is expanded by ``explode`` over the global grid index
   (feature i owns indexes [i*points, (i+1)*points)) and the feature
   replaced, the scorer runs once for all classes, and the result goes
   straight into an average grouped by the integer grid index.

Step 2 is a narrow pipeline ending in a partial aggregation, so the
multiplied rows are never shuffled or stored: the exchange carries
features x points x partitions rows.  No row is sampled or dropped.

A Python model (``training.pandas_scorer``) takes each batch of rows to its
worker once and is asked at every grid point there; the task returns a sum and
a count per point and class, so rows x points cross no process boundary.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.columns import class_probability
from lodestone.session import spread

DEFAULT_POINTS = 30
# The y-range the curves are plotted in.
PLOT_LIMITS = (-0.4, 0.4)


def feature_ranges(df: DataFrame, features: list[str]) -> dict:
    """{feature: (min, max)} from one aggregation pass."""
    aggs = []
    for f in features:
        aggs += [F.min(f).cast("double").alias(f"mn_{f}"), F.max(f).cast("double").alias(f"mx_{f}")]
    r = df.agg(*aggs).first()
    return {f: (r[f"mn_{f}"], r[f"mx_{f}"]) for f in features}


def grid_points(mn: float, mx: float, points: int) -> list[float]:
    """``points`` equally spaced values over [mn, max]; none for a feature
    without any value (an empty or all-null column)."""
    if mn is None:
        return []
    if points == 1:
        return [mn]
    return [mn + (mx - mn) * i / (points - 1) for i in range(points)]


def pdp_grid(df: DataFrame, features: list[str], points: int = DEFAULT_POINTS) -> DataFrame:
    """The evaluation grid: (feature, grid_index, x) per feature."""
    ranges = feature_ranges(df, features)
    rows = [(f, i, x) for f in features for i, x in enumerate(grid_points(*ranges[f], points))]
    return df.sparkSession.createDataFrame(rows, "feature string, grid_index int, x double")


def partial_dependence(df: DataFrame, features: list[str], scorer: Callable[[DataFrame], DataFrame],
                       prob_cols: list[str], points: int = DEFAULT_POINTS, centre: bool = False,
                       ranges: dict | None = None) -> DataFrame:
    """Curves for every feature x class in one scoring pass.

    ``scorer(df) -> df`` adds the probability columns ``prob_cols`` (class i
    = ``prob_cols[i]``); any DataFrame function works: a SQL expression, an
    MLlib model's ``transform``, or a pandas UDF.  Returns
    (feature, grid_index, x, class, pd); results that are null or NaN count
    for no mean of a pandas scorer.  ``df`` is best a scan or a
    checkpointed frame: ``spread`` reads its partition count from planning
    (a frame with shuffles would have them run once for that check)."""
    ranges = ranges or feature_ranges(df, features)
    flat = [f for f in features if ranges[f][0] is None]  # no values, so no curve
    if flat:
        features = [f for f in features if f not in flat]
        if not features:
            return df.sparkSession.createDataFrame([], "feature string, grid_index int, x double, class int, pd double")
    xs = [x for f in features for x in grid_points(*ranges[f], points)]
    j = F.col("_j")  # global grid index: feature i owns j in [i*points, (i+1)*points)
    x_at = F.element_at(F.array(*[F.lit(x).cast("double") for x in xs]), j + 1)
    if hasattr(scorer, "in_batches"):
        avg = _batch_averages(df, [(f, x) for f in features for x in grid_points(*ranges[f], points)], scorer, prob_cols)
    else:
        expanded = spread(df).select("*", F.explode(F.sequence(F.lit(0), F.lit(len(xs) - 1))).alias("_j"))
        pos = {f: i for i, f in enumerate(features)}
        replaced = expanded.select(
            *[F.when((j >= pos[c] * points) & (j < (pos[c] + 1) * points), x_at).otherwise(F.col(c).cast("double"))
              .alias(c) if c in pos else F.col(f"`{c}`") for c in df.columns], "_j")
        scored = scorer(replaced)
        avg = scored.groupBy("_j").agg(*[F.avg(c).alias(f"_p{i}") for i, c in enumerate(prob_cols)])
    pairs = ", ".join(f"{i}, _p{i}" for i in range(len(prob_cols)))
    names = F.array(*[F.lit(f) for f in features])
    out = avg.select(F.element_at(names, (j / points).cast("int") + 1).alias("feature"),
                     (j % points).cast("int").alias("grid_index"), x_at.alias("x"),
                     F.expr(f"stack({len(prob_cols)}, {pairs}) as (class, pd)"))
    out = out.withColumn("class", F.col("class").cast("int"))
    if centre:
        out = out.withColumn("pd", F.col("pd") - F.avg("pd").over(Window.partitionBy("feature", "class")))
    return out


def _batch_averages(df: DataFrame, grid: list, scorer, prob_cols: list[str]) -> DataFrame:
    """(_j, _p0, ..): the mean result at every (feature, x) of ``grid``, each batch
    of rows scored at all of them in the task that reads it."""
    import numpy as np
    import pandas as pd

    predict_proba, cols, out_cols, load = scorer.in_batches
    k, at = len(prob_cols), [out_cols.index(c) for c in prob_cols]
    place = {c: i for i, c in enumerate(cols)}

    def run(batches):
        model, total, seen = None, np.zeros((len(grid), k)), np.zeros((len(grid), k), np.int64)
        first = True
        for X in batches:
            if first:
                model, first = load() if load is not None else None, False
            held, ones = X.to_numpy().T, np.ones(len(X))
            for j, (f, x) in enumerate(grid):
                here = held.copy(order="C")  # each time: the model may change its input
                if f in place:
                    here[place[f]] = x
                p = np.asarray(predict_proba(model, pd.DataFrame(here.T, columns=cols)), dtype="float64").reshape(len(X), len(out_cols))
                s, n = ones @ p, len(X)
                if np.isnan(s).any():
                    some = ~np.isnan(p)
                    s, n = np.where(some, p, 0).sum(axis=0), some.sum(axis=0)[at]
                total[j] += s[at]
                seen[j] += n
        if not first:
            yield pd.DataFrame({"_j": np.arange(len(grid)), **{f"_s{i}": total[:, i] for i in range(k)},
                                **{f"_n{i}": seen[:, i] for i in range(k)}})
    schema = "_j int" + "".join(f", _s{i} double" for i in range(k)) + "".join(f", _n{i} long" for i in range(k))
    rows = spread(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]))
    part = rows.mapInPandas(run, schema)
    return part.groupBy("_j").agg(*[(F.sum(f"_s{i}") / F.nullif(F.sum(f"_n{i}"), F.lit(0))).alias(f"_p{i}") for i in range(k)])


def clip_curve(curve: DataFrame, lo: float = PLOT_LIMITS[0], hi: float = PLOT_LIMITS[1],
               value: str = "pd") -> DataFrame:
    """Points of a curve inside the plotted y-range."""
    return curve.where(F.col(value).between(lo, hi))


def model_scorer(model, feature_cols: list[str], n_classes: int, prefix: str = "p"):
    """Scorer for a fitted MLlib ``PipelineModel`` whose first stage
    assembles ``feature_cols``: adds ``p0..p{n-1}`` (J3)."""
    def score(df: DataFrame) -> DataFrame:
        return model.transform(df).select(*[F.col(f"`{c}`") for c in df.columns],
                                          *[class_probability(i).alias(f"{prefix}{i}") for i in range(n_classes)])
    return score
