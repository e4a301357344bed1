"""Model training stages: preprocessing, grid search with cross-validation,
random forests, scoring.

MLlib does the distributed work: tree statistics are aggregated on the
executors, ``CrossValidator`` fits candidates in parallel.  Folds are the
stratified, seeded folds of ``sampling.stratified_folds`` passed as
``foldCol``, so fold membership does not depend on partitioning.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions.columns import class_probability, conform, drop_strict
from lodestone.operators.grid import fold_scores, grid_frame, param_grid
from lodestone.operators.labels import category_codes
from lodestone.operators.metrics import fold_score_summary, rounded_scores
from lodestone.session import laid_out

# The grid keys of the reference search map to these MLlib
# random-forest parameters.
FOREST_PARAM = {"n_estimators": "numTrees", "max_depth": "maxDepth", "random_state": "seed"}


def preprocess(df: DataFrame, drop=("Id",), label: str = "Species") -> DataFrame:
    """Preprocess stage: strict drop of the id column(s), label -> code."""
    return category_codes(drop_strict(df, *drop), label)


def with_class_count(df: DataFrame, label: str, n_classes: int) -> DataFrame:
    """Mark ``label`` as a nominal column with ``n_classes`` values (codes
    0..n-1), so MLlib classifiers read the class count from the schema
    instead of running a job per fit to find it."""
    meta = {"ml_attr": {"type": "nominal", "num_vals": int(n_classes), "name": label}}
    return df.withColumn(label, F.col(label).alias(label, metadata=meta))


def rule_grid_search(folded: DataFrame, grid: dict, correct, fold: str = "fold",
                     digits: int | None = 6) -> DataFrame:
    """Cross-validation table of a grid of SQL-expressible scorers:
    candidate, its parameters, mean and std of the fold scores, rank."""
    cands = param_grid(grid)
    scores = fold_scores(folded, fold, cands, correct)
    summary = fold_score_summary(scores, "candidate", "score", digits)  # ranked before it is rounded
    g = grid_frame(folded.sparkSession, grid)
    return g.join(summary, "candidate").select(
        "candidate", *sorted(grid), "mean_test_score", "std_test_score", "rank_test_score")


# --------------------------------------------------------------------------- MLlib

def forest(features: str = "features", label: str = "label", num_trees: int = 50,
           max_depth: int = 5, seed: int = 42, **kw):
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, **kw)


@contextmanager
def rows_for_fit(df: DataFrame, key: str | None = None):
    """The rows that a fit reads.  With ``key`` they are laid out
    (``session.laid_out``) once and kept on the executors' disks until the fit
    is done: MLlib asks for the rows of a fit several times, and each time a
    layout that is not kept is shuffled or sorted anew.  Memory is left to
    MLlib's own bagged rows."""
    if key is None:
        yield df
        return
    held = laid_out(df, key).persist(StorageLevel.DISK_ONLY)
    try:
        yield held
    finally:
        held.unpersist()


def fit_forest(df: DataFrame, feature_cols: list[str], label: str, num_trees: int = 50,
               max_depth: int = 5, seed: int = 42, n_classes: int | None = None, key: str | None = None):
    """Assemble the feature columns and fit a forest -> PipelineModel.
    ``n_classes`` (codes 0..n-1), when known, saves MLlib a pass to find it.
    Bagging depends on the partition layout; with ``key`` the layout follows
    from the data (``session.laid_out``), so the same rows and seed give the
    same forest on any cluster."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features"),
                            forest("features", label, num_trees, max_depth, seed)])
    with rows_for_fit(df, key) as rows:
        if n_classes is not None:
            rows = with_class_count(rows, label, n_classes)
        return without_summary(pipe.fit(rows))


def without_summary(model):
    """The fitted model without its training summary.  The summary keeps a
    reference to the session, which cannot be serialized into task
    closures once the session has recorded an ``Observation``; scoring
    with a summary-free copy always works (a reloaded model has none)."""
    return model.copy()


def grid_search(df: DataFrame, feature_cols: list[str], label: str, grid: dict, fold: str = "fold",
                parallelism: int = 4, metric: str = "accuracy", k: int = 3, key: str | None = None):
    """k-fold grid search over forest parameters with the given fold column
    (values 0..k-1);
    the best candidate is refitted on all rows.  Returns the
    ``CrossValidatorModel`` (``bestModel`` is a ``PipelineModel``).  ``key`` as
    in ``fit_forest``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator
    rf = forest("features", label)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="features"), rf])
    maps = [{rf.getParam(FOREST_PARAM.get(k, k)): v for k, v in cand.items()} for cand in param_grid(grid)]
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, foldCol=fold,
                        numFolds=k, parallelism=parallelism)
    with rows_for_fit(df, key) as rows:
        return cv.fit(rows)


def cv_results(cv_model, grid: dict, digits: int | None = 6) -> DataFrame:
    """Candidate table of a fitted search: parameters, mean and population
    std of the fold scores, rank (one row per candidate)."""
    spark = SparkSession.getActiveSession()
    g = grid_frame(spark, grid)
    stds = list(cv_model.stdMetrics) if cv_model.stdMetrics else [0.0] * len(cv_model.avgMetrics)
    rows = [(i, float(m), float(s)) for i, (m, s) in enumerate(zip(cv_model.avgMetrics, stds))]
    sc = spark.createDataFrame(rows, "candidate int, mean_test_score double, std_pop double")
    out = g.join(sc, "candidate").select(
        "candidate", *sorted(grid), "mean_test_score", F.col("std_pop").alias("std_test_score"),
        F.rank().over(Window.orderBy(F.col("mean_test_score").desc())).cast("int").alias("rank_test_score"))
    return rounded_scores(out, digits)


def best_model(cv_model):
    """The refitted best candidate of a search, ready for scoring."""
    return without_summary(cv_model.bestModel)


def best_params(cv_model, grid: dict) -> dict:
    """Parameters of the best candidate (highest mean, first on ties)."""
    m = list(cv_model.avgMetrics)
    return param_grid(grid)[m.index(max(m))]


def score(model, df: DataFrame) -> DataFrame:
    """Batch predict: adds ``prediction`` (and ``probability``)."""
    return model.transform(df)


def score_proba(model, df: DataFrame, n_classes: int, prefix: str = "p") -> DataFrame:
    """Batch class probabilities as plain columns ``p0..p{n-1}``."""
    return model.transform(df).select("*", *[class_probability(i).alias(f"{prefix}{i}") for i in range(n_classes)])


def train_stage(df: DataFrame, columns, split=None) -> DataFrame:
    """Train-stage output: the whole conformed frame (train and test rows);
    ``split`` (a Column, e.g. from ``sampling.with_split``) is added so the
    parts can be told apart."""
    out = conform(df, columns)
    if split is not None:
        out = out.withColumn("split", split)
    return out


def pandas_scorer(predict_proba, feature_cols: list[str], n_classes: int, prefix: str = "p",
                  load=None):
    """Scorer for a single-machine Python model (K1): ``predict_proba(model,
    X)`` on a pandas frame of ``feature_cols`` -> (rows x classes) array.

    Runs as an Arrow-batched iterator pandas UDF: ``load()`` (if given) is
    called once per task, then every batch is scored without per-row
    Python calls.  The result columns ``p0..p{n-1}`` are plain doubles.
    ``in_batches`` names the same model for operators that score a batch at
    many points where it stands (``explain.partial_dependence``).
    """
    from collections.abc import Iterator

    import numpy as np
    import pandas as pd

    out_cols = [f"{prefix}{i}" for i in range(n_classes)]
    schema = ", ".join(f"{c} double" for c in out_cols)

    def _score(batches):
        model = load() if load is not None else None
        for X in batches:
            p = np.asarray(predict_proba(model, X[list(feature_cols)]), dtype="float64")
            yield pd.DataFrame(p.reshape(len(X), n_classes), columns=out_cols)

    _score.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(_score, f"struct<{schema}>")

    def score(df: DataFrame) -> DataFrame:
        s = udf(F.struct(*[F.col(c).cast("double").alias(c) for c in feature_cols]))
        return df.select("*", s.alias("_s")).select(*[F.col(f"`{c}`") for c in df.columns],
                                                    *[F.col(f"_s.{c}") for c in out_cols])
    score.in_batches = (predict_proba, list(feature_cols), out_cols, load)
    return score
