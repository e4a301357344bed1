"""The model pipeline: preprocess -> split -> grid search -> evaluate ->
register -> explain, on Spark end to end.

The search runs on MLlib (trees are grown from statistics aggregated on the
executors; candidates are fitted in parallel); the split and the folds are
the exact seeded operators of ``sampling``; metrics are aggregates over the
scored test rows; the registry is a set of tables below ``root``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.columns import format_name
from lodestone.operators import explain, forest_curves, metrics, registry, sampling, training
from lodestone.operators.grid import DEFAULT_GRID
from lodestone.session import materialize
from lodestone.sources.collections import write_report, write_sample

QUALITY_FEATURES = ["n_chars", "n_words", "n_lines", "letter_share", "distinct_word_share"]
ORDER_FEATURES = ["price_noisy", "month", "year", "o_custkey"]


def document_features(docs: DataFrame, *keep: str) -> DataFrame:
    """Per document, from its whole text: characters, words, lines, share of
    letters, share of distinct words; ``keep`` names columns passed through.
    The text is split once, in a step of its own that feeds both word features."""
    words = F.col("_words")
    n_words = F.when(F.length(F.trim(F.col("text"))) == 0, 0).otherwise(F.size(words))
    return docs.withColumn("_words", F.split(F.trim(F.col("text")), r"\s+")).select(
        "doc_id", F.col("n_chars").cast("double").alias("n_chars"),
        n_words.cast("double").alias("n_words"),
        F.size(F.split(F.col("text"), "\n")).cast("double").alias("n_lines"),
        (F.length(F.regexp_replace("text", r"\P{L}+", "")) / F.greatest(F.length("text"), F.lit(1)))
        .alias("letter_share"),
        (F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1))).alias("distinct_word_share"), *keep)


def quality_data(docs: DataFrame, lab: DataFrame) -> DataFrame:
    """Labelled documents: features + ``quality`` (0/1).  The labels are joined
    first, so only the texts of labelled documents are read into words."""
    lab = lab.select("doc_id", F.col("quality").cast("int").alias("quality"))
    labelled = docs.join(lab, "doc_id")
    return document_features(labelled, "quality")


def order_data(orders: DataFrame) -> DataFrame:
    """Orders with a price band label (0: < 100,000; 1: < 250,000; 2: else)
    and features: price with key-derived noise, month, year, customer."""
    p = F.col("o_totalprice")
    return orders.select(
        "o_orderkey",
        F.when(p < 100000, 0).when(p < 250000, 1).otherwise(2).alias("band"),
        (p + F.pmod(F.col("o_orderkey") * 7919, F.lit(40000)) - 20000).cast("double").alias("price_noisy"),
        F.month("o_orderdate").cast("double").alias("month"), F.year("o_orderdate").cast("double").alias("year"),
        F.col("o_custkey").cast("double").alias("o_custkey"))


def prepare(data: DataFrame) -> DataFrame:
    """The model input as one stored table.  The features are derived from
    whole texts and MLlib passes over its input many times (split histograms,
    folds, every fit); the table holds only the compact feature rows and cuts
    the lineage back to the texts."""
    return materialize(data)


def labelled_rows(data: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """(rows that can be learned from, number without a label, number of
    classes).  A null label, or its category code -1, is no class: such rows are
    left out of the fit and counted."""
    has = F.coalesce(F.col(label) >= 0, F.lit(False))
    r = data.agg(F.count_if(~has).alias("none"), F.max(label).alias("top")).first()
    return data.where(has), r["none"] or 0, int(r["top"] if r["top"] is not None else -1) + 1


def train_and_register(spark: SparkSession, data: DataFrame, features: list[str], label: str, key: str,
                       root: str, model_name: str, grid: dict = DEFAULT_GRID, k: int = 3, seed: int = 42,
                       test_size: float = 0.2, experiment: str = "ml", parallelism: int = 4,
                       artifacts_dir: str | None = None, dataset: str = "data") -> dict:
    """Split, search, evaluate on the held-out rows, register the refitted
    best model and log the run.  Returns the result tables.  Every call is a
    run of its own.  The test rows are scored once; report, matrix and accuracy
    are all derived from that one table of counts."""
    data, unlabelled, n_classes = labelled_rows(prepare(data), label)
    if n_classes > 0:  # codes 0..n-1: the class count travels in the schema, not a job per fit
        data = training.with_class_count(data, label, n_classes)
    split = sampling.with_split(data, key, test_size, seed)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test")
    folded = sampling.stratified_folds(train, label, key, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    cvm = training.grid_search(folded, features, label, grid, "fold", parallelism, k=k, key=key)
    cv = training.cv_results(cvm, grid)
    best = training.best_model(cvm)
    scored = training.score(best, test).withColumn("prediction", F.col("prediction").cast("int"))
    counts = metrics.confusion_counts(scored, label, "prediction", materialize=True)
    exact = metrics.report_from_counts(counts, digits=None)
    right = F.sum(F.when(F.col("actual").eqNullSafe(F.col("predicted")), F.col("n")).otherwise(0))
    acc = counts.agg((right / F.sum("n")).alias("accuracy"))
    run_id = registry.new_run_id(experiment, model_name)
    version = registry.register_model(spark, best, model_name, root, run_id, test.select(*features), scored.select("prediction"))
    artifacts = [("model", f"{model_name}/{version}")]
    if artifacts_dir:
        write_sample(train.drop("split"), f"{artifacts_dir}/dataset_samples", key)
        write_report(metrics.report_json(exact), f"{artifacts_dir}/evaluation")
        write_report(metrics.matrix_json(metrics.dense_cells(counts)), f"{artifacts_dir}/confusion_matrix")
        artifacts += [(d, f"{artifacts_dir}/{d}") for d in ("dataset_samples", "evaluation", "confusion_matrix")]
    tags = [("model_type", "RandomForestClassifier"), ("dataset", dataset)]
    _log_run(spark, root, run_id, experiment, cv, training.best_params(cvm, grid), acc, grid, tags, artifacts)
    folded.unpersist()
    return {"cv": cv, "report": metrics.report_from_counts(counts), "confusion": metrics.dense_cells(counts),
            "accuracy": acc, "version": version, "model": best, "split": split, "run_id": run_id,
            "unlabelled": unlabelled, "n_classes": n_classes, "scored": scored}


def _log_run(spark, root, run_id, experiment, cv, best, acc, grid, tags, artifacts) -> None:
    keys = sorted(grid)
    runs = spark.createDataFrame([(run_id, None, experiment, "train")], registry.SCHEMAS["runs"])
    kid = F.concat(F.lit(run_id + "/"), F.col("candidate").cast("string")).alias("run_id")
    kids = cv.select(kid, F.lit(run_id).alias("parent_run_id"), F.lit(experiment).alias("experiment"),
                     format_name(registry.CHILD_RUN_NAME, F.col("candidate")).alias("run_name"))
    registry.log_rows(runs.unionByName(kids), root, "runs")
    params = [(run_id, k, str(v)) for k, v in best.items()]
    child_params = registry.melt_params(cv.select(
        kid, F.create_map(*[x for kk in keys for x in (F.lit(kk), F.col(kk).cast("string"))]).alias("params")))
    registry.log_rows(spark.createDataFrame(params, registry.SCHEMAS["params"]).unionByName(child_params), root, "params")
    m = acc.select(F.lit(run_id).alias("run_id"), F.lit("accuracy").alias("key"),
                   F.col("accuracy").alias("value"), F.lit(0).cast("long").alias("step"))
    cm = cv.select(kid, F.explode(F.create_map(F.lit("mean_test_score"), F.col("mean_test_score"),
                                               F.lit("std_test_score"), F.col("std_test_score"))).alias("key", "value"),
                   F.lit(0).cast("long").alias("step"))
    registry.log_rows(m.unionByName(cm), root, "metrics")
    registry.log_rows(spark.createDataFrame([(run_id, k, v, 0) for k, v in tags], registry.SCHEMAS["tags"]), root, "tags")
    registry.log_rows(spark.createDataFrame([(run_id, d, p) for d, p in artifacts], registry.SCHEMAS["artifacts"]), root, "artifacts")


def explain_latest(spark: SparkSession, data: DataFrame, features: list[str], root: str, model_name: str,
                   n_classes: int, points: int = explain.DEFAULT_POINTS) -> DataFrame:
    """Partial-dependence curves of the latest registered version of a model
    for every feature and class, over all rows of ``data``.  A forest's follow
    from leaf counts (one pass, any number of points); other models score
    rows x points."""
    model = registry.load_latest(spark, root, model_name)
    if forest_curves.is_plain_forest(model):
        return forest_curves.curves(data.select(*features), model, features, points)
    scorer = explain.model_scorer(model, features, n_classes)
    return explain.partial_dependence(data.select(*features), features, scorer,
                                      [f"p{i}" for i in range(n_classes)], points)


def run_ml_pipeline(spark: SparkSession, csv_path: str, stages, registry_root: str, model_name: str,
                    id_col: str = "Id", label: str = "Species", features: list[str] | None = None,
                    grid: dict = DEFAULT_GRID, k: int = 3, seed: int = 42, test_size: float = 0.2,
                    points: int = explain.DEFAULT_POINTS, artifacts_dir: str | None = None) -> dict:
    """The whole model pipeline as one call over named collections:

    extract (CSV -> collection, rows get an ``_id`` derived from ``id_col``, so
    split and folds repeat for the same input and seed) -> preprocessing (strict
    drop of ``id_col``, label -> code) -> train (conform to the features and
    the label, seeded split keyed on ``_id``, k-fold grid search, held-out
    metrics, register the refitted best model, write the train stage with
    its split column) -> explain (partial dependence of the latest
    registered version for every feature and class)."""
    from lodestone.plans import etl
    from lodestone.sources.collections import read_collection, write_collection

    etl.extract(spark, csv_path, stages, key=id_col)
    ext = read_collection(spark, stages.db, stages.extract, stages.root, stages.fmt)
    write_collection(training.preprocess(ext, drop=(id_col,), label=label),
                     stages.db, stages.transform, stages.root, stages.fmt)
    pre = read_collection(spark, stages.db, stages.transform, stages.root, stages.fmt)
    if features is None:
        numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
        features = [f.name for f in pre.schema.fields
                    if f.name not in (label, "_id") and f.dataType.simpleString() in numeric]
    cols = [(f, "double") for f in features] + [(label, "int"), ("_id", "string")]
    data = training.train_stage(pre, cols)
    res = train_and_register(spark, data, features, label, "_id", registry_root, model_name, grid, k, seed,
                             test_size, experiment=stages.db, artifacts_dir=artifacts_dir,
                             dataset=f"{stages.db}.{stages.transform}")
    write_collection(res["split"], stages.db, stages.load, stages.root, stages.fmt)
    train = read_collection(spark, stages.db, stages.load, stages.root, stages.fmt)
    res["curves"] = materialize(explain_latest(spark, train, features, registry_root, model_name, res["n_classes"], points))
    res["explain_run_id"] = registry.log_explanation(spark, res["curves"], registry_root, stages.db, model_name)
    res["features"] = features
    return res
