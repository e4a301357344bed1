"""Experiment-log and model-registry tables.

What a tracking server records is kept as tables below a registry root:

* ``runs(run_id, parent_run_id, experiment, run_name)``
* ``params(run_id, key, value)``
* ``metrics(run_id, key, value, step)``
* ``tags(run_id, key, value, seq)``
* ``artifacts(run_id, dir, path)``
* ``models(name, version, uri, run_id)``
* ``signatures(run_id, side, position, name, type)``
* ``explanations(run_id, feature, grid_index, x, class, pd)``

Writing is an append to a versioned table (trainers at the same time lose no
rows, small parts are merged); reading is a scan; every query below is an ordinary
aggregate or join, so they work for any number of runs.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.columns import format_name
from lodestone.session import small_table
from lodestone.sources.collections import append_log, read_log

SCHEMAS = {
    "runs": "run_id string, parent_run_id string, experiment string, run_name string",
    "params": "run_id string, key string, value string",
    "metrics": "run_id string, key string, value double, step long",
    "tags": "run_id string, key string, value string, seq long",
    "artifacts": "run_id string, dir string, path string",
    "models": "name string, version int, uri string, run_id string",
    "signatures": "run_id string, side string, position int, name string, type string",
    "explanations": "run_id string, feature string, grid_index int, x double, class int, pd double",
}
#: The column that queries filter on: merged parts are in its order.
SORTED = {"runs": ["experiment"], "params": ["run_id"], "metrics": ["run_id"], "models": ["name"]}
# Fixed value: the name of a search candidate's run.
CHILD_RUN_NAME = "Child_Run_CV_%d"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def new_run_id(experiment: str, name: str) -> str:
    """A run id that no other run has."""
    return f"{experiment}/{name}/{uuid.uuid4().hex[:16]}"


def log_rows(df: DataFrame, root: str, table: str) -> None:
    """Append rows to one of the tracking tables (schema enforced)."""
    schema = T._parse_datatype_string(SCHEMAS[table])
    append_log(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]),
               table_path(root, table), SORTED.get(table))


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A tracking table; empty with its schema when nothing was logged yet."""
    return read_log(spark, table_path(root, table), T._parse_datatype_string(SCHEMAS[table]))


# ----------------------------------------------------------------- queries

def experiment_runs(runs: DataFrame, experiment: str) -> DataFrame:
    """Runs of one experiment (I1); over the stored table the filter reaches the
    scan, which leaves out row groups of other experiments."""
    return runs.where(F.col("experiment") == F.lit(experiment))


def child_rollup(runs: DataFrame, metrics: DataFrame, metric: str) -> DataFrame:
    """Per parent run: number of child runs and the best child by ``metric``
    (highest value, then smallest run name) (I2)."""
    m = metrics.where(F.col("key") == metric).groupBy("run_id").agg(F.max_by("value", "step").alias("v"))
    kids = runs.where(F.col("parent_run_id").isNotNull()).join(m, "run_id", "left")
    order = F.struct((-F.coalesce(F.col("v"), F.lit(float("-inf")))).alias("nv"), F.col("run_name"))
    return kids.groupBy(F.col("parent_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.min_by("run_name", order).alias("best_child"),
        F.max("v").alias(f"best_{metric}"))


def melt_params(df: DataFrame, key: str = "run_id", params: str = "params") -> DataFrame:
    """A map column of parameters -> one (run_id, key, value) row each."""
    return df.select(key, F.explode(F.col(params)).alias("key", "value")) \
        .select(key, "key", F.col("value").cast("string").alias("value"))


def wide_metrics(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Latest value (highest step) of each metric key as columns."""
    latest = (metrics.where(F.col("key").isin(keys))
              .groupBy("run_id", "key").agg(F.max_by("value", "step").alias("value")))
    return latest.groupBy("run_id").pivot("key", keys).agg(F.first("value"))


def leaderboard(runs: DataFrame, params: DataFrame, metrics: DataFrame,
                metric_keys: list[str], param_keys: list[str]) -> DataFrame:
    """One row per run that has the metrics: run, its parameters and the
    latest metric values as columns (I4).  Keys are given so the pivots need
    no extra pass to find them."""
    p = params.where(F.col("key").isin(param_keys)).groupBy("run_id").pivot("key", param_keys).agg(F.first("value"))
    m = wide_metrics(metrics, metric_keys)
    return runs.join(m, "run_id").join(p, "run_id", "left")


def current_tags(tags: DataFrame) -> DataFrame:
    """Tag values as last written: the highest ``seq`` per (run, key)."""
    return tags.groupBy("run_id", "key").agg(F.max_by("value", "seq").alias("value"))


def artifact_index(artifacts: DataFrame) -> DataFrame:
    """Artifact paths grouped by run and directory (I6); a path logged twice
    is one artifact (the later upload replaces the earlier).  Distinct first,
    so repeated uploads do not reach the list of a directory."""
    return (artifacts.select("run_id", "dir", "path").distinct()
            .groupBy("run_id", "dir").agg(F.sort_array(F.collect_list("path")).alias("paths"))
            .withColumn("n", F.size("paths").cast("long")))


def signature(spark: SparkSession, inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input and output schema as rows (side, position, name, type)."""
    rows = [("inputs", i, f.name, f.dataType.simpleString()) for i, f in enumerate(inputs.schema.fields)]
    rows += [("outputs", i, f.name, f.dataType.simpleString()) for i, f in enumerate(outputs.schema.fields)]
    return spark.createDataFrame(rows, "side string, position int, name string, type string")


def latest_versions(models: DataFrame) -> DataFrame:
    """Latest version per model name, with its uri (W3/D6).  An aggregate
    (max_by), so a name with very many versions is still partially
    aggregated per partition."""
    return models.groupBy("name").agg(F.max("version").alias("version"),
                                      F.max_by("uri", "version").alias("uri"),
                                      F.max_by("run_id", "version").alias("run_id"))


def model_uri(name, version) -> F.Column:
    """``models:/<name>/<version>``."""
    return format_name("models:/%s/%s", name, version)


def next_version(spark: SparkSession, root: str, name: str) -> int:
    v = read(spark, root, "models").where(F.col("name") == name).agg(F.max("version")).first()[0]
    return (v or 0) + 1


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next free version of a name, claimed by creating its marker file
    without overwriting: of two trainers one gets it, the other the next."""
    version = next_version(spark, root, name)
    while True:
        marker = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path(root, 'versions')}/{name}/{version}")
        fs = marker.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(marker):
            try:
                fs.create(marker, False).close()
                return version
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                    raise
        version += 1


def register_model(spark: SparkSession, model, name: str, root: str, run_id: str | None = None,
                   inputs: DataFrame | None = None, outputs: DataFrame | None = None) -> int:
    """Save a fitted MLlib model under a path of its own and add it to
    ``models`` with the next version number (I8).  With ``inputs`` and
    ``outputs`` their schemas are logged as the run's signature, and five input
    rows are kept beside the model as an example."""
    path = f"{root.rstrip('/')}/store/{name}/{uuid.uuid4().hex}"
    model.write().save(path)
    if inputs is not None:
        inputs.limit(5).coalesce(1).write.json(f"{path}-input_example")
        if run_id is not None:
            sig = signature(spark, inputs, outputs if outputs is not None else inputs.limit(0).select())
            log_rows(sig.withColumn("run_id", F.lit(run_id)), root, "signatures")
    version = claim_version(spark, root, name)
    row = spark.createDataFrame([(name, version, path, run_id)], SCHEMAS["models"])
    log_rows(row, root, "models")
    return version


def log_explanation(spark: SparkSession, curves: DataFrame, root: str, experiment: str, name: str) -> str:
    """Record partial-dependence curves as a run of their own: the run, its
    ``explanations`` rows and an artifact row per feature.  Returns the run id."""
    run_id = new_run_id(experiment, name)
    mine = F.lit(run_id).alias("run_id")
    log_rows(spark.createDataFrame([(run_id, None, experiment, "explain")], SCHEMAS["runs"]), root, "runs")
    log_rows(curves.select(mine, *[c for c in curves.columns]), root, "explanations")
    log_rows(curves.select("feature").distinct().select(mine, F.lit("explanations").alias("dir"),
                                                        F.concat(F.col("feature"), F.lit(".curve")).alias("path")), root, "artifacts")
    return run_id


def load_latest(spark: SparkSession, root: str, name: str):
    """Load the latest registered version of a model."""
    from pyspark.ml import PipelineModel
    r = latest_versions(read(spark, root, "models").where(F.col("name") == name)).first()
    if r is None:
        raise KeyError(f"no registered model named {name}")
    return PipelineModel.load(r["uri"])


def cv_run_tables(cv: DataFrame, experiment: str, param_keys: list[str],
                  parent_name: str = "cv_search") -> dict:
    """Tracking rows of a grid search: one parent run per experiment, a child
    run ``Child_Run_CV_<i>`` per candidate with its parameters and its mean
    and std fold score.  ``cv`` has the experiment column, ``candidate``,
    the parameter columns and the score columns.  ``cv`` is small (one row
    per candidate) and feeds three tables, so it is computed once."""
    cv = small_table(cv)
    exp = F.col(experiment).cast("string")
    parent_id = F.concat(exp, F.lit("/parent"))
    child_id = F.concat(exp, F.lit("/"), F.col("candidate").cast("string"))
    parents = cv.select(exp.alias("experiment")).distinct().select(
        F.concat(F.col("experiment"), F.lit("/parent")).alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"),
        "experiment", F.lit(parent_name).alias("run_name"))
    children = cv.select(child_id.alias("run_id"), parent_id.alias("parent_run_id"), exp.alias("experiment"),
                         format_name(CHILD_RUN_NAME, F.col("candidate")).alias("run_name"))
    params = melt_params(cv.select(child_id.alias("run_id"), F.create_map(
        *[x for k in param_keys for x in (F.lit(k), F.col(k).cast("string"))]).alias("params")))
    metrics = cv.select(child_id.alias("run_id"), F.explode(F.create_map(
        F.lit("mean_test_score"), F.col("mean_test_score"),
        F.lit("std_test_score"), F.col("std_test_score"))).alias("key", "value"), F.lit(0).cast("long").alias("step"))
    return {"runs": parents.unionByName(children), "params": params, "metrics": metrics}
