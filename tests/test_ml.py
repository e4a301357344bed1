"""Model pipeline invariants on MLlib."""
import pytest
from pyspark.sql import functions as F

from sf_dirs import SF_MID
from lodestone.operators import registry as R
from lodestone.operators import training as T
from lodestone.plans import ml
from lodestone.session import laid_out, read_table


def _quality(spark):
    return ml.quality_data(read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")).cache()


def test_pipeline_beats_majority_and_registers(spark, tmp):
    data = _quality(spark)
    small = {"n_estimators": [5, 10], "max_depth": [3], "random_state": [42]}
    res = ml.train_and_register(spark, data, ml.QUALITY_FEATURES, "quality", "doc_id", tmp, "q", grid=small,
                                artifacts_dir=f"{tmp}/art")
    cv = res["cv"].collect()
    assert len(cv) == 2 and all(0 <= r.mean_test_score <= 1 for r in cv)
    rep = {r["class"]: r for r in res["report"].collect()}
    n = data.count()
    test_n = rep["accuracy"].support
    assert test_n == -(-n // 5)
    majority = max(r[1] for r in data.groupBy("quality").count().collect()) / n
    assert rep["accuracy"].f1_score > majority
    assert res["version"] == 1
    assert R.register_model(spark, res["model"], "q", tmp) == 2
    latest = R.latest_versions(R.read(spark, tmp, "models")).first()
    assert latest.version == 2
    a = res["model"].transform(data).select("doc_id", "prediction")
    b = R.load_latest(spark, tmp, "q").transform(data).select("doc_id", "prediction")
    assert a.exceptAll(b).count() == 0
    import json
    doc = json.loads(spark.read.text(f"{tmp}/art/evaluation").first()[0])
    assert doc["accuracy"] == pytest.approx(rep["accuracy"].f1_score, abs=1e-6)
    assert {(r["dir"]) for r in R.read(spark, tmp, "artifacts").collect()} == {"model", "dataset_samples", "evaluation", "confusion_matrix"}
    assert {r["key"] for r in R.read(spark, tmp, "tags").collect()} == {"model_type", "dataset"}
    sig = R.read(spark, tmp, "signatures").where("side = 'inputs'").orderBy("position").collect()
    assert [r["name"] for r in sig] == ml.QUALITY_FEATURES
    uri = R.read(spark, tmp, "models").orderBy("version").first()["uri"]
    assert spark.read.json(f"{uri}-input_example").count() == 5
    board = R.leaderboard(R.read(spark, tmp, "runs"), R.read(spark, tmp, "params"), R.read(spark, tmp, "metrics"),
                          ["mean_test_score", "std_test_score"], ["max_depth", "n_estimators"])
    assert board.count() == 2


def test_forest_scores_probabilities(spark):
    data = _quality(spark)
    model = T.fit_forest(data, ml.QUALITY_FEATURES, "quality", 10, 3, 42)
    p = T.score_proba(model, data, 2)
    assert p.where(F.abs(F.col("p0") + F.col("p1") - 1) > 1e-9).count() == 0


def test_signature_rows(spark):
    li = read_table(spark, SF_MID, "lineitem").select("l_quantity", "l_tax")
    sig = R.signature(spark, li, li.select((F.col("l_tax") > 0).alias("y"))).collect()
    assert [(r.side, r.name, r.type) for r in sig] == [("inputs", "l_quantity", "double"),
                                                        ("inputs", "l_tax", "double"), ("outputs", "y", "boolean")]


def test_orders_band_beats_majority(spark):
    data = ml.prepare(ml.order_data(read_table(spark, SF_MID, "orders")))
    from lodestone.operators import metrics as M, sampling as S
    split = S.with_split(data, "o_orderkey", 0.2, 42)
    model = T.fit_forest(split.where("split = 'train'"), ml.ORDER_FEATURES, "band", 10, 5, 42)
    scored = model.transform(split.where("split = 'test'")).withColumn("prediction", F.col("prediction").cast("int"))
    acc = M.accuracy(scored, "band", "prediction").first()[0]
    n = data.count()
    majority = max(r[1] for r in data.groupBy("band").count().collect()) / n
    assert acc > majority + 0.2


def test_grid_candidates_are_the_product():
    from lodestone.operators.grid import param_grid
    g = {"a": [1, 2, 3], "b": ["x", "y"], "c": [0.5]}
    assert len(param_grid(g)) == 3 * 2 * 1


def test_grid_search_uses_the_fold_count(spark):
    from lodestone.operators import sampling as S
    data = _quality(spark)
    folded = S.stratified_folds(data, "quality", "doc_id", 4, 42)
    cvm = T.grid_search(folded, ml.QUALITY_FEATURES, "quality",
                        {"n_estimators": [3], "max_depth": [2], "random_state": [1]}, k=4)
    assert cvm.getNumFolds() == 4 and len(cvm.avgMetrics) == 1 and 0 < cvm.avgMetrics[0] <= 1


def test_class_count_metadata_is_used(spark):
    df = spark.range(60).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    m = T.fit_forest(df, ["x"], "y", 3, 2, 1, n_classes=3)
    assert m.stages[-1].numClasses == 3
    assert T.fit_forest(df, ["x"], "y", 3, 2, 1).stages[-1].numClasses == 2


def test_training_twice_gives_two_runs(spark, tmp):
    data = ml.prepare(_quality(spark))
    one = {"n_estimators": [3], "max_depth": [2], "random_state": [1]}
    res = [ml.train_and_register(spark, data, ml.QUALITY_FEATURES, "quality", "doc_id", tmp, "q", grid=one) for _ in range(2)]
    assert res[0]["run_id"] != res[1]["run_id"] and [r["version"] for r in res] == [1, 2]
    runs = R.read(spark, tmp, "runs")
    roll = R.child_rollup(runs, R.read(spark, tmp, "metrics"), "mean_test_score").collect()
    assert len(roll) == 2 and all(r["n_children"] == 1 for r in roll)
    plan = R.experiment_runs(runs, "ml")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(experiment), EqualTo(experiment,ml)]" in plan
    # the same rows and seed: the same split and folds, and the same forest in any layout
    a, b = (sorted(map(tuple, r["split"].select("doc_id", "split").collect())) for r in res)
    assert a == b
    f = [T.fit_forest(data.repartition(n), ml.QUALITY_FEATURES, "quality", 5, 3, 42, key="doc_id").stages[-1] for n in (1, 6)]
    assert f[0].toDebugString == f[1].toDebugString or f[0].featureImportances == f[1].featureImportances


def _read_counter(spark, n=300):
    """Rows (k, x, z, y, fold), and a number that grows by one whenever a row is read."""
    read = spark.sparkContext.accumulator(0)

    def note(i):
        read.add(1)
        return i, float(i * 7919 % 101), float(i * 31 % 17), i * 7919 % 101 // 34, i % 3

    rows = spark.sparkContext.parallelize(range(n), 3).map(note)
    return spark.createDataFrame(rows, "k long, x double, z double, y int, fold int"), read


def test_a_fit_lays_its_rows_out_once(spark):
    kept = spark.sparkContext._jsc.getPersistentRDDs().size
    df, read = _read_counter(spark)
    before = kept()
    model = T.fit_forest(df, ["x", "z"], "y", 5, 3, 42, n_classes=3, key="k").stages[-1]
    assert read.value == 2 * 300  # counted, then sent; four times when every reader sent them anew
    assert kept() == before
    plain = T.fit_forest(laid_out(df, "k"), ["x", "z"], "y", 5, 3, 42, n_classes=3).stages[-1]
    assert model.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
    assert model.featureImportances == plain.featureImportances


def test_a_search_lays_its_rows_out_once(spark):
    grid = {"n_estimators": [3], "max_depth": [2], "random_state": [1]}
    df, read = _read_counter(spark)
    cv = T.grid_search(T.with_class_count(df, "y", 3), ["x", "z"], "y", grid, k=3, key="k")
    assert read.value == 2 * 300
    df, _ = _read_counter(spark)
    plain = T.grid_search(T.with_class_count(laid_out(df, "k"), "y", 3), ["x", "z"], "y", grid, k=3)
    assert list(cv.avgMetrics) == list(plain.avgMetrics)


def test_missing_labels_are_left_out_and_counted(spark, tmp):
    data = _quality(spark).withColumn("quality", F.when(F.col("doc_id") % 9 == 0, None).when(F.col("doc_id") % 9 == 1, -1).otherwise(F.col("quality")))
    n = data.where("quality >= 0").count()
    res = ml.train_and_register(spark, data, ml.QUALITY_FEATURES, "quality", "doc_id", tmp, "q",
                                grid={"n_estimators": [3], "max_depth": [2], "random_state": [1]})
    assert res["unlabelled"] == data.count() - n and res["split"].count() == n and res["n_classes"] == 2


def test_two_trainers_never_share_a_version(spark, tmp):
    assert R.claim_version(spark, tmp, "m") == 1
    assert R.claim_version(spark, tmp, "m") == 2  # claimed, though nothing is registered yet


def test_texts_are_split_into_words_once(spark):
    rows = [(1, "a b  a\nc", 8), (2, "", 0), (3, "  ", 2), (4, None, None), (5, " Été été\t7 ", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = ml.document_features(docs, "n_chars")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(trim(") == 1, plan
    got = {r[0]: r[1:6] for r in out.collect()}
    assert got[1] == (8.0, 4.0, 2.0, 0.5, 0.75) and got[2] == (0.0, 0.0, 1.0, 0.0, 1.0) and got[3] == (2.0, 0.0, 1.0, 0.0, 1.0)
    assert got[4][0] is None and got[5] == (11.0, 3.0, 1.0, pytest.approx(6 / 11), 1.0)
