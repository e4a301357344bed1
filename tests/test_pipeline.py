"""The model pipeline end to end on a generated iris-shaped CSV."""
import numpy as np
from pyspark.sql import functions as F

from lodestone.plans import etl, ml
from lodestone.sources.collections import read_collection

SPECIES = ["Iris-setosa", "Iris-versicolor", "Iris-virginica"]


def _iris_like(path):
    """150 rows, 3 classes in blocks of 50 (sorted by class), four
    measures with class-dependent means, and rows equal apart from Id."""
    rng = np.random.RandomState(7)
    lines = ["Id,SepalLengthCm,SepalWidthCm,PetalLengthCm,PetalWidthCm,Species"]
    for c, sp in enumerate(SPECIES):
        for i in range(50):
            m = rng.normal([5.0 + 0.8 * c, 3.4 - 0.3 * c, 1.5 + 2.3 * c, 0.2 + 0.9 * c], 0.15)
            if i in (10, 35):  # duplicate content, different Id
                m = np.array([5.0 + 0.8 * c, 3.4 - 0.3 * c, 1.5 + 2.3 * c, 0.2 + 0.9 * c])
            lines.append(f"{c * 50 + i + 1}," + ",".join(f"{v:.1f}" for v in m) + f",{sp}")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_ml_pipeline_end_to_end(spark, tmp):
    _iris_like(f"{tmp}/iris.csv")
    stages = etl.Stages(db="iris", extract="extract", transform="preprocessed", load="train", root=f"{tmp}/store")
    small = {"n_estimators": [5, 10], "max_depth": [3, 5], "random_state": [42]}
    res = ml.run_ml_pipeline(spark, f"{tmp}/iris.csv", stages, f"{tmp}/registry", "iris_rf", grid=small,
                             points=5, artifacts_dir=f"{tmp}/art")
    assert res["features"] == ["SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm"]
    assert res["cv"].count() == 4
    rep = {r["class"]: r for r in res["report"].collect()}
    assert rep["accuracy"].support == 30 and rep["accuracy"].f1_score > 0.9
    pre = read_collection(spark, "iris", "preprocessed", f"{tmp}/store")
    assert "Id" not in pre.columns and sorted(r[0] for r in pre.select("Species").distinct().collect()) == [0, 1, 2]
    train = read_collection(spark, "iris", "train", f"{tmp}/store")
    assert train.count() == 150 and train.where(F.col("split") == "test").count() == 30
    curves = res["curves"].collect()
    assert len(curves) == 4 * 3 * 5  # features x classes x points
    assert len({(r.feature, r["class"]) for r in curves}) == 12
    from lodestone.operators import registry as R
    runs = R.read(spark, f"{tmp}/registry", "runs")
    assert runs.where("run_name = 'explain'").count() == 1
    assert R.read(spark, f"{tmp}/registry", "explanations").where(F.col("run_id") == res["explain_run_id"]).count() == len(curves)


def test_the_pipeline_repeats(spark, tmp):
    _iris_like(f"{tmp}/iris.csv")
    one = {"n_estimators": [3], "max_depth": [2], "random_state": [42]}
    parts = []
    for i in range(2):
        stages = etl.Stages(db=f"iris{i}", extract="extract", transform="preprocessed", load="train", root=f"{tmp}/store")
        res = ml.run_ml_pipeline(spark, f"{tmp}/iris.csv", stages, f"{tmp}/registry{i}", "rf", grid=one, points=2)
        parts.append((sorted(map(tuple, res["split"].select("_id", "split").collect())), res["report"].collect()))
    assert parts[0] == parts[1]
