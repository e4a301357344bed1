import pytest

from lodestone.operators import metrics as M


def _df(spark, pairs, t="string"):
    return spark.createDataFrame(pairs, f"actual {t}, predicted {t}")


def test_dense_matrix_keeps_zero_cells_and_unseen_predictions(spark):
    df = _df(spark, [("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")])
    cm = {(r.actual, r.predicted): r.n for r in M.confusion_matrix(df, "actual", "predicted").collect()}
    assert len(cm) == 9 and cm[("a", "a")] == 1 and cm[("c", "c")] == 0 and cm[("c", "b")] == 1


def test_report_zero_division_and_supports(spark):
    df = _df(spark, [(0, 0), (0, 1), (1, 1), (2, 1)], "int")
    rep = {r["class"]: r for r in M.classification_report(df, "actual", "predicted").collect()}
    assert rep["2"].precision == 0.0 and rep["2"].recall == 0.0 and rep["2"].f1_score == 0.0
    assert rep["0"].precision == 1.0 and rep["0"].recall == 0.5
    assert rep["1"].precision == pytest.approx(1 / 3, abs=1e-6)
    assert sum(rep[c].support for c in "012") == rep["accuracy"].support == 4
    assert rep["accuracy"].f1_score == 0.5
    assert rep["macro avg"].recall == pytest.approx((0.5 + 1 + 0) / 3, abs=1e-6)


def test_empty_input(spark):
    df = _df(spark, [], "int")
    assert M.confusion_matrix(df, "actual", "predicted").count() == 0
    assert M.accuracy(df, "actual", "predicted").first()[0] is None
    rep = {r["class"]: r for r in M.classification_report(df, "actual", "predicted").collect()}
    assert all(r.kind == "summary" for r in rep.values())
    assert set(rep) == {"accuracy", "macro avg", "weighted avg"}
    assert all(r.support == 0 and r.f1_score is None for r in rep.values())


def test_report_json_layout(spark):
    import json
    df = _df(spark, [(0, 0), (1, 1), (1, 0)], "int")
    doc = json.loads(M.report_json(M.classification_report(df, "actual", "predicted")).first()[0])
    assert list(doc) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert doc["1"]["support"] == 2 and doc["accuracy"] == pytest.approx(2 / 3, abs=1e-6)


def test_fold_summary_population_std(spark):
    import statistics
    scores = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.7), (0, 2, 0.9), (1, 0, 0.9), (1, 1, 0.7), (1, 2, 0.5)],
                                   "candidate int, fold int, score double")
    s = {r.candidate: r for r in M.fold_score_summary(scores).collect()}
    assert s[0].std_test_score == pytest.approx(statistics.pstdev([0.5, 0.7, 0.9]), abs=1e-6)
    best = M.best_candidate(M.fold_score_summary(scores)).first()
    assert best.candidate == 0  # equal means: first candidate wins


def test_param_grid_order():
    from lodestone.operators.grid import DEFAULT_GRID, param_grid
    got = [(c["max_depth"], c["n_estimators"]) for c in param_grid(DEFAULT_GRID)]
    assert got == [(3, 50), (3, 100), (5, 50), (5, 100)]


def test_one_rule_for_nulls(spark):
    df = _df(spark, [("a", "a"), ("a", None), (None, "a"), (None, None)])
    assert sum(r.n for r in M.confusion_matrix(df, "actual", "predicted").collect()) == 4
    rep = {(r.kind, r["class"]): r for r in M.classification_report(df, "actual", "predicted").collect()}
    assert rep["summary", "accuracy"].support == 4 and rep["class", None].support == 2
    assert rep["summary", "accuracy"].f1_score == M.accuracy(df, "actual", "predicted").first()[0] == 0.5


def test_label_types_are_kept(spark):
    df = _df(spark, [(1, 1), (2, 1)], "bigint")
    assert dict(M.confusion_matrix(df, "actual", "predicted").dtypes)["actual"] == "bigint"


def test_labels_named_like_summary_rows_or_with_quotes(spark):
    import json
    df = _df(spark, [("accuracy", "accuracy"), ("weighted avg", "accuracy"), ('q"\\\n', 'q"\\\n')])
    rep = M.classification_report(df, "actual", "predicted", digits=None)
    e = M.evaluate_classifier(df, "actual", "predicted").first()
    assert e.accuracy == pytest.approx(2 / 3, abs=1e-6) and e.recall_weighted == pytest.approx(2 / 3, abs=1e-6)
    doc = json.loads(M.report_json(rep).first()[0])
    assert doc["accuracy"] == 2 / 3  # full precision
    assert doc["class accuracy"]["support"] == 1 and doc["class weighted avg"]["recall"] == 0 and doc['q"\\\n']["f1-score"] == 1


def test_ranks_use_exact_means(spark):
    scores = spark.createDataFrame([(0, 0, 0.9000001), (1, 0, 0.9000004)], "candidate int, fold int, score double")
    s = M.fold_score_summary(scores)
    assert {r.candidate: r.rank_test_score for r in s.collect()} == {0: 2, 1: 1}
    assert M.best_candidate(s).first().candidate == 1


def test_many_classes(spark):
    from pyspark.sql import functions as F
    df = spark.range(9000).select((F.col("id") % 4500).alias("actual"), (F.col("id") % 4500).alias("predicted"))
    rep = M.classification_report(df, "actual", "predicted")
    assert rep.count() == 4503 and rep.where("class = 'accuracy'").first().f1_score == 1.0


def test_actual_values_without_a_probability_column(spark):
    """The code of a missing label, a code beyond the columns, a null: probability 0."""
    import math
    rows = [(0, 0, 0.5, 0.5), (-1, 0, 0.9, 0.1), (7, 1, 0.2, 0.8), (None, 1, 0.2, 0.8), (1, 1, 0.25, 0.75), (1, 0, 0.5, None)]
    df = spark.createDataFrame(rows, "y int, p int, p0 double, p1 double")
    got = M.evaluate_classifier(df, "y", "p", ["p0", "p1"], digits=None).first()
    want = -(math.log(0.5) + math.log(0.75) + 4 * math.log(M.LOG_LOSS_EPS)) / 6
    assert abs(got["log_loss"] - want) < 1e-12 and abs(got["accuracy"] - 2 / 6) < 1e-12


def test_matrix_as_json(spark):
    import json
    df = spark.createDataFrame([(0, 0), (0, 1), (10, 2), (None, 0)], "y int, p int")
    got = json.loads(M.matrix_json(M.confusion_matrix(df, "y", "p")).first()["matrix"])
    assert list(got) == ["null", "0", "1", "2", "10"] and got["0"] == {"null": 0, "0": 1, "1": 1, "2": 0, "10": 0} and got["null"]["0"] == 1
