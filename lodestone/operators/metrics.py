"""Classification metrics over a scored frame.

Everything starts from one partial-then-final aggregation of (actual,
predicted) pairs, so the shuffle carries at most partitions x classes^2
rows; all later steps work on that table.

One rule for missing values, in every metric: null is a class of its own.  A
null actual is right only when the prediction is null too, and the null class
has its row in the matrix and in the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.labels import label_list
from lodestone.session import small_table

LOG_LOSS_EPS = 1e-15
#: Names of the summary rows of a report, in their order.
SUMMARY_ROWS = ("accuracy", "macro avg", "weighted avg")


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 (the zero-division rule of the report)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def accuracy(df: DataFrame, actual: str, predicted: str, out: str = "accuracy") -> DataFrame:
    """Share of rows whose prediction equals the actual value (one row)."""
    return df.agg(F.avg(F.col(actual).eqNullSafe(F.col(predicted)).cast("double")).alias(out))


def confusion_counts(df: DataFrame, actual: str, predicted: str, materialize: bool = False) -> DataFrame:
    """Sparse confusion counts: non-zero (actual, predicted, n) cells, for any
    number of classes.  ``materialize`` keeps the small table, for callers who
    derive several metrics from one pass over the data."""
    counts = (df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    return small_table(counts) if materialize else counts


def _labels(counts: DataFrame, name: str) -> DataFrame:
    return counts.select(F.explode(F.array("actual", "predicted")).alias(name)).distinct()


def dense_cells(counts: DataFrame) -> DataFrame:
    """Every (actual, predicted) pair of the labels in ``counts``, absent cells
    as 0: classes^2 rows, which a caller asks for on purpose."""
    pairs = _labels(counts, "actual").crossJoin(_labels(counts, "predicted"))
    c = counts.select(F.col("actual").alias("_a"), F.col("predicted").alias("_p"), "n")
    return (pairs.join(c, F.col("actual").eqNullSafe(F.col("_a")) & F.col("predicted").eqNullSafe(F.col("_p")), "left")
            .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Dense confusion matrix in long form (actual, predicted, n): every
    label present in either column on both axes, absent cells as 0.
    ``confusion_counts`` has the non-zero cells only."""
    return dense_cells(confusion_counts(df, actual, predicted, materialize=True))


def confusion_matrix_wide(df: DataFrame, actual: str, predicted: str, labels: list | None = None) -> DataFrame:
    """Rows = actual, one column per predicted label (a table with a column
    per class, so for few classes)."""
    dense = confusion_matrix(df, actual, predicted)
    if labels is None:
        labels = label_list(dense, "actual")
    return (dense.groupBy("actual").pivot("predicted", labels).agg(F.sum("n"))
            .orderBy("actual"))


def per_class_stats(counts: DataFrame) -> DataFrame:
    """Per class from sparse confusion counts: tp, support (actual count),
    pred_n (predicted count).  Each cell speaks for its actual and its predicted
    label; one aggregate gathers both."""
    n, none = F.col("n"), F.lit(0).cast("long")
    right = F.when(F.col("actual").eqNullSafe(F.col("predicted")), n).otherwise(none)
    cells = counts.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), right.alias("tp"), n.alias("support"), none.alias("pred_n")),
        F.struct(F.col("predicted").alias("label"), none.alias("tp"), none.alias("support"), n.alias("pred_n")))).alias("c"))
    return cells.select("c.*").groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "pred_n")])


def classification_report(df: DataFrame, actual: str, predicted: str, digits: int | None = 6) -> DataFrame:
    """Per-class precision, recall, f1 and support (``kind`` = class), plus the
    rows ``accuracy`` (f1_score column = accuracy, support = n), ``macro avg``
    and ``weighted avg`` (``kind`` = summary).  A metric whose denominator is 0
    is 0.  The data are read and exchanged once."""
    return report_from_counts(confusion_counts(df, actual, predicted), digits)


def report_from_counts(counts: DataFrame, digits: int | None = 6) -> DataFrame:
    """The classification report from sparse (actual, predicted, n) counts."""
    st = per_class_stats(counts)
    p = _div0(F.col("tp"), F.col("pred_n"))
    r = _div0(F.col("tp"), F.col("support"))
    cls = st.select(F.col("label").cast("string").alias("class"), p.alias("precision"),
                    r.alias("recall"), "support", "tp")
    cls = cls.withColumn("f1_score", _div0(2 * F.col("precision") * F.col("recall"),
                                           F.col("precision") + F.col("recall")))
    cls = small_table(cls)  # a row per class, read for the rows and for their summary
    tot = F.sum("support")
    summary = cls.agg(
        F.sum("tp").alias("_tp"), tot.alias("_n"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1_score").alias("_mf"),
        _div0(F.sum(F.col("precision") * F.col("support")), tot).alias("_wp"),
        _div0(F.sum(F.col("recall") * F.col("support")), tot).alias("_wr"),
        _div0(F.sum(F.col("f1_score") * F.col("support")), tot).alias("_wf"))

    def row(name, prec, rec, f1):
        return F.struct(F.lit("summary").alias("kind"), F.lit(name).alias("class"), prec.cast("double").alias("precision"),
                        rec.cast("double").alias("recall"), f1.cast("double").alias("f1_score"),
                        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("support"))
    none = F.lit(None)
    rows = summary.select(F.inline(F.array(
        row(SUMMARY_ROWS[0], none, none, _div0(F.col("_tp"), F.col("_n"))),
        row(SUMMARY_ROWS[1], F.col("_mp"), F.col("_mr"), F.col("_mf")),
        row(SUMMARY_ROWS[2], F.col("_wp"), F.col("_wr"), F.col("_wf")),
    )))
    out = cls.select(F.lit("class").alias("kind"), "class", "precision", "recall", "f1_score", "support").unionByName(rows)
    if digits is not None:
        out = out.select("kind", "class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1_score")],
                         "support")
    return out


def report_json(report: DataFrame) -> DataFrame:
    """The report as one JSON document (class -> metrics, ``accuracy`` a
    number): give it a report with ``digits=None`` for full precision.  Labels
    are escaped by the JSON writer; a class named like a summary row gets the
    key ``class <name>``, the null class the key ``null``."""
    summary = F.col("kind") == "summary"
    name = F.coalesce(F.col("class"), F.lit("null"))
    key = F.when(~summary & name.isin(*SUMMARY_ROWS), F.concat(F.lit("class "), name)).otherwise(name)
    body = F.to_json(F.create_map(key, F.struct("precision", "recall", F.col("f1_score").alias("f1-score"), "support")))
    number = F.to_json(F.create_map(key, F.col("f1_score")))
    entry = F.when(summary & (F.col("class") == SUMMARY_ROWS[0]), number).otherwise(body)
    place = F.when(~summary, 0).otherwise(F.array_position(F.array(*[F.lit(x) for x in SUMMARY_ROWS]), F.col("class")))
    inner = F.expr("substring(e, 2, length(e) - 2)")
    parts = (report.select(place.alias("o"), key.alias("c"), entry.alias("e"))
             .select(F.struct("o", "c", inner.alias("e")).alias("s")))
    return parts.agg(F.concat(F.lit("{"), F.array_join(
        F.transform(F.array_sort(F.collect_list("s")), lambda x: x["e"]), ", "), F.lit("}")).alias("report"))


def matrix_json(cells: DataFrame) -> DataFrame:
    """A dense confusion matrix as one JSON document: actual label -> predicted
    label -> count, labels in order (one row, ``matrix``)."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    per = cells.groupBy("actual").agg(F.sort_array(F.collect_list(F.struct("predicted", name("predicted").alias("p"), "n"))).alias("r"))
    whole = F.sort_array(F.collect_list(F.struct("actual", name("actual").alias("a"), "r")))
    row = lambda r: F.map_from_entries(F.transform(r, lambda x: F.struct(x["p"], x["n"])))
    return per.agg(F.to_json(F.map_from_entries(F.transform(whole, lambda x: F.struct(x["a"], row(x["r"]))))).alias("matrix"))


def fold_score_summary(scores: DataFrame, candidate: str = "candidate", score: str = "score",
                       digits: int | None = 6) -> DataFrame:
    """Mean and population standard deviation of the fold scores per
    candidate, plus the rank by the exact mean (1 = best, ties share the lower
    rank).  Rounding is for the output only."""
    agg = scores.groupBy(candidate).agg(F.avg(score).alias("mean_test_score"),
                                        F.stddev_pop(score).alias("std_test_score"))
    ranked = agg.withColumn("rank_test_score",
                            F.rank().over(Window.orderBy(F.col("mean_test_score").desc())).cast("int"))
    return rounded_scores(ranked, digits)


def rounded_scores(ranked: DataFrame, digits: int | None) -> DataFrame:
    for c in ("mean_test_score", "std_test_score") if digits is not None else ():
        ranked = ranked.withColumn(c, F.round(c, digits))
    return ranked


def best_candidate(summary: DataFrame, candidate: str = "candidate",
                   rank: str = "rank_test_score") -> DataFrame:
    """The candidate of the best rank; the first in candidate order on ties.
    An aggregate (min_by over a composite order), not a window."""
    order = F.struct(F.col(rank), F.col(candidate))
    return summary.agg(F.min_by(F.struct(*[F.col(c) for c in summary.columns]), order).alias("b")) \
        .select("b.*")


def evaluate_classifier(df: DataFrame, actual: str, predicted: str, prob_cols: list[str] | None = None,
                        digits: int | None = 6) -> DataFrame:
    """One row: accuracy, support-weighted precision, recall and f1, and the
    log loss of the probability columns (column i = class code i).  An actual
    value without a column (null, below 0 as the code of a missing label, or
    beyond the last) and a null probability count as probability 0.  One
    aggregation pass over the data; the rest runs on the table of cells."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if prob_cols:
        p_true = F.coalesce(F.get(F.array(*[F.col(c) for c in prob_cols]), F.col(actual).cast("int")), F.lit(0.0))
        aggs.append(F.sum(-F.log(F.greatest(p_true, F.lit(LOG_LOSS_EPS)))).alias("ll"))
    counts = small_table(df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(*aggs))
    rep = report_from_counts(counts.select("actual", "predicted", "n"), digits=None).where("kind = 'summary'")
    pick = {
        "accuracy": F.when(F.col("class") == "accuracy", F.col("f1_score")),
        "precision_weighted": F.when(F.col("class") == "weighted avg", F.col("precision")),
        "recall_weighted": F.when(F.col("class") == "weighted avg", F.col("recall")),
        "f1_weighted": F.when(F.col("class") == "weighted avg", F.col("f1_score")),
    }
    long = rep.select(*[v.alias(k) for k, v in pick.items()], F.lit(None).cast("double").alias("log_loss"))
    if prob_cols:
        ll = counts.agg(*[F.lit(None).cast("double").alias(k) for k in pick],
                        (F.sum("ll") / F.sum("n")).alias("log_loss"))
        long = long.unionByName(ll)
    names = list(pick) + (["log_loss"] if prob_cols else [])
    out = long.agg(*[F.max(c).alias(c) for c in names])
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out
