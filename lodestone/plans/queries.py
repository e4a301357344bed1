"""Registered queries over the driver's test tables, with their SQL twins.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables (or
data Spark derives from them).  ``ORACLE_SQL`` holds, per query, the same
result written as DuckDB SQL over the tables as views.  Column names match
between the two; counts are BIGINT on both sides.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import columns, predicates
from lodestone.operators import exact_trees, explain, forest_curves, grid, labels, membership, metrics, registry, sampling, selection, sorted_runs, text_index, training
from lodestone.plans import crawl, etl, ml
from lodestone.session import read_table, scratch_path, small_table, spread
from lodestone.sources import collections
from lodestone.sources.files import csv_scan, labelled_source, notebook_scan
from lodestone.sources.tables import catalog_from_documents, literal_source
from lodestone.streaming import incremental

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _csv_copy(df: DataFrame, spark: SparkSession, name: str, delimiter: str = ",") -> str:
    """Write a table as CSV with header below the shared folder (the input
    file of the extract step)."""
    path = scratch_path(spark, "csv", name)
    df.write.option("header", True).option("delimiter", delimiter).csv(path)
    return path


# ---------------------------------------------------------------------------
# Spark ETL chain
# ---------------------------------------------------------------------------

@query("etl_chain_customer", """
select md5(cast(c_custkey as varchar)) as _id, cast(c_custkey as integer) as c_custkey,
       c_nationkey, c_acctbal, c_mktsegment
from customer
""")
def q_etl_chain_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _csv_copy(read_table(spark, sf_dir, "customer"), spark, "customer")
    stages = etl.Stages(db="etl_customer", root=scratch_path(spark, "store"))
    return etl.run_etl(spark, src, stages, key="c_custkey", drop=("extra", "c_name"))


@query("etl_refresh_keeps_old_rows_customer", """
select 'after_failure' as state, c_custkey, c_acctbal from customer where c_acctbal >= 0
union all select 'after_refresh', c_custkey, c_acctbal from customer
""")
def q_etl_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh that dies in its tasks leaves the rows of the last one
    readable; the next refresh replaces them in one step."""
    c, root = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), scratch_path(spark, "store")
    collections.write_collection(c.where("c_acctbal >= 0"), "etl", "load", root, "snapshot")
    broken = c.withColumn("c_acctbal", F.when(F.col("c_acctbal") < 0, F.raise_error(F.lit("bad row")).cast("double")).otherwise(F.col("c_acctbal")))
    try:
        collections.write_collection(broken, "etl", "load", root, "snapshot")
    except PySparkException:
        pass
    kept = collections.read_collection(spark, "etl", "load", root, "snapshot").select(F.lit("after_failure").alias("state"), "*")
    collections.write_collection(c, "etl", "load", root, "snapshot")
    return kept.unionByName(collections.read_collection(spark, "etl", "load", root, "snapshot").select(F.lit("after_refresh").alias("state"), "*"))


@query("csv_scan_supplier_pipe", """
select cast(s_suppkey as integer) as s_suppkey, s_name, s_nationkey, s_acctbal from supplier
""")
def q_csv_scan_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _csv_copy(read_table(spark, sf_dir, "supplier"), spark, "supplier", delimiter="|")
    return csv_scan(spark, src, delimiter="|")


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """Flagship: the Spark ETL chain on ``lineitem`` (CSV -> extract ->
    transform drops ``extra`` and ``l_linenumber`` -> load), then rows per
    return flag of the load collection."""
    src = _csv_copy(read_table(spark, sf_dir, "lineitem"), spark, "lineitem")
    stages = etl.Stages(db="etl_lineitem", root=scratch_path(spark, "store"))
    loaded = etl.run_etl(spark, src, stages, key=None, drop=("extra", "l_linenumber"))
    return (loaded.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("l_returnflag"))


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------

@query("drop_strict_customer", """
select c_custkey, c_nationkey, c_acctbal, c_mktsegment from customer
""")
def q_drop_strict(spark, sf_dir):
    return columns.drop_strict(read_table(spark, sf_dir, "customer"), "c_name")


@query("conform_customer", """
select c_custkey, c_mktsegment, cast(c_acctbal as double) as c_acctbal,
       cast(null as double) as c_missing from customer
""")
def q_conform(spark, sf_dir):
    cols = [("c_custkey", None), ("c_mktsegment", None), ("c_acctbal", "double"), ("c_missing", "double")]
    return columns.conform(read_table(spark, sf_dir, "customer"), cols)


@query("value_pipeline_orders", """
select o_orderkey, o_totalprice * 2 as value from orders
union all select 0, 84.0
""")
def q_value_pipeline(spark, sf_dir):
    """Value records of ``orders`` and one literal record through the chain."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"))
    return etl.value_pipeline(o.unionByName(literal_source(spark, [(0, 42.0)], o.schema)), "value", 2)


@query("format_metric_orders", """
select o_orderstatus, printf('%.4f', avg(o_totalprice) / 1000) as avg_price_k,
       'status_' || o_orderstatus || '_' || cast(count(*) as varchar) as name
from orders group by o_orderstatus
""")
def q_format_metric(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    g = o.groupBy("o_orderstatus").agg((F.avg("o_totalprice") / 1000).alias("m"), F.count(F.lit(1)).alias("n"))
    return g.select("o_orderstatus", columns.format_metric(F.col("m"), 4).alias("avg_price_k"),
                    columns.format_name("status_%s_%d", F.col("o_orderstatus"), F.col("n")).alias("name"))


# ---------------------------------------------------------------------------
# Labels (W1, E4, B14, H10)
# ---------------------------------------------------------------------------

@query("distinct_labels_events", """
select distinct event_type from events
""")
def q_distinct_labels(spark, sf_dir):
    return labels.distinct_labels(read_table(spark, sf_dir, "events"), "event_type")


@query("category_codes_customer", """
with c as (select c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') as seg from customer),
     l as (select seg, cast(row_number() over (order by seg) - 1 as integer) as code
           from (select distinct seg from c where seg is not null) t)
select c.c_custkey, c.seg as segment, coalesce(l.code, -1) as code from c left join l on c.seg = l.seg
""")
def q_category_codes(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("nullif(c_mktsegment, 'HOUSEHOLD')").alias("segment"))
    return labels.category_codes(c, "segment", out="code")


@query("decode_labels_events", """
select event_id, cast(dense_rank() over (order by event_type) - 1 as integer) as code,
       event_type as name from events
""")
def q_decode_labels(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    names = labels.label_list(e, "event_type")
    coded = labels.category_codes(e, "event_type", out="code", names=names)
    return coded.select("event_id", "code", columns.decode_label(F.col("code"), names).alias("name"))


@query("preprocess_events", """
select event_id, user_id, cast(dense_rank() over (order by event_type) - 1 as integer) as event_type, value
from events
""")
def q_preprocess(spark, sf_dir):
    return training.preprocess(read_table(spark, sf_dir, "events"), drop=("ts", "props"), label="event_type")


# ---------------------------------------------------------------------------
# Splits and folds
# ---------------------------------------------------------------------------

@query("train_test_split_events", """
select event_id, event_type,
       case when row_number() over (order by md5('42:' || cast(event_id as varchar)), event_id)
                 <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split
from events
""")
def q_split(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return sampling.with_split(e, "event_id", 0.2, 42)


@query("stratified_folds_events", """
select event_id, event_type,
       cast((row_number() over (partition by event_type
             order by md5('42:' || cast(event_id as varchar)), event_id) - 1) % 3 as integer) as fold
from events
""")
def q_folds(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return sampling.stratified_folds(e, "event_type", "event_id", 3, 42)


_REPEATED_SQL = """
with o as (select case when o_orderkey % 10 < 7 then null else o_custkey end as k, o_orderstatus, o_totalprice from orders)
select k, o_orderstatus, o_totalprice, {} from o
"""
_REPEATED_ORDER = "coalesce(md5('42:' || cast(k as varchar)), ''), k nulls first, {}o_totalprice nulls first"


def _repeated_keys(spark, sf_dir):
    """Orders keyed by customer, the key of seven in ten of them lost."""
    return read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 10 >= 7, F.col("o_custkey")).alias("k"), "o_orderstatus", "o_totalprice")


@query("split_repeated_keys_orders", _REPEATED_SQL.format(
    f"case when row_number() over (order by {_REPEATED_ORDER.format('o_orderstatus nulls first, ')}) <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split"))
def q_split_repeated(spark, sf_dir):
    return sampling.with_split(_repeated_keys(spark, sf_dir), "k", 0.2, 42)


@query("folds_repeated_keys_orders", _REPEATED_SQL.format(
    f"cast((row_number() over (partition by o_orderstatus order by {_REPEATED_ORDER.format('')}) - 1) % 3 as integer) as fold"))
def q_folds_repeated(spark, sf_dir):
    return sampling.stratified_folds(_repeated_keys(spark, sf_dir), "o_orderstatus", "k", 3, 42)


# ---------------------------------------------------------------------------
# Metrics (E5-E8, E11, D5, W4, D3/H1)
# ---------------------------------------------------------------------------

def _quality_scored(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select("doc_id", F.col("quality").alias("actual"),
                                        (F.col("n_chars") > 500).cast("int").alias("predicted"))


_QUALITY_SQL = """select l.quality as actual, cast(d.n_chars > 500 as integer) as predicted
                  from documents d join labels l on d.doc_id = l.doc_id"""

_RETURNFLAG_SQL = """select l_returnflag as actual,
                     case when l_quantity < 20 then 'A' else 'N' end as predicted from lineitem"""


def _returnflag_scored(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("actual"),
                     F.when(F.col("l_quantity") < 20, "A").otherwise("N").alias("predicted"))


def _dense_cm_sql(scored_sql: str) -> str:
    return f"""
with p as ({scored_sql}),
     l as (select actual as x from p union select predicted from p),
     c as (select actual, predicted, count(*) as n from p group by actual, predicted)
select l1.x as actual, l2.x as predicted, cast(coalesce(c.n, 0) as bigint) as n
from l l1 cross join l l2 left join c on c.actual = l1.x and c.predicted = l2.x
"""


def _report_sql(scored_sql: str) -> str:
    return f"""
with p as ({scored_sql}),
     l as (select actual as x from p union select predicted from p),
     s as (select l.x as label,
                  (select count(*) from p where p.actual = l.x and p.predicted = l.x) as tp,
                  (select count(*) from p where p.actual = l.x) as support,
                  (select count(*) from p where p.predicted = l.x) as pred_n from l),
     m as (select cast(label as varchar) as class,
                  case when pred_n = 0 then 0.0 else tp::double / pred_n end as precision,
                  case when support = 0 then 0.0 else tp::double / support end as recall,
                  support, tp from s),
     f as (select *, case when precision + recall = 0 then 0.0
                          else 2 * precision * recall / (precision + recall) end as f1_score from m),
     t as (select sum(tp) as tp, sum(support) as n, avg(precision) as mp, avg(recall) as mr, avg(f1_score) as mf,
                  sum(precision * support) / sum(support) as wp, sum(recall * support) / sum(support) as wr,
                  sum(f1_score * support) / sum(support) as wf from f)
select 'class' as kind, class, round(precision, 6) as precision, round(recall, 6) as recall,
       round(f1_score, 6) as f1_score, cast(support as bigint) as support from f
union all select 'summary', 'accuracy', null, null, round(tp::double / n, 6), cast(n as bigint) from t
union all select 'summary', 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), cast(n as bigint) from t
union all select 'summary', 'weighted avg', round(wp, 6), round(wr, 6), round(wf, 6), cast(n as bigint) from t
"""


@query("accuracy_quality", f"""
with p as ({_QUALITY_SQL}) select round(avg(cast(actual = predicted as double)), 6) as accuracy from p
""")
def q_accuracy(spark, sf_dir):
    a = metrics.accuracy(_quality_scored(spark, sf_dir), "actual", "predicted")
    return a.select(F.round("accuracy", 6).alias("accuracy"))


@query("confusion_matrix_quality", _dense_cm_sql(_QUALITY_SQL))
def q_cm_quality(spark, sf_dir):
    return metrics.confusion_matrix(_quality_scored(spark, sf_dir), "actual", "predicted")


@query("confusion_matrix_returnflag", _dense_cm_sql(_RETURNFLAG_SQL))
def q_cm_returnflag(spark, sf_dir):
    return metrics.confusion_matrix(_returnflag_scored(spark, sf_dir), "actual", "predicted")


@query("classification_report_quality", _report_sql(_QUALITY_SQL))
def q_report_quality(spark, sf_dir):
    return metrics.classification_report(_quality_scored(spark, sf_dir), "actual", "predicted")


@query("classification_report_returnflag", _report_sql(_RETURNFLAG_SQL))
def q_report_returnflag(spark, sf_dir):
    return metrics.classification_report(_returnflag_scored(spark, sf_dir), "actual", "predicted")


# Softmax scorer over lineitem: classes A, N, R (codes 0, 1, 2).
def softmax_scores(li: DataFrame) -> DataFrame:
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    e0 = F.exp(F.lit(0.03) * q + d)
    e1 = F.exp(F.lit(1.0) - F.lit(0.02) * q + t)
    e2 = F.exp(F.lit(0.5))
    z = e0 + e1 + e2
    return li.select("*", (e0 / z).alias("p0"), (e1 / z).alias("p1"), (e2 / z).alias("p2"))


_SOFTMAX_SQL = """
select *, e0 / (e0 + e1 + e2) as p0, e1 / (e0 + e1 + e2) as p1, e2 / (e0 + e1 + e2) as p2
from (select *, exp(0.03 * l_quantity + l_discount) as e0, exp(1 - 0.02 * l_quantity + l_tax) as e1,
             exp(0.5) as e2 from lineitem) s
"""


@query("evaluate_returnflag_softmax", f"""
with s as ({_SOFTMAX_SQL}),
     p as (select case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as actual,
                  case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end as predicted,
                  p0, p1, p2 from s),
     l as (select actual as x from p union select predicted from p),
     st as (select l.x, (select count(*) from p where actual = l.x and predicted = l.x) as tp,
                   (select count(*) from p where actual = l.x) as sup,
                   (select count(*) from p where predicted = l.x) as pn from l),
     m as (select sup, tp, case when pn = 0 then 0.0 else tp::double / pn end as pr,
                  case when sup = 0 then 0.0 else tp::double / sup end as rc from st),
     f as (select *, case when pr + rc = 0 then 0.0 else 2 * pr * rc / (pr + rc) end as f1 from m)
select round(sum(tp)::double / sum(sup), 6) as accuracy,
       round(sum(pr * sup) / sum(sup), 6) as precision_weighted,
       round(sum(rc * sup) / sum(sup), 6) as recall_weighted,
       round(sum(f1 * sup) / sum(sup), 6) as f1_weighted,
       round((select avg(-ln(greatest(case actual when 0 then p0 when 1 then p1 else p2 end, 1e-15))) from p), 6)
         as log_loss
from f
""")
def q_evaluate(spark, sf_dir):
    s = softmax_scores(read_table(spark, sf_dir, "lineitem"))
    codes = ["A", "N", "R"]
    scored = labels.encode_with_list(s, "l_returnflag", codes, out="actual").select(
        "actual", "p0", "p1", "p2",
        F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0)
         .when(F.col("p1") >= F.col("p2"), 1).otherwise(2).alias("predicted"))
    return metrics.evaluate_classifier(scored, "actual", "predicted", ["p0", "p1", "p2"])


def _cv_rule(p: dict):
    """Stand-in scorer of a grid candidate on ``events``: predicts a purchase
    when the value is below n_estimators * max_depth / 10."""
    t = p["n_estimators"] * p["max_depth"] / 10.0
    return (F.col("value") < F.lit(t)) == (F.col("event_type") == F.lit("purchase"))


_FOLDS_SQL = """
select event_id, event_type, value,
       (row_number() over (partition by event_type
        order by md5('42:' || cast(event_id as varchar)), event_id) - 1) % 3 as fold from events
"""

_CV_SQL = f"""
with f as ({_FOLDS_SQL}),
     g as (select * from (values (0, 3, 50), (1, 3, 100), (2, 5, 50), (3, 5, 100))
           as g(candidate, max_depth, n_estimators)),
     s as (select g.candidate, f.fold,
                  avg(cast((f.value < g.n_estimators * g.max_depth / 10.0) = (f.event_type = 'purchase')
                      as double)) as score
           from f, g group by g.candidate, f.fold),
     m as (select candidate, avg(score) as raw, round(avg(score), 6) as mean_test_score,
                  round(stddev_pop(score), 6) as std_test_score from s group by candidate)
"""


@query("cv_scores_events", _CV_SQL + """
select m.candidate, g.max_depth, g.n_estimators, 42 as random_state,
       m.mean_test_score, m.std_test_score,
       cast(rank() over (order by m.raw desc) as integer) as rank_test_score
from m join g on m.candidate = g.candidate
""")
def q_cv_scores(spark, sf_dir):
    return training.rule_grid_search(_events_folds(spark, sf_dir), grid.DEFAULT_GRID, _cv_rule)


@query("best_candidate_events", _CV_SQL + """
select candidate, mean_test_score from m order by raw desc, candidate limit 1
""")
def q_best_candidate(spark, sf_dir):
    res = training.rule_grid_search(_events_folds(spark, sf_dir), grid.DEFAULT_GRID, _cv_rule)
    return metrics.best_candidate(res).select("candidate", "mean_test_score")


def _events_folds(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return sampling.stratified_folds(e, "event_type", "event_id", 3, 42)


# ---------------------------------------------------------------------------
# Crawl selection
# Stand-in: documents are the ranked catalog (owner = source, stars =
# n_chars); the labelled documents are the ones already handled; a fetch
# "fails" for German documents.
# ---------------------------------------------------------------------------

_CATALOG_SQL = """
select source || '/doc' || cast(doc_id as varchar) as _id, n_chars as stars, lang <> 'de' as ok,
       exists(select 1 from labels l where l.doc_id = d.doc_id) as is_downloaded
from documents d
"""


def _crawl_catalog(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.concat_ws("/", F.col("source"), F.concat(F.lit("doc"), F.col("doc_id").cast("string"))).alias("_id"),
        F.col("n_chars").alias("stars"), (F.col("lang") != "de").alias("ok"))


def _seen_log_file(spark, sf_dir) -> str:
    """The handled names as a text log, one per line, with stray whitespace."""
    docs = read_table(spark, sf_dir, "documents")
    seen = docs.join(read_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    path = scratch_path(spark, "log.txt")
    (_crawl_catalog(seen).select(F.concat(F.lit("  "), F.col("_id"), F.lit("\t")).alias("value"))
     .write.text(path))
    return path


@query("crawl_select_documents", f"""
with c as ({_CATALOG_SQL})
select _id, stars from c where not is_downloaded and ok order by stars desc, _id limit 25
""")
def q_crawl_select(spark, sf_dir):
    cat = _crawl_catalog(read_table(spark, sf_dir, "documents"))
    seen = crawl.load_seen(spark, _seen_log_file(spark, sf_dir))
    return crawl.select_run(cat, seen, k=25).select("_id", "stars")


@query("catalog_status_documents", """
with c as (select d.doc_id, exists(select 1 from labels l where l.doc_id = d.doc_id) as is_downloaded,
                  case when d.lang = 'de' then null else d.n_chars > 500 end as has_pandas,
                  d.lang = 'fr' as is_run
           from documents d)
select count(*) filter (where not is_downloaded) as n_to_fetch,
       count(*) filter (where has_pandas is null) as n_pandas_unknown,
       count(*) filter (where is_downloaded and has_pandas and not is_run) as n_pending_run from c
""")
def q_catalog_status(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    known = docs.select(F.concat_ws("/", "source", F.concat(F.lit("doc"), F.col("doc_id").cast("string"))).alias("_id"),
                        F.when(F.col("lang") != "de", F.col("n_chars") > 500).alias("p"), (F.col("lang") == "fr").alias("r"))
    cat = (catalog_from_documents(docs, seen=read_table(spark, sf_dir, "labels")).join(known, "_id")
           .withColumn("has_pandas", F.col("p")).withColumn("is_run", F.col("r")))
    one = F.count(F.lit(1))
    return (predicates.not_downloaded(cat).agg(one.alias("n_to_fetch"))
            .join(predicates.pandas_unknown(cat).agg(one.alias("n_pandas_unknown")), how="cross")
            .join(predicates.pending_run(cat).agg(one.alias("n_pending_run")), how="cross"))


@query("search_hits_pages", """
select count(*) as total_count from pages where contains(html, 'lang="en"') and ends_with(url, '.html')
""")
def q_search_hits(spark, sf_dir):
    return crawl.search_hits(read_table(spark, sf_dir, "pages"), 'lang="en"', "html", "html", "url")


@query("search_pages", """
select page_id, url from pages where contains(html, 'lang="en"') and ends_with(url, '.html')
""")
def q_search_pages(spark, sf_dir):
    return predicates.search(read_table(spark, sf_dir, "pages"), 'lang="en"', "html", "html", "url") \
        .select("page_id", "url")


@query("search_pages_indexed", ORACLE_SQL["search_pages"])
def q_search_pages_indexed(spark, sf_dir):
    """The search by trigram posting lists built over the pages."""
    index = text_index.build(read_table(spark, sf_dir, "pages"), "html")
    return index.search('lang="en"', "html", "url").select("page_id", "url")


@query("search_licences_indexed", """
select doc_id, contains(text, 'under the MIT License') as mit, contains(text, 'General Public License') as gpl
from documents where contains(text, 'under the MIT License') or contains(text, 'General Public License')
""")
def q_search_licences_indexed(spark, sf_dir):
    """Texts that hold one of two phrases: the union of their candidates, each tested."""
    terms = ["under the MIT License", "General Public License"]
    index = text_index.build(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    mit, gpl = [F.contains("text", F.lit(t)) for t in terms]
    return index.containing(terms).select("doc_id", mit.alias("mit"), gpl.alias("gpl"))


@query("first_n_orders", """
select o_orderkey, o_totalprice from orders order by o_orderkey limit 10
""")
def q_first_n(spark, sf_dir):
    return selection.first_n(read_table(spark, sf_dir, "orders"), 10, "o_orderkey") \
        .select("o_orderkey", "o_totalprice")


@query("insert_if_absent_catalog", f"""
with c as ({_CATALOG_SQL})
select _id, stars, is_downloaded, true as is_run from c where is_downloaded
union all
select _id, stars, is_downloaded, false as is_run from c where not is_downloaded
""")
def q_insert_if_absent(spark, sf_dir):
    root = scratch_path(spark, "store")
    collections.write_collection(catalog_from_documents(read_table(spark, sf_dir, "documents"),
                                                        seen=read_table(spark, sf_dir, "labels")),
                                 "crawl", "repos", root)
    cat = collections.read_collection(spark, "crawl", "repos", root)
    target = cat.where("is_downloaded").withColumn("is_run", F.lit(True))
    # every key arrives twice in the source; the first write (lower stars) wins
    source = cat.withColumn("stars", F.explode(F.array(F.col("stars") + 1, F.col("stars"))))
    return collections.insert_if_absent(target, source, "_id", order="stars") \
        .select("_id", "stars", "is_downloaded", "is_run")


@query("crawl_incremental_documents", f"""
with c as ({_CATALOG_SQL})
select _id from c where is_downloaded
union all
select _id from (select _id from c where not is_downloaded and ok order by stars desc, _id limit 50) t
""")
def q_crawl_incremental(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    cat = _crawl_catalog(docs)
    log = scratch_path(spark, "crawl-log")
    seen = crawl.load_seen(spark, _seen_log_file(spark, sf_dir))
    incremental.write_log_part(seen, log, "initial")
    for run in range(2):
        incremental.incremental_select(cat, log, 25, batch_id=f"r{run}")
    return incremental.read_key_log(spark, log)


@query("crawl_stream_documents", f"""
with c as ({_CATALOG_SQL})
select _id from c where is_downloaded
union all
select _id from (select _id from c where not is_downloaded and ok order by stars desc, _id limit 25) t
""")
def q_crawl_stream(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    log = scratch_path(spark, "crawl-log")
    incremental.write_log_part(crawl.load_seen(spark, _seen_log_file(spark, sf_dir)), log, "initial")
    # the catalog arrives in several files, two files per micro-batch
    src = scratch_path(spark, "arrivals")
    docs.repartition(5, "doc_id").write.parquet(src)
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(src)
    incremental.run_incremental_stream(_crawl_catalog(stream), scratch_path(spark, "candidates"), log,
                                       scratch_path(spark, "stream-ckpt"), 25)
    return incremental.read_key_log(spark, log)


@query("crawl_sorted_runs_documents", ORACLE_SQL["crawl_incremental_documents"])
def q_crawl_sorted_runs(spark, sf_dir):
    """The incremental runs over a catalog stored as three runs sorted by stars:
    each reads leading files only."""
    cat = _crawl_catalog(read_table(spark, sf_dir, "documents"))
    log, root = scratch_path(spark, "crawl-log"), scratch_path(spark, "runs")
    for i in range(3):  # the catalog arrived in three parts
        sorted_runs.add_run(cat.where(F.pmod(F.xxhash64("_id"), F.lit(3)) == i), root, "stars", "_id", file_rows=10_000)
    incremental.write_log_part(crawl.load_seen(spark, _seen_log_file(spark, sf_dir)), log, "initial")
    for run in range(2):
        incremental.incremental_select_runs(spark, root, log, 25, batch_id=f"r{run}")
    return incremental.read_key_log(spark, log)


@query("crawl_filtered_documents", ORACLE_SQL["crawl_select_documents"])
def q_crawl_filtered(spark, sf_dir):
    """The selection with a Bloom filter of the log in front of the anti join."""
    cat = _crawl_catalog(read_table(spark, sf_dir, "documents"))
    new = membership.unseen_filtered(cat, crawl.load_seen(spark, _seen_log_file(spark, sf_dir)), "_id")
    return selection.top_k(predicates.succeeded(new, "ok"), 25, "stars", "_id").select("_id", "stars")


@query("insert_if_absent_concurrent_catalog", """
with c as (select source || '/doc' || cast(doc_id as varchar) as _id, n_chars as stars, doc_id from documents)
select _id, stars, 'second' as writer from c where doc_id % 3 <> 0
union all select _id, stars, 'first' from c where doc_id % 3 = 0
""")
def q_insert_concurrent(spark, sf_dir):
    """Two writers insert overlapping parts of the catalog; the second begins
    later and commits earlier.  Each key is stored once, by whoever committed
    it first."""
    root = scratch_path(spark, "store")
    cat = read_table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", F.concat(F.lit("doc"), F.col("doc_id").cast("string"))).alias("_id"), F.col("n_chars").alias("stars"), "doc_id")
    part = lambda who, rows: cat.where(rows).select("_id", "stars", F.lit(who).alias("writer"))
    first = collections.begin_insert(part("first", "doc_id % 3 <> 2"), "crawl", "repos", "_id", root)
    second = collections.begin_insert(part("second", "doc_id % 3 <> 0"), "crawl", "repos", "_id", root)
    second.commit()
    first.commit()
    return collections.read_collection(spark, "crawl", "repos", root, "snapshot")


# ---------------------------------------------------------------------------
# Content test over cells (C1, C2, K3): conversations as notebooks, one row
# per cell; role "user" plays the code cell.
# ---------------------------------------------------------------------------

_CELL_TERMS = ("import pandas", "pd.", "tion")


@query("cells_contain_conversations", """
select conv_id, coalesce(bool_or(role = 'user' and (contains(text, 'import pandas') or contains(text, 'pd.')
                                                    or contains(text, 'tion'))), false) as contains
from conversations group by conv_id
""")
def q_cells_contain(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    return predicates.cells_contain_grouped(c, "conv_id", "role", "text", _CELL_TERMS, "user")


# ---------------------------------------------------------------------------
# Partial dependence with a SQL-expressible scorer
# ---------------------------------------------------------------------------

_PDP_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_PDP_POINTS = explain.DEFAULT_POINTS


def _pdp_sql(centre: bool = False, clip: tuple | None = None) -> str:
    parts = []
    for f in _PDP_FEATURES:
        q, d, t = [("g.x" if c == f else c) for c in _PDP_FEATURES]
        parts.append(f"""
  select '{f}' as feature, g.i as grid_index, g.x as x,
         exp(0.03 * {q} + {d}) as e0, exp(1 - 0.02 * {q} + {t}) as e1, exp(0.5) as e2
  from lineitem cross join (
    select cast(r.i as integer) as i, b.mn + (b.mx - b.mn) * r.i / {_PDP_POINTS - 1} as x
    from (select cast(min({f}) as double) as mn, cast(max({f}) as double) as mx from lineitem) b,
         range(0, {_PDP_POINTS}) r(i)) g""")
    body = " union all ".join(parts)
    sql = f"""
with z as ({body}),
     a as (select feature, grid_index, x, avg(e0 / (e0 + e1 + e2)) as p0, avg(e1 / (e0 + e1 + e2)) as p1,
                  avg(e2 / (e0 + e1 + e2)) as p2 from z group by feature, grid_index, x),
     l as (select feature, grid_index, x, 0 as class, p0 as pd from a
           union all select feature, grid_index, x, 1, p1 from a
           union all select feature, grid_index, x, 2, p2 from a)"""
    val = "pd - avg(pd) over (partition by feature, class)" if centre else "pd"
    sql += f""",
     c as (select feature, grid_index, x, class, {val} as pd from l)
select feature, grid_index, round(x, 6) as x, cast(class as integer) as class, round(pd, 6) as pd from c"""
    if clip:
        sql += f" where pd between {clip[0]} and {clip[1]}"
    return sql


def _pdp(spark, sf_dir, centre=False, clip=None):
    li = read_table(spark, sf_dir, "lineitem").select(*_PDP_FEATURES)
    curve = explain.partial_dependence(li, _PDP_FEATURES, softmax_scores, ["p0", "p1", "p2"],
                                       points=_PDP_POINTS, centre=centre)
    if clip:
        curve = explain.clip_curve(curve, *clip)
    return curve.select("feature", "grid_index", F.round("x", 6).alias("x"), "class",
                        F.round("pd", 6).alias("pd"))


@query("pdp_softmax_lineitem", _pdp_sql())
def q_pdp(spark, sf_dir):
    return _pdp(spark, sf_dir)


@query("pdp_centred_clipped_lineitem", _pdp_sql(centre=True, clip=explain.PLOT_LIMITS))
def q_pdp_clip(spark, sf_dir):
    return _pdp(spark, sf_dir, centre=True, clip=explain.PLOT_LIMITS)


@query("feature_ranges_lineitem", " union all ".join(
    f"select '{f}' as feature, min({f}) + 0.0 as mn, max({f}) + 0.0 as mx from lineitem" for f in _PDP_FEATURES))
def q_feature_ranges(spark, sf_dir):
    ranges = explain.feature_ranges(read_table(spark, sf_dir, "lineitem"), _PDP_FEATURES)
    # "+ 0.0" folds a signed zero (-0.0) into 0.0
    return spark.createDataFrame([(f, lo + 0.0, hi + 0.0) for f, (lo, hi) in ranges.items()],
                                 "feature string, mn double, mx double")


# ---------------------------------------------------------------------------
# Experiment log and registry tables (I1-I6, W3, D6): the grid search is run
# once per event type (one-vs-rest), each a parent run with a child run per
# candidate; the tables are built from that result.
# ---------------------------------------------------------------------------

def _cv_by_target(spark, sf_dir) -> DataFrame:
    """Fold scores of every (target, candidate): the data are counted once per
    (fold, event type); what a target scores follows from those counts, so the
    plan does not grow with the number of event types."""
    cands = grid.param_grid(grid.DEFAULT_GRID)
    below = [F.count_if(F.col("value") < F.lit(c["n_estimators"] * c["max_depth"] / 10.0)).alias(f"b{i}") for i, c in enumerate(cands)]
    per = small_table(_events_folds(spark, sf_dir).groupBy("fold", "event_type").agg(F.count(F.lit(1)).alias("n"), *below))
    pairs = ", ".join(f"{i}, b{i}" for i in range(len(cands)))
    long = per.select("fold", "event_type", "n", F.expr(f"stack({len(cands)}, {pairs}) as (candidate, b)"))
    # right for a target: its own rows below, and of all others those that are not
    all_n, all_b = (F.sum(c).over(Window.partitionBy("candidate", "fold")) for c in ("n", "b"))  # a row per event type
    right = F.col("b") + (all_n - F.col("n")) - (all_b - F.col("b"))
    scores = long.select(F.col("event_type").alias("target"), "candidate", "fold", (right / all_n).alias("score"))
    cv = scores.groupBy("target", "candidate").agg(
        F.round(F.avg("score"), 6).alias("mean_test_score"), F.round(F.stddev_pop("score"), 6).alias("std_test_score"))
    return (grid.grid_frame(spark, grid.DEFAULT_GRID).join(cv, "candidate")
            .select("target", "candidate", *sorted(grid.DEFAULT_GRID), "mean_test_score", "std_test_score"))


def _run_tables(spark, sf_dir, *names: str) -> dict:
    """The named tracking tables of the search, written below a registry root
    and read back: runs, params, metrics, and per run tags (logged out of order,
    one key overwritten), artifacts (one path logged twice) and model versions
    (registered in order of their score)."""
    cv = small_table(_cv_by_target(spark, sf_dir))
    t = registry.cv_run_tables(cv, "target", sorted(grid.DEFAULT_GRID))
    run = F.concat("target", F.lit("/"), F.col("candidate").cast("string")).alias("run_id")
    def tag(k, v, seq):
        return F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"), F.lit(seq).cast("long").alias("seq"))
    def micro(c):
        return F.round(F.col(c) * 1000000).cast("long")
    t["tags"] = cv.select(run, F.explode(F.array(
        tag("score", micro("mean_test_score"), 7), tag("score", F.lit(0), 3), tag("spread", micro("std_test_score"), 1))).alias("t")) \
        .select("run_id", "t.*")
    depth = F.concat(F.lit("depth_"), F.col("max_depth").cast("string"), F.lit(".json"))
    trees = F.concat(F.lit("trees_"), F.col("n_estimators").cast("string"), F.lit(".json"))
    t["artifacts"] = cv.select(run, F.lit("evaluation").alias("dir"), F.explode(F.array(trees, depth, depth)).alias("path")).unionByName(
        cv.select(F.concat("target", F.lit("/parent")).alias("run_id"), F.lit("candidates").alias("dir"),
                  F.concat(F.col("candidate").cast("string"), F.lit(".csv")).alias("path")))
    order = Window.partitionBy("target").orderBy("mean_test_score", "candidate")  # as many rows as candidates
    t["models"] = cv.select(F.concat(F.lit("rf_"), F.col("target")).alias("name"),
                            F.row_number().over(order).alias("version"), run)
    t["models"] = t["models"].withColumn("uri", registry.model_uri(F.col("name"), F.col("version")))
    root = scratch_path(spark, "registry")
    for name in names:
        registry.log_rows(t[name], root, name)
    return {name: registry.read(spark, root, name) for name in names}


_CV_TARGET_SQL = f"""
with f as ({_FOLDS_SQL}),
     t as (select distinct event_type as target from events),
     g as (select * from (values (0, 3, 50), (1, 3, 100), (2, 5, 50), (3, 5, 100))
           as g(candidate, max_depth, n_estimators)),
     s as (select t.target, g.candidate, f.fold,
                  avg(cast((f.value < g.n_estimators * g.max_depth / 10.0) = (f.event_type = t.target)
                      as double)) as score
           from f, g, t group by t.target, g.candidate, f.fold),
     m as (select s.target, s.candidate, g.max_depth, g.n_estimators, round(avg(score), 6) as mean_test_score,
                  round(stddev_pop(score), 6) as std_test_score
           from s join g on s.candidate = g.candidate group by s.target, s.candidate, g.max_depth, g.n_estimators),
     runs as (select target || '/' || cast(candidate as varchar) as run_id, target || '/parent' as parent_run_id,
                     target as experiment, 'Child_Run_CV_' || cast(candidate as varchar) as run_name, * from m)"""


@query("leaderboard_events", _CV_TARGET_SQL + """
select run_id, parent_run_id, experiment, run_name, mean_test_score, std_test_score,
       cast(max_depth as varchar) as max_depth, cast(n_estimators as varchar) as n_estimators,
       '42' as random_state from runs
""")
def q_leaderboard(spark, sf_dir):
    t = _run_tables(spark, sf_dir, "runs", "params", "metrics")
    return registry.leaderboard(t["runs"], t["params"], t["metrics"], ["mean_test_score", "std_test_score"],
                                sorted(grid.DEFAULT_GRID))


@query("child_rollup_events", _CV_TARGET_SQL + """
select parent_run_id as run_id, count(*) as n_children,
       first(run_name order by mean_test_score desc, run_name) as best_child,
       max(mean_test_score) as best_mean_test_score
from runs group by parent_run_id
""")
def q_child_rollup(spark, sf_dir):
    t = _run_tables(spark, sf_dir, "runs", "metrics")
    return registry.child_rollup(t["runs"], t["metrics"], "mean_test_score")


@query("experiment_runs_events", _CV_TARGET_SQL + """
select run_id, parent_run_id, experiment, run_name from runs where experiment = 'purchase'
union all select 'purchase/parent', null, 'purchase', 'cv_search'
""")
def q_experiment_runs(spark, sf_dir):
    return registry.experiment_runs(_run_tables(spark, sf_dir, "runs")["runs"], "purchase")


_MICRO = "cast(cast(round({} * 1000000) as bigint) as varchar)"


@query("current_tags_events", _CV_TARGET_SQL + f"""
select run_id, 'score' as key, {_MICRO.format('mean_test_score')} as value from runs
union all select run_id, 'spread', {_MICRO.format('std_test_score')} from runs
""")
def q_current_tags(spark, sf_dir):
    return registry.current_tags(_run_tables(spark, sf_dir, "tags")["tags"])


@query("artifact_index_events", _CV_TARGET_SQL + """
select run_id, 'evaluation' as dir,
       ['depth_' || cast(max_depth as varchar) || '.json', 'trees_' || cast(n_estimators as varchar) || '.json'] as paths,
       cast(2 as bigint) as n from runs
union all select parent_run_id, 'candidates', list(cast(candidate as varchar) || '.csv' order by candidate), count(*)
from runs group by parent_run_id
""")
def q_artifact_index(spark, sf_dir):
    return registry.artifact_index(_run_tables(spark, sf_dir, "artifacts")["artifacts"])


@query("latest_model_versions_events", _CV_TARGET_SQL + """,
     v as (select *, row_number() over (partition by experiment order by mean_test_score, candidate) as version from runs)
select 'rf_' || experiment as name, cast(version as integer) as version,
       'models:/rf_' || experiment || '/' || cast(version as varchar) as uri, run_id
from v where version = (select count(*) from runs r where r.experiment = v.experiment)
""")
def q_latest_versions(spark, sf_dir):
    return registry.latest_versions(_run_tables(spark, sf_dir, "models")["models"])


# ---------------------------------------------------------------------------
# Model pipeline on MLlib (B9, B10, H2-H8, I8, I9, J2 with a forest, K1):
# rows-only checks - forests are not comparable with any SQL.
# ---------------------------------------------------------------------------

def _quality(spark, sf_dir):
    return ml.quality_data(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def _ml_run(spark, sf_dir):
    return ml.train_and_register(spark, _quality(spark, sf_dir), ml.QUALITY_FEATURES, "quality", "doc_id",
                                 scratch_path(spark, "registry"), "quality_rf")


@query("ml_cv_results_quality")
def q_ml_cv(spark, sf_dir):
    return _ml_run(spark, sf_dir)["cv"]


@query("ml_test_report_quality")
def q_ml_report(spark, sf_dir):
    return _ml_run(spark, sf_dir)["report"]


@query("ml_pdp_forest_quality")
def q_ml_pdp(spark, sf_dir):
    data = ml.prepare(_quality(spark, sf_dir))
    root = scratch_path(spark, "registry")
    model = training.fit_forest(data, ml.QUALITY_FEATURES, "quality", 50, 5, 42, n_classes=2, key="doc_id")
    registry.register_model(spark, model, "quality_rf", root)
    return ml.explain_latest(spark, data, ml.QUALITY_FEATURES, root, "quality_rf", 2)


@query("ml_forest_curves_agree_quality", """
with d as (select count(*) as n from documents d join labels l on d.doc_id = l.doc_id)
select cast(5 * 30 * 2 as bigint) as n_points, true as equal, cast(0 as bigint) as rows_lost from d
""")
def q_forest_curves(spark, sf_dir):
    """Curves from leaf counts against curves by scoring every row at every
    point: as many values, none further apart than 1e-9, and every row in one
    leaf of every tree."""
    data = ml.prepare(_quality(spark, sf_dir))
    model = training.fit_forest(data, ml.QUALITY_FEATURES, "quality", 20, 5, 42, n_classes=2, key="doc_id")
    x = data.select(*ml.QUALITY_FEATURES)
    fast = forest_curves.curves(x, model, ml.QUALITY_FEATURES)
    plain = explain.partial_dependence(x, ml.QUALITY_FEATURES, explain.model_scorer(model, ml.QUALITY_FEATURES, 2), ["p0", "p1"])
    both = fast.join(plain.withColumnRenamed("pd", "other").drop("x"), ["feature", "grid_index", "class"])
    trees = forest_curves.forest_trees(spark, model.stages[-1])
    per = forest_curves.leaf_counts(x, trees, ml.QUALITY_FEATURES).where("feature = -1").groupBy("tree").agg(F.sum("n").alias("n"))
    lost = per.agg(F.max(F.abs(F.col("n") - F.lit(data.count()))).alias("rows_lost"))
    return (both.agg(F.count(F.lit(1)).alias("n_points"), (F.max(F.abs(F.col("pd") - F.col("other"))) < 1e-9).alias("equal"))
            .join(lost, how="cross"))


# ---------------------------------------------------------------------------
# Stage counts, shapes, train stages, labelled sources (E1, E2, H8, H9, A6,
# B3, B8), and a Python-model scorer through an Arrow-batched UDF
# ---------------------------------------------------------------------------

@query("etl_stage_counts_customer", """
select 'extract' as stage, count(*) as n from customer
union all select 'transform', count(*) from customer
union all select 'load', count(*) from customer
""")
def q_stage_counts(spark, sf_dir):
    src = _csv_copy(read_table(spark, sf_dir, "customer"), spark, "customer")
    stages = etl.Stages(db="etl_counts", root=scratch_path(spark, "store"))
    return etl.run_etl_counted(spark, src, stages, key="c_custkey", drop=("extra", "c_name"))


@query("stage_shape_lineitem", """
select count(*) as n_rows, 11 as n_cols from lineitem
""")
def q_shape(spark, sf_dir):
    rows, cols = collections.shape(read_table(spark, sf_dir, "lineitem"))
    return spark.createDataFrame([(rows, cols)], "n_rows long, n_cols int")


@query("expl_train_stage_customer", """
select c_acctbal, c_nationkey, c_mktsegment, cast(null as double) as c_score from customer
""")
def q_expl_train(spark, sf_dir):
    stages = etl.Stages(db="expl", root=scratch_path(spark, "store"))
    cols = [("c_acctbal", "double"), ("c_nationkey", "int"), ("c_mktsegment", "string"), ("c_score", "double")]
    return etl.expl_pipeline(spark, read_table(spark, sf_dir, "customer"), cols, stages, key="c_custkey")


@query("train_stage_events", """
select event_id, user_id, value, event_type,
       case when row_number() over (order by md5('42:' || cast(event_id as varchar)), event_id)
                 <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split
from events
""")
def q_train_stage(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    cols = [("event_id", None), ("user_id", None), ("value", "double"), ("event_type", None)]
    split = sampling.with_split(e.select("event_id"), "event_id", 0.2, 42)
    staged = training.train_stage(e, cols).join(split, "event_id")
    root = scratch_path(spark, "store")
    collections.write_collection(staged, "ml", "train", root)
    return collections.read_collection(spark, "ml", "train", root)


_VECTOR = 64  # elements of an embedding


@query("labelled_source_embeddings", "select vec_id, " + ", ".join(
    f"embedding[{i + 1}] as f{i}" for i in range(_VECTOR)) + ", cast(label as integer) as target from embeddings")
def q_labelled_source(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    names = [f"f{i}" for i in range(_VECTOR)]
    wide = e.select("vec_id", *[F.col("embedding")[i].alias(n) for i, n in enumerate(names)], "label")
    return labelled_source(wide, ["vec_id", *names], "label", "target")


def _numpy_softmax(model, X):
    """A single-machine model: the lineitem softmax written with NumPy."""
    import numpy as np
    q, d, t = X["l_quantity"].to_numpy(), X["l_discount"].to_numpy(), X["l_tax"].to_numpy()
    e = np.stack([np.exp(0.03 * q + d), np.exp(1 - 0.02 * q + t), np.full(len(q), np.exp(0.5))], axis=1)
    return e / e.sum(axis=1, keepdims=True)


@query("pdp_pandas_scorer_lineitem", _pdp_sql())
def q_pdp_pandas(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(*_PDP_FEATURES)
    scorer = training.pandas_scorer(_numpy_softmax, _PDP_FEATURES, 3)
    curve = explain.partial_dependence(li, _PDP_FEATURES, scorer, ["p0", "p1", "p2"], points=_PDP_POINTS)
    return curve.select("feature", "grid_index", F.round("x", 6).alias("x"), "class",
                        F.round("pd", 6).alias("pd"))


@query("ml_forest_orders")
def q_ml_forest_orders(spark, sf_dir):
    """One forest fit at scale (50 trees, depth 5) on the price band of
    orders, evaluated on the held-out 20 %: the classification report."""
    data = ml.prepare(ml.order_data(read_table(spark, sf_dir, "orders")))
    split = sampling.with_split(data, "o_orderkey", 0.2, 42)
    model = training.fit_forest(split.where("split = 'train'"), ml.ORDER_FEATURES, "band", 50, 5, 42, n_classes=3, key="o_orderkey")
    scored = model.transform(split.where("split = 'test'")).withColumn("prediction", F.col("prediction").cast("int"))
    return metrics.classification_report(scored, "band", "prediction")


@query("ml_forest_fit_lineitem")
def q_forest_fit_lineitem(spark, sf_dir):
    """The timing workload of the baseline notes: one forest (50 trees,
    depth 5) on four lineitem measures -> return flag.  The flag carries no
    learnable signal, so the output is the fitted model's feature
    importances, not a quality claim."""
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    line = (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("line")
    li = spread(read_table(spark, sf_dir, "lineitem").select(line, *feats, "l_returnflag"))
    data = ml.prepare(labels.encode_with_list(li, "l_returnflag", ["A", "N", "R"], out="label"))
    model = training.fit_forest(data.select("line", *feats, "label"), feats, "label", 50, 5, 42, n_classes=3, key="line")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(feats, imp)), "feature string, importance double")


_SPLIT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("exact_split_lineitem", "with n as (" + " union all ".join(
    f"select {i} as f, '{c}' as feature, cast({c} as double) as v, cast(l_linenumber > 2 as integer) as y from lineitem" for i, c in enumerate(_SPLIT_FEATURES)) + """),
     g as (select f, feature, v, count(*) filter (where y = 0) as c0, count(*) filter (where y = 1) as c1 from n group by all),
     l as (select *, sum(c0) over w as l0, sum(c1) over w as l1, lead(v) over (partition by f order by v) as nxt,
                  sum(c0) over (partition by f) as t0, sum(c1) over (partition by f) as t1
           from g window w as (partition by f order by v rows unbounded preceding)),
     s as (select *, (l0 * l0 + l1 * l1)::double / (l0 + l1)
                     + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1))::double / (t0 + t1 - l0 - l1) as score
           from l where nxt is not null)
select feature, round(v + (nxt - v) / 2, 9) as threshold, (l0 + l1)::bigint as n_left, (t0 + t1 - l0 - l1)::bigint as n_right
from s order by score desc, f, v limit 1
""")
def q_exact_split(spark, sf_dir):
    """The best split of all rows among every place between two neighbouring
    values of four measures (the root of an exact tree), and what it parts."""
    li = read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("line"), *_SPLIT_FEATURES, (F.col("l_linenumber") > 2).cast("int").alias("y"))
    (tree,) = exact_trees.fit_exact(li, _SPLIT_FEATURES, "y", "line", 2, max_depth=1)
    root = exact_trees.tree_table(spark, [tree], _SPLIT_FEATURES).first()
    left = F.count_if(F.col(root["feature"]) <= F.lit(root["threshold"]))
    return li.agg(F.lit(root["feature"]).alias("feature"), F.round(F.lit(root["threshold"]), 9).alias("threshold"),
                  left.alias("n_left"), (F.count(F.lit(1)) - left).alias("n_right"))


@query("ml_exact_forest_quality", """
with d as (select count(*) as n from documents d join labels l on d.doc_id = l.doc_id)
select cast(10 as integer) as n_trees, true as beats_majority, true as probabilities_sum_to_one, true as curves_equal, n as n_rows from d
""")
def q_exact_forest(spark, sf_dir):
    """A forest of exact trees: better than the majority on its rows,
    probabilities that sum to one, curves from leaf counts equal to curves by scoring."""
    data = ml.prepare(_quality(spark, sf_dir))
    feats = ml.QUALITY_FEATURES
    trees = exact_trees.fit_exact(data, feats, "quality", "doc_id", 2, trees=10, max_depth=4)
    score = exact_trees.tree_scorer(trees, feats)
    scored = score(data).select("*", (F.col("p1") > F.col("p0")).cast("int").alias("guess"))
    fast = forest_curves.curves(data.select(*feats), trees, feats, 10)
    plain = explain.partial_dependence(data.select(*feats), feats, score, ["p0", "p1"], 10)
    apart = fast.join(plain.withColumnRenamed("pd", "other").drop("x"), ["feature", "grid_index", "class"]).agg(F.max(F.abs(F.col("pd") - F.col("other"))).alias("d"))
    right = F.avg((F.col("guess") == F.col("quality")).cast("double"))
    ones = F.avg(F.col("quality").cast("double"))
    return (scored.agg(F.lit(len(trees)).alias("n_trees"), (right > F.greatest(ones, 1 - ones)).alias("beats_majority"),
                       (F.max(F.abs(F.col("p0") + F.col("p1") - 1)) < 1e-9).alias("probabilities_sum_to_one"), F.count(F.lit(1)).alias("n_rows"))
            .join(apart.select((F.col("d") < 1e-9).alias("curves_equal")), how="cross"))


@query("insert_if_absent_stored_catalog", ORACLE_SQL["insert_if_absent_catalog"])
def q_insert_if_absent_stored(spark, sf_dir):
    """The same upsert against a stored collection: the handled repositories
    are stored first, then the whole catalog is inserted-if-absent (only the
    missing keys are appended)."""
    root = scratch_path(spark, "store")
    cat = catalog_from_documents(read_table(spark, sf_dir, "documents"), seen=read_table(spark, sf_dir, "labels"))
    collections.write_collection(cat.where("is_downloaded").withColumn("is_run", F.lit(True)), "crawl", "repos", root)
    source = cat.withColumn("stars", F.explode(F.array(F.col("stars") + 1, F.col("stars"))))
    collections.insert_if_absent_into(source, "crawl", "repos", "_id", root, order="stars")
    return collections.read_collection(spark, "crawl", "repos", root).select("_id", "stars", "is_downloaded", "is_run")


@query("write_sample_events", """
select cast(event_id as integer) as event_id, cast(user_id as integer) as user_id, event_type, value
from events order by event_id limit 10
""")
def q_write_sample(spark, sf_dir):
    """The dataset-sample sink (A14): first 10 rows by key as one CSV file
    with header, read back."""
    path = scratch_path(spark, "dataset_samples")
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    collections.write_sample(e, path, "event_id", 10)
    return csv_scan(spark, path)


@query("confusion_matrix_wide_returnflag", f"""
with p as ({_RETURNFLAG_SQL})
select actual,
       cast(count(*) filter (where predicted = 'A') as bigint) as "A",
       cast(count(*) filter (where predicted = 'N') as bigint) as "N",
       cast(count(*) filter (where predicted = 'R') as bigint) as "R"
from p group by actual
""")
def q_cm_wide(spark, sf_dir):
    """Rows = actual flag, one column per predicted flag, zeros kept."""
    return metrics.confusion_matrix_wide(_returnflag_scored(spark, sf_dir), "actual", "predicted")


@query("split_xy_events", """
select event_id, user_id, value from events
""")
def q_split_xy(spark, sf_dir):
    """Feature part of the feature/target separation; both parts keep the
    key, so they pair again by join (B5)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    x, _y = columns.split_xy(e, "event_type", key="event_id")
    return x


@query("report_json_returnflag", _report_sql(_RETURNFLAG_SQL))
def q_report_json(spark, sf_dir):
    """The report sink (A15): the classification report as one JSON document
    (class -> metrics, ``accuracy`` a number) written as text, read back and
    taken apart into the report's rows."""
    path = scratch_path(spark, "evaluation")
    rep = metrics.classification_report(_returnflag_scored(spark, sf_dir), "actual", "predicted", digits=None)
    collections.write_report(metrics.report_json(rep), path)
    doc = spark.read.text(path).select(F.explode(F.from_json("value", "map<string, string>")).alias("class", "body"))
    m = F.from_json("body", "`precision` double, `recall` double, `f1-score` double, `support` bigint")
    rows = doc.select("class", F.when(F.col("class") != "accuracy", m).alias("m"),
                      F.when(F.col("class") == "accuracy", F.col("body").cast("double")).alias("a"))
    n = rows.agg(F.max("m.support").alias("n"))  # the accuracy entry has no support of its own
    kind = F.when(F.col("class").isin(*metrics.SUMMARY_ROWS), "summary").otherwise("class")
    r6 = lambda c: F.round(c, 6)
    return rows.join(F.broadcast(n), how="cross").select(
        kind.alias("kind"), "class", r6(F.col("m.precision")).alias("precision"), r6(F.col("m.recall")).alias("recall"),
        r6(F.coalesce(F.col("m.f1-score"), F.col("a"))).alias("f1_score"), F.coalesce("m.support", "n").alias("support"))


_QUALITY_SPLIT_SQL = """
with d as (select d.doc_id, l.quality from documents d join labels l on d.doc_id = l.doc_id),
     s as (select *, row_number() over (order by md5('42:' || cast(doc_id as varchar)), doc_id)
                     <= ceil(0.2 * count(*) over ()) as test from d)
"""


@query("ml_invariants_quality", _QUALITY_SPLIT_SQL + """
select count(*) filter (where test) as n_test, count(*) filter (where test and quality = 0) as support_0,
       count(*) filter (where test and quality = 1) as support_1, cast(4 as bigint) as n_candidates,
       cast(1 as integer) as version, true as beats_majority, true as probabilities_sum_to_one, true as reload_equal,
       true as best_is_rank_one, ['distinct_word_share', 'letter_share', 'n_chars', 'n_lines', 'n_words'] as inputs,
       cast(1 as bigint) as n_outputs from s
""")
def q_ml_invariants(spark, sf_dir):
    """What must hold for the whole model pipeline whatever trees it grows
    (B9, B10, D7, H2-H7, I7-I9): sizes and supports of the test part, a table
    of all candidates, a model better than the majority, probabilities that sum
    to one, a registered model that predicts the same after loading, a stored
    signature."""
    root = scratch_path(spark, "registry")
    data = ml.prepare(_quality(spark, sf_dir))
    res = ml.train_and_register(spark, data, ml.QUALITY_FEATURES, "quality", "doc_id", root, "quality_rf")
    rep = {(r["kind"], r["class"]): r for r in res["report"].collect()}
    top = data.groupBy("quality").count().agg((F.max("count") / F.sum("count")).alias("m")).first()["m"]
    p = training.score_proba(res["model"], data, res["n_classes"])
    off = p.where(F.abs(sum(F.col(f"p{i}") for i in range(res["n_classes"])) - 1) > 1e-9).count()
    again = training.score(registry.load_latest(spark, root, "quality_rf"), data).select("doc_id", "prediction")
    differ = training.score(res["model"], data).select("doc_id", "prediction").exceptAll(again).count()
    sig = registry.read(spark, root, "signatures")
    best = registry.read(spark, root, "params").where(F.col("run_id") == res["run_id"]).select("key", "value")
    first = res["cv"].where("rank_test_score = 1").orderBy("candidate").first()
    row = (rep["summary", "accuracy"]["support"], rep["class", "0"]["support"], rep["class", "1"]["support"],
           res["cv"].count(), registry.latest_versions(registry.read(spark, root, "models")).first()["version"],
           rep["summary", "accuracy"]["f1_score"] > top, off == 0, differ == 0,
           all(str(first[r["key"]]) == r["value"] for r in best.collect()),
           sorted(r["name"] for r in sig.where("side = 'inputs'").collect()), sig.where("side = 'outputs'").count())
    return spark.createDataFrame([row], "n_test long, support_0 long, support_1 long, n_candidates long, version int, "
                                        "beats_majority boolean, probabilities_sum_to_one boolean, reload_equal boolean, "
                                        "best_is_rank_one boolean, inputs array<string>, n_outputs long")


@query("notebooks_conversations", """
select conv_id, conv_id % 7 <> 3 and coalesce(bool_or(role = 'user' and (contains(text, 'import pandas')
       or contains(text, 'pd.') or contains(text, 'tion'))), false) as contains
from conversations group by conv_id
""")
def q_notebooks(spark, sf_dir):
    """Conversations written as notebook files, one file each, and scanned
    (A8, C1, C2): every fifth in the older layout, every seventh not JSON at
    all, which counts as "does not contain"."""
    c = read_table(spark, sf_dir, "conversations")
    code = F.col("role").alias("cell_type")
    now = F.to_json(F.struct(F.collect_list(F.struct(code, F.col("text").alias("source"))).alias("cells")))
    old = F.to_json(F.struct(F.array(F.struct(F.collect_list(F.struct(code, F.col("text").alias("input"))).alias("cells"))).alias("worksheets")))
    body = F.when(F.col("conv_id") % 7 == 3, "{not json").when(F.col("conv_id") % 5 == 1, F.col("old")).otherwise(F.col("now"))
    path = scratch_path(spark, "notebooks")
    (c.groupBy("conv_id").agg(now.alias("now"), old.alias("old")).select("conv_id", body.alias("value"))
     .write.partitionBy("conv_id").text(path))
    books = notebook_scan(spark, f"{path}/*")
    return predicates.notebook_contains(books, _CELL_TERMS, "user").select(
        F.regexp_extract("path", r"conv_id=(\d+)", 1).cast("long").alias("conv_id"), "contains")
