"""The registered queries of this subpackage (``QUERIES``) and their DuckDB
SQL twins where SQL can state them (``ORACLE_SQL``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, exact_dedup, langid, license_scan, ngram_join, ngram_lm, quality, ranked_search, sentencepiece_scan, suffix_dedup, token_output, url_filter, whitening
from lodestone.llm.common import fold_of, read_table
from lodestone.session import scratch_path

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = fold_of("doc_id", 4) == 2
    model = langid.learn(docs, ~held)
    out = langid.predict(docs, model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "margin", "accepted")


def byte_bpe() -> str:
    """Path of the byte-level BPE vocabulary (the installed public tokenizers)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op3_token_output")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_output.write_tokens(read_table(spark, sf_dir, "documents"), path, byte_bpe(), end_id=2, added=True)
    return token_output.read_documents(spark, path)


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = fold_of("doc_id", 7) == 2
    scores = ngram_lm.corpus_scores(read_table(spark, sf_dir, "documents"), ~held)
    return scores.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held = fold_of("doc_id", 5) == 0
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"), ~held)
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


#: Fixed rules of the query: (verdict, host, path prefix).
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


@query("op7_exact_dedup", """
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) as h
  from documents)
select doc_id, max(doc_id) over (partition by h) as keep_id,
       count(*) over (partition by h) as group_size,
       doc_id = max(doc_id) over (partition by h) as kept, h as text_sha256
from t
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def piece_model() -> str:
    """Path of the SentencePiece model (the installed public tokenizers)."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_scan.encode(read_table(spark, sf_dir, "documents"), piece_model())
    decoded = sentencepiece_scan.decode(encoded, piece_model())
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
                          (F.xxhash64("text") == F.col("text_hash")).alias("lossless"))


@query("op10_ngram_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id", "class_id"))


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_ranked_search", r"""
with folded as (
  select row_number() over () as u, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
docs as (select u, doc_id, w, len(w) as n from folded where len(w) > 0),
stat as (select count(*) as docs, coalesce(sum(n), 0)::bigint as total from docs),
item_term as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
token as (select u, unnest(w) as term from docs),
tf as (select u, term, count(*) as tf from token where term in (select term from item_term) group by all),
weight as (
  select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
  from tf, stat group by term, docs),
norm as (select u, doc_id, 10 + (90 * n * docs) // total as m from docs, stat),
score as (
  select item_id, u, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from tf join weight using (term) join item_term using (term) join norm using (u)
  group by item_id, u, doc_id),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id asc nulls last, u)::integer as rank,
         doc_id, score
  from score where score > 0)
select * from ranked where rank <= 10
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


#: Fixed phrases of the query: (label, words).
LICENSE_PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]


def _license_sql() -> str:
    """The scan in SQL, over the same templates."""
    rows = ", ".join(f"({t}, '{label}', {str(exact).lower()}, '{' '.join(w)}')"
                     for t, label, exact, w in license_scan.templates(LICENSE_PHRASES, license_scan.NOTICES))
    return rf"""
with doc as (
  select row_number() over () as u, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
template(tpl, label, base, phrase) as (values {rows}),
place as (
  select tpl, label, base, len(p) - 2 as grams, unnest(range(len(p) - 2)) as tpos, p
  from (select *, string_split(phrase, ' ') as p from template)),
tgram as (select * exclude (p), p[tpos + 1] || ' ' || p[tpos + 2] || ' ' || p[tpos + 3] as gram from place),
begin_at as (select u, w, unnest(range(len(w) - 2)) as pos from doc),
dgram as (select u, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] as gram from begin_at),
hit as (select u, tpl, label, base, grams, tpos, pos, pos - tpos as diag from dgram join tgram using (gram)),
voted as (
  select *, count(*) over (partition by u, tpl, diag) as votes,
         case when diag - lag(diag) over (partition by u, tpl order by diag) > {license_scan.GAP} then 1 else 0 end as apart
  from hit),
spanned as (
  select *, sum(apart) over (partition by u, tpl order by diag rows unbounded preceding) as span,
         case when base and votes = grams and tpos = 0 then diag end as start
  from voted),
span as (
  select u, tpl, span, label, grams, max(votes) as votes, count(distinct tpos) as covered,
         max(pos) - min(pos) + 3 as length, count(start) as places, min(start) as first, max(start) as last
  from spanned group by all),
judged as (
  select *, places > 0 or votes >= grams * {license_scan.COVER}
            or (covered >= grams * {license_scan.COVER} and length <= (grams + 2) * {license_scan.SLACK}) as verified
  from span),
per as (
  select u, sum(places)::bigint as n_base, min(first) as first_word, max(last) as last_word,
         string_agg(distinct label, ',' order by label) filter (places > 0) as base_labels,
         string_agg(distinct label, ',' order by label) filter (verified) as labels,
         max(covered / grams) as score
  from judged group by u)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from doc left join per using (u)
"""


@query("op11_license_scan", _license_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents"), LICENSE_PHRASES)
