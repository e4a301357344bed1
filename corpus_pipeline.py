"""A corpus pipeline of five stages over ``documents``.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read back as the next stage's ``docs``.  All but the last return
the columns of ``documents``.

1. quality: texts the classifier rejects go (null and empty texts are scored
   like all others).
2. exact_dedup: of equal texts (A-Z lower-cased) the largest id stays.
3. near_dedup: of documents linked by a Jaccard similarity of 0.8 or more over
   five-word shingles the smallest id of each group stays.
4. decontaminate: documents that hold a benchmark item go.
5. tokenise: SentencePiece ids, and whether decoding them gives the text again.

Empty tables pass through all stages; null and empty texts are judged like all
others (quality scores them, exact dedup makes one of them, they link to
nothing and hold no item, and have no ids); repeated rows meet their end in
stage 2; rows with a null id are never linked in stage 3 and stay there.  An id
that stands at two texts is two documents: each is kept or dropped by its own
text.  Very long texts are read whole, part by part.  Other columns, whatever
their names, pass through the filtering stages as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, exact_dedup, ngram_join, quality, sentencepiece_scan
from lodestone.llm.common import fold_of, read_table, small_batches, stored
from lodestone.llm.queries import piece_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"), fold_of("doc_id", 5) != 0)
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.near_duplicate_survivors(docs, words=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    encoded = sentencepiece_scan.encode(docs, piece_model())
    return (sentencepiece_scan.decode(encoded, piece_model())
            .select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
                    (F.xxhash64("text") == F.col("text_hash")).alias("lossless")))


STAGES = [("quality", keep_quality), ("exact_dedup", drop_exact_copies), ("near_dedup", drop_near_copies),
          ("decontaminate", drop_benchmark_leaks), ("tokenise", tokenise)]

#: SQL cannot state the classifier, the join's groups or the encoder; the stages
#: are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
