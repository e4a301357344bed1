"""Hash shards stay small when a third of all rows are one text."""
import random

import pytest
from pyspark.sql import functions as F

from lodestone.llm import chunks as C, ngram_join as J, ngram_lm as L, suffix_dedup as X

SHARD = 1 << 16


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(6)
    voc = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(4000)]
    hot = " ".join(rnd.choice(voc) for _ in range(80))
    data = [(i, hot if i % 3 == 0 else " ".join(rnd.choice(voc) for _ in range(80))) for i in range(3000)]
    return spark.createDataFrame(data, "doc_id long, text string").repartition(4)


def largest(sent, shards):
    per = sent.groupBy("shard").agg(F.sum(F.length("blob")).alias("n")).agg(F.max("n")).first()[0]
    assert shards >= 20
    return per


def test_suffix_runs(rows):
    chunks = C.chunked(rows, "doc_id", "text", size=1 << 18)
    n = C.shards_for(chunks, 1 << 18, SHARD)
    flags = X.repeated(X.minimisers(chunks, n, 50, 16))
    assert largest(X.minimisers(chunks, n, 50, 16), n) < 2 * SHARD
    assert largest(X.candidate_runs(X.with_answers(chunks, flags), n, 50, 16), n) < 2 * SHARD


def test_words_of_the_language_model(rows):
    chunks = C.chunked(rows, "doc_id", "text", size=1 << 18)
    n = C.shards_for(chunks, 1 << 18, SHARD)
    assert largest(L.word_counts(chunks, n), n) < 2 * SHARD


def test_signatures_and_document_rows(rows, monkeypatch):
    monkeypatch.setattr(J, "SHARD_BYTES", SHARD)
    n = J._shards(rows, "text")
    sent = J.scan_documents(rows, "doc_id", "text", 4, 85, n)
    assert largest(sent.where(F.col("shard") < n), n) < 2 * SHARD
    per = sent.where(F.col("shard") >= n).groupBy("shard").count().agg(F.max("count")).first()[0]
    assert per <= 3000 // n + 8
