import numpy as np
from sf_dirs import SF_MID
from fixtures_llm import awkward, empty
from pyspark.sql import functions as F

from lodestone.llm import quality, queries


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op5_quality"](spark, SF_MID)
    lab = spark.read.parquet(f"{SF_MID}/labels.parquet")
    r = {(x["quality"], x["predicted"]): x["n"] for x in got.where("held_out").join(lab, "doc_id")
         .groupBy("quality", "predicted").agg(F.count("*").alias("n")).collect()}
    right, total = r.get((0, 0), 0) + r.get((1, 1), 0), sum(r.values())
    assert total > 50 and right / total > 0.93
    low, high, n = got.agg(F.min("score"), F.max("score"), F.count("*")).first()
    assert 0 <= low <= high <= 1 and n == 1000
    assert got.where("predicted <> cast(score >= 0.3 as int)").count() == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_awkward_rows_and_empty(spark):
    df = awkward(spark)
    lab = labels(spark, [(1, 1), (6, 1), (7, 1), (10, 1), (13, 0), (11, 0), (2, 1), (None, 1), (99, 0), (3, None), (8, 5)])
    model = quality.learn(df, lab, F.lit(True))
    got = quality.score(df, model).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    same = [r["score"] for r in got if r["doc_id"] in (7, 8)]
    assert max(same) - min(same) < 1e-12  # repeated rows
    out = quality.keep_good(df, model)
    assert out.columns == df.columns
    assert out.count() == sum(r["predicted"] for r in got)
    assert quality.score(empty(spark), model).count() == 0


def test_without_labels(spark):
    df = awkward(spark)
    none = quality.learn(df, labels(spark, []), F.lit(True))
    assert {round(r["score"], 9) for r in quality.score(df, none).collect()} == {0.5}
    one = quality.learn(df, labels(spark, [(1, 1), (7, 1)]), F.lit(True))
    assert all(r["predicted"] == 1 for r in quality.score(df, one).collect())


def test_fit_is_repeatable():
    rng = np.random.default_rng(0)
    ex = [(np.array([0, 5 + y, 9]), np.array([.5, .3, .2], np.float32), y) for y in rng.integers(0, 2, 40).tolist()]
    a, b = quality.train(ex, {0: 20, 1: 20}), quality.train(ex, {0: 20, 1: 20})
    assert (a.weight == b.weight).all() and a.weight[6] > a.weight[5]


def test_sample_is_bounded_and_learns_only_from_the_given_rows(spark):
    lab = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    picks, totals = quality.sample_labels(lab, F.col("doc_id") >= 100, size=30)
    assert len(picks) == 60 and all(d >= 100 for d, _ in picks) and totals == {0: 200, 1: 200}


M64 = (1 << 64) - 1


def mixed(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & M64
    return x ^ x >> 31


def word_hash(w, seed=11):
    """The hash of one word, eight bytes at a time."""
    salt = (seed * 0xA24BAED4963EE407 + 0x9FB21C651E98DF25) & M64
    h = 0
    for k in range(max(1, -(-len(w) // 8))):
        block = int.from_bytes(w[8 * k:8 * k + 8], "little")
        h += mixed((block + (k * 0xD1342543DE82EF95 & M64) + salt) & M64)
    return mixed((h + len(w) * 0xD6E8FEB86659FD93) & M64)


def plain_features(text):
    """The buckets of a text, one feature after another."""
    import re
    out = [0] * quality.COMMON
    words = [word_hash(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", text.encode())]
    out += [w >> 48 for w in words]
    for a, b in zip(words, words[1:]):
        h = 0
        for w in (a, b):
            h = (((h ^ h >> 32) * 0x9E3779B97F4A7C15) + w) & M64
        out += [mixed(h) >> 48] + [quality.REPEAT] * (a == b)
    value = []
    for c in text:
        raw = c.encode()
        v = raw[0]
        for x in raw[1:]:
            v = (v * 257 + x) & 0xFFFFFFFF
        value.append(32 if c in " \t\n\v\f\r" else v)
    for n in quality.CHAR_GRAMS:
        for i in range(len(value) - n + 1):
            if 32 in value[i + 1:i + n - 1]:
                continue
            h = n
            for v in value[i:i + n]:
                h = (h * 0x9E3779B1 + v) & 0xFFFFFFFF
            h ^= h >> 15
            out.append((h * 0x85EBCA77 & 0xFFFFFFFF) >> 16)
    return out


def test_scores_against_a_plain_feature_loop(spark):
    from fixtures_llm import awkward_rows
    rng = np.random.default_rng(3)
    weight, offset = rng.normal(size=quality.BUCKETS), 0.3
    texts = [t for _, t in awkward_rows()] + ["one one two  two two", "é é日 x", "a b\tc", "abcdefgh", "abcdefghi" * 3]
    import pyarrow as pa
    got = quality.batch_scores(weight, offset, pa.array(texts))
    for t, p in zip(texts, got):
        k = plain_features(t or "")
        want = 1 / (1 + np.exp(-(sum(weight[x] for x in k) / len(k) + offset)))
        assert abs(p - want) < 1e-9, t
