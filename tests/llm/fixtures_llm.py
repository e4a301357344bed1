"""Small awkward tables shared by the tests of this folder."""
import random

from pyspark.sql import functions as F

CLASHING = ["uid", "digest", "cls", "shard", "blob", "n", "k", "task", "label", "side", "comp", "part", "g", "s", "h", "i", "r", "t",
            "held", "kept", "win", "gone", "ids", "counts", "chunk", "a.b", "with space", "text_sha256", "score", "rule", "x", "y"]


def awkward_rows():
    """(doc_id, text) with nulls, empty, blank, one-letter, long and repeated texts."""
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]
    long = " ".join(rnd.choice(words) + str(rnd.randrange(400)) for _ in range(15000))
    body = " ".join(rnd.choice(words) + str(rnd.randrange(50)) for _ in range(40))
    return [(1, "The quick brown fox jumps over the lazy dog near the river bank today"), (2, None), (3, ""), (4, "  \n\t "),
            (5, "x"), (6, long), (7, body), (8, body), (8, body), (9, body.upper()), (10, body + " tail"), (None, body),
            (None, None), (11, "123 456 ... !!"), (12, "日本語 テキスト é ▁ \U0001F600 <|endoftext|>"), (13, "a" * 3000)]


def awkward(spark, clashing=True):
    df = spark.createDataFrame([(d, t, None if d in (2, 7) else ("en" if (d or 0) % 2 else "fr"), None if d == 1 else "src", len(t or ""))
                                for d, t in awkward_rows()], "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        for c in CLASHING:
            df = df.withColumn(c, F.lit(c))
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
