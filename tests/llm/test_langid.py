from sf_dirs import SF_MID
from fixtures_llm import awkward, empty
from pyspark.sql import functions as F

from lodestone.llm import langid, queries


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op2_language_id"](spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")).alias("a"), F.count("*").alias("n"),
                                  F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert r["n"] > 200 and r["a"] > 0.95 and 0 <= r["low"] <= r["high"] <= 1


def test_awkward_rows(spark):
    df = awkward(spark)
    model = langid.learn(df, F.lit(True))
    assert [n for n, _ in model] and {n for n, _ in model} == {"en", "fr"}
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    for d in (2, 3, 4, 11):
        assert got[d]["lang_pred"] == "und" and got[d]["score"] == 0 and not got[d]["accepted"]
    assert all(got[d]["lang_pred"] in ("en", "fr") for d in (1, 5, 6, 7, 8, 9, 10, 12, 13))


def test_without_languages_and_empty(spark):
    df = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    model = langid.learn(df, F.lit(True))
    assert model == [] and {r["lang_pred"] for r in langid.predict(df, model).collect()} == {"und"}
    assert langid.predict(empty(spark), langid.learn(empty(spark), F.lit(True))).count() == 0


def test_dictionary_is_bounded(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2000).alias("text"), F.lit("en").alias("lang"))
    ((_, d),) = langid.learn(df, F.lit(True))
    assert 0 < len(d) <= langid.DICT_BYTES


def test_letters_are_of_category_l(spark):
    rows = [(0, "the quick brown fox", "en"), (1, "² ½ ①", None), (2, "Ⅷ ⅷ", None), (3, "\u0301\u0308 \u093f", None), (4, "x²", None), (5, "ª", None), (6, "Ⓐ ⒜", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.predict(df, langid.learn(df, F.lit(True))).collect()}
    assert [got[i]["lang_pred"] for i in range(7)] == ["en", "und", "und", "und", "en", "en", "und"]
    assert all(got[i]["score"] == 0 for i in (1, 2, 3, 6))


def test_a_head_without_letters_does_not_empty_the_dictionary(spark):
    rows = [(i, "0123456789 " * 500 + " ".join(f"word{chr(97 + (i + k) % 26)}{chr(97 + k % 26)}" for k in range(1400)), "en") for i in range(20)]
    ((_, d),) = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert len(d) > 50_000 and set(d.decode()) <= set("abcdefghijklmnopqrstuvwxyz ")


def test_stretches_reach_from_head_to_tail():
    t = b"".join(b"%06d " % i for i in range(20_000))
    s = langid.stretches(t, 2000)
    assert len(s) <= 2000 and s.startswith(b"000000 ") and s.endswith(b"019999 ") and b"01000" in s
    assert langid.stretches(b"abc", 2000) == b"abc"


def test_against_plain_compression(spark):
    import zstandard
    df = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id % 9 = 0").select("doc_id", "text", "lang")
    df = df.unionByName(awkward(spark, clashing=False).selectExpr("doc_id + 100000 as doc_id", "text", "lang"))
    model = langid.learn(df, F.lit(True))
    texts = {r["doc_id"]: r["text"] for r in df.where("doc_id is not null and doc_id <> 100008").collect()}
    for r in langid.predict(df, model).where("doc_id is not null and doc_id <> 100008").collect():
        t = langid.letters(texts[r["doc_id"]] or "").encode()
        sizes = []
        for _, d in model:
            p = zstandard.ZstdCompressionParameters.from_level(langid.LEVEL, dict_size=len(d), source_size=langid.BLOCK,
                                                               write_content_size=False, write_checksum=False, write_dict_id=False)
            z = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=p)
            sizes.append(sum(len(z.compress(t[i:i + langid.BLOCK])) for i in range(0, len(t), langid.BLOCK)))
        assert r["lang_pred"] == (model[sizes.index(min(sizes))][0] if t else "und")
