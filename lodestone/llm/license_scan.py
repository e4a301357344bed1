"""Licence scan by diagonal voting.

Templates are short word sequences with a label.  Texts and templates are cut
into rolling word ``GRAM``-grams; a join on the gram's hash (and, to exclude
collisions, the gram itself) gives for every shared gram its place in the text
and in the template.  Their difference is the diagonal: a passage copied word
for word puts all its grams on one.  Votes are counted per diagonal; diagonals
at most ``GAP`` apart (a few words put in or left out) are merged to a span,
and a span is verified by

* a diagonal that alone holds ``COVER`` of the template's grams, or
* distinct grams of ``COVER`` of the template within ``SLACK`` times its length.

``base`` templates are exact phrases: a place is a diagonal that holds every
gram of the phrase, so all its words stand there consecutively.

Everything is DataFrame functions.  The texts are scanned once and never
shuffled; the join is a broadcast while the templates' measured size allows,
and hits are a few numbers per shared gram.  One row per document rides along
with the hits, so documents without a hit need no second scan, and the hits of
a document meet in one shuffle by a row number (the hits are written first, so
a lost task cannot renumber them).  A document's hits are bounded by its own length.

Defined results: null, empty and very short texts have their words counted, no
places, null first and last word, empty labels and score 0; phrases of fewer
than ``GRAM`` words are an error; a phrase given twice counts once per label;
repeated rows and null ids are judged each; empty tables give an empty result;
other columns are ignored whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import fold_ascii, narrow, stored
from lodestone.session import join_small

GRAM = 3
GAP = 4
COVER = 0.8
SLACK = 1.25
#: Keys over which the one row per document is spread in the join.
SPREAD = 1024
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Notices and names of public licences, words in lower case.
NOTICES = [
    ("agpl-3", "gnu affero general public license version 3"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("boost-1", "boost software license version 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
    ("epl-2", "eclipse public license v 2 0"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def words_of(text: Column) -> Column:
    """The words of a text, A-Z folded (null: none)."""
    return F.regexp_extract_all(fold_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def templates(base: list[tuple[str, str]], notices: list[tuple[str, str]]) -> list[tuple[int, str, bool, list[str]]]:
    """(number, label, base, words) of the distinct templates."""
    out = []
    for exact, phrases in ((True, base), (False, notices)):
        for label, phrase in sorted(set(phrases)):
            words = phrase.split()
            if len(words) < GRAM:
                raise ValueError(f"a template needs {GRAM} words or more: {phrase!r}")
            out.append((len(out), label, exact, words))
    return out


def template_grams(spark: SparkSession, held: list[tuple[int, str, bool, list[str]]]) -> DataFrame:
    """(hash, gram, tpl, tpos, grams, label, base): a row per place of a template."""
    rows = json.dumps([{"tpl": t, "label": label, "base": exact, "w": w} for t, label, exact, w in held])
    df = spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<tpl int, label string, base boolean, w array<string>>>")))
    df = df.select("tpl", "label", "base", "w", (F.size("w") - GRAM + 1).alias("grams"),
                   F.explode(F.sequence(F.lit(0), F.size("w") - GRAM)).alias("tpos"))
    df = df.select("tpl", "tpos", "grams", "label", "base", F.concat_ws(" ", F.slice("w", F.col("tpos") + 1, GRAM)).alias("tgram"))
    marks = spark.range(SPREAD).select(F.lit(-1).alias("tpl"), F.lit(0).alias("tpos"), F.lit(1).alias("grams"), F.lit(None).cast("string").alias("label"),
                                       F.lit(False).alias("base"), _mark(F.col("id")).alias("tgram"))
    return df.unionByName(marks).withColumn("hash", F.xxhash64("tgram"))


def _mark(k: Column) -> Column:
    """No gram starts with a blank."""
    return F.concat_ws(" ", F.lit(""), k.cast("string"))


def hits(docs: DataFrame, held: list[tuple[int, str, bool, list[str]]], doc_id: str, text: str) -> DataFrame:
    """(uid, doc_id, n_words, tpl, tpos, pos, grams, label, base): every gram that a
    text shares with a template, and one row with ``tpl`` -1 per document."""
    rows = narrow(docs, uid=F.monotonically_increasing_id(), doc_id=F.col(f"`{doc_id}`").cast("long"),
                  w=words_of(F.col(f"`{text}`").cast("string")))
    rows = rows.select("uid", "doc_id", "w", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("w") - GRAM, F.lit(-1)))).alias("pos"))
    gram = F.concat_ws(" ", *[F.get("w", F.col("pos") + k) for k in range(GRAM)])
    mark = _mark(F.pmod("uid", F.lit(SPREAD)))
    rows = rows.select("uid", "doc_id", F.size("w").cast("long").alias("n_words"), F.col("pos").cast("long").alias("pos"),
                       F.when(F.col("pos") < 0, mark).otherwise(gram).alias("gram"))
    rows = rows.withColumn("hash", F.xxhash64("gram"))
    # the hash finds, the words decide
    found = join_small(rows, template_grams(docs.sparkSession, held), "hash").where(F.col("gram") == F.col("tgram"))
    return found.select("uid", "doc_id", "n_words", "tpl", "tpos", "pos", "grams", "label", "base")


def scan(docs: DataFrame, base: list[tuple[str, str]], notices: list[tuple[str, str]] = NOTICES, doc_id: str = "doc_id",
         text: str = "text", cover: float = COVER, gap: int = GAP, slack: float = SLACK) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) per row; ``score`` is the largest share of a template's grams in one span."""
    found = stored(hits(docs, templates(base, notices), doc_id, text), "hits").repartition("uid")
    found = found.withColumn("diag", F.col("pos") - F.col("tpos"))
    line = Window.partitionBy("uid", "tpl").orderBy("diag")
    apart = F.coalesce(F.col("diag") - F.lag("diag").over(line) > gap, F.lit(False))
    found = (found.withColumn("votes", F.count(F.lit(1)).over(Window.partitionBy("uid", "tpl", "diag")))
             .withColumn("apart", apart.cast("int"))
             .withColumn("span", F.sum("apart").over(line.rowsBetween(Window.unboundedPreceding, 0))))
    place = F.when(F.col("base") & (F.col("votes") == F.col("grams")) & (F.col("tpos") == 0), F.col("diag"))
    same = ["uid", "tpl", "span"]
    each = found.groupBy(*same, "tpos").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("label").alias("label"), F.max("grams").alias("grams"),
        F.max("votes").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"),
        F.count(place).alias("places"), F.min(place).alias("first"), F.max(place).alias("last"))
    span = each.groupBy(*same).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("label").alias("label"), F.max("grams").alias("grams"),
        F.max("votes").alias("votes"), F.count(F.lit(1)).alias("covered"), (F.max("hi") - F.min("lo") + GRAM).alias("length"),
        F.sum("places").alias("places"), F.min("first").alias("first"), F.max("last").alias("last"))
    real, enough = F.col("tpl") >= 0, F.col("grams") * cover
    compact = F.col("length") <= (F.col("grams") + GRAM - 1) * slack
    verified = real & ((F.col("votes") >= enough) | ((F.col("covered") >= enough) & compact))
    names = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    exact = F.col("places") > 0
    return (span.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("places").alias("n_base"),
        F.min("first").alias("first_word"), F.max("last").alias("last_word"), names(exact).alias("base_labels"),
        names(exact | verified).alias("labels"),
        F.coalesce(F.max(F.when(real, F.col("covered") / F.col("grams"))), F.lit(0.0)).alias("score")).drop("uid"))
