import re

import pytest
from fixtures_llm import awkward, empty
from sf_dirs import SF_MID

from lodestone.llm import license_scan as L
from lodestone.llm.common import read_table
from lodestone.llm.queries import LICENSE_PHRASES

WORD = re.compile(L.WORD)


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(text, base=LICENSE_PHRASES, notices=L.NOTICES):
    """The row of one text by direct comparison of word runs, span by span."""
    w = words(text)
    starts, exact, labels, score = [], set(), set(), 0.0
    for own, phrases in ((True, base), (False, notices)):
        for label, phrase in set(phrases):
            p = phrase.split()
            if own:
                at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
                starts += at
                exact |= {label} if at else set()
            grams = len(p) - 2
            hit = sorted((i - j, j, i) for j in range(grams) for i in range(len(w) - 2) if w[i:i + 3] == p[j:j + 3])
            span = []
            for k, h in enumerate(hit):
                span.append(h)
                if k + 1 == len(hit) or hit[k + 1][0] - h[0] > L.GAP:
                    covered = len({j for _, j, _ in span})
                    votes = max(sum(x[0] == d for x in span) for d, _, _ in span)
                    length = max(i for *_, i in span) - min(i for *_, i in span) + 3
                    score = max(score, covered / grams)
                    if votes >= 0.8 * grams or (covered >= 0.8 * grams and length <= 1.25 * len(p)):
                        labels.add(label)
                    span = []
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(exact)),
            ",".join(sorted(labels | exact)), pytest.approx(score))


NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
       "(the \"Software\"), to deal in the Software without restriction")
TEXTS = ["Released under the MIT License.", "under the  MIT\nlicense Under-the-mit-license!", "x under the mit licence", "CC BY-NC 4.0, cc_by_nc; cc by nc",
         "Licensed under the Apache License, Version 2.0.", "apache license version 20", "This work is licensed under the GNU General Public License, version 3.",
         "GNU General Public License version 2", "GNU General Public License, some version 3", MIT, MIT.replace("free of charge,", "entirely free of any charge,"),
         "the mit Kicense under the mit İ", "é under the mit license É CC BY NC", "cc by nc " * 400, "under the mit", "cc by", None, "", "\x00cc\x7fby\x00nc"]


def check(got, texts):
    assert [tuple(r[n] for n in NAMES) for r in got] == [brute(t) for t in texts]


def test_phrases_and_notices_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, w string, pos int").repartition(3)
    got = sorted(L.scan(df, LICENSE_PHRASES).collect(), key=lambda r: r["doc_id"])
    check(got, TEXTS)
    assert "mit" in got[10]["labels"] and got[10]["n_base"] == 0  # words put in: found by merged diagonals
    assert got[3]["n_base"] == 3 and got[13]["n_base"] == 400


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = L.scan(df, LICENSE_PHRASES).collect()
    want = sorted([str((d, *[x if k < 6 else 0.0 for k, x in enumerate(brute(t))])) for d, t in rows])
    assert sorted(str((r["doc_id"], *[r[n] for n in NAMES])) for r in got) == want


def test_given_table_against_brute_force(spark):
    rows = read_table(spark, SF_MID, "documents").where("doc_id % 4 = 1")
    got = sorted(L.scan(rows, LICENSE_PHRASES).collect(), key=lambda r: r["doc_id"])
    check(got, [r["text"] for r in rows.orderBy("doc_id").collect()])
    assert any("gpl-3" in r["labels"] for r in got)


def test_large_template_tables_are_joined_by_a_shuffle(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    spark.conf.set("lodestone.broadcast.maxBytes", "1")
    try:
        got = sorted(L.scan(df, LICENSE_PHRASES).collect(), key=lambda r: r["doc_id"])
    finally:
        spark.conf.unset("lodestone.broadcast.maxBytes")
    check(got, TEXTS)


def test_no_python_in_the_plan(spark):
    df = read_table(spark, SF_MID, "documents")
    held = L.hits(df, L.templates(LICENSE_PHRASES, L.NOTICES), "doc_id", "text")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and not re.search("Python|Arrow|Pandas", L.scan(df, LICENSE_PHRASES)._jdf.queryExecution().toString())


def test_empty_tables_and_short_phrases(spark):
    assert L.scan(empty(spark), LICENSE_PHRASES).count() == 0
    with pytest.raises(ValueError):
        L.templates([("mit", "the mit")], [])
