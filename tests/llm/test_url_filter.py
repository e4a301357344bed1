import math
import re
from collections import Counter

import pytest
from sf_dirs import SF_SMALL

from lodestone.llm import queries, url_filter as U

URLS = ["https://a.org/x", "http://example.org/es/1", "https://www.example.org/en/17", "https://example.org/en/2", "https://shop.com/fr/a?b#c",
        "https://shop.com/de/a", "https://shop.com/en/a", None, "", "no scheme here", "ftp://ORG/", "http://notorg/x", "http://a.org", "x://y.ORG/es/?q",
        "http://h.net/p://q", "https://é.com/FR/x", "https://shop.com/fr/", "http://a.org/\n/x"]


def rules_of(u):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", u or "")
    host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[2]), m[3]) if m else ("", "")
    fit = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path) + (max(fit)[1:] if fit else (None, None))


def test_rules_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r for r in U.judge(df, queries.URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = rules_of(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] in ("allow", "block") and (verdict is None or got[i]["verdict"] == verdict)
    assert all(got[i]["verdict"] == "allow" and got[i]["score"] == 0 for i in (7, 8)) and got[9]["score"] != 0


def seen(u):
    """What the models read of a URL."""
    m = re.match(r"(?s)(.*?)://([^/?#]*)(.*)", u or "")
    return re.sub("[A-Z]", lambda x: x.group().lower(), m[2]) + m[3] if m else u or ""


def test_models_read_the_whole_url(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: r["s"] for r in df.select("page_id", U.model_text(df.url).alias("s")).collect()}
    assert [got[i] for i in range(len(URLS))] == [seen(u) for u in URLS]


def brute_score(train, s, order):
    """Mean log-likelihood difference under interpolated Markov models."""
    count = {v: Counter() for v in (True, False)}
    for t, v in train:
        x = "\2" + t
        for i in range(1, len(x)):
            for n in range(order + 1):
                if i - n >= 0:
                    count[v][x[i - n:i + 1]] += 1
    tot, types = {}, {}
    for v in count:
        tot[v], types[v] = Counter(), Counter()
        for g, n in count[v].items():
            tot[v][g[:-1]] += n
            types[v][g[:-1]] += 1
    x, d = "\2" + s, 0.0
    for i in range(1, len(x)):
        p = {}
        for v in (True, False):
            q = 1 / 256
            for n in range(order + 1):
                if i - n < 0:
                    break
                g = x[i - n:i + 1]
                if tot[v][g[:-1]]:
                    q = (count[v][g] + types[v][g[:-1]] * q) / (tot[v][g[:-1]] + types[v][g[:-1]])
            p[v] = q
        d += math.log(p[True]) - math.log(p[False])
    return d / len(s)


def test_scores_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url")
    rows = df.collect()
    got = {r["page_id"]: r for r in U.judge(df, queries.URL_RULES).collect()}
    held = {r["page_id"]: r["h"] for r in df.withColumn("s", U.model_text(df.url)).selectExpr("page_id", "pmod(xxhash64(s), 5) = 0 as h").collect()}
    train = []
    for r in rows:
        host, path, _, v = rules_of(r["url"])
        if v and not held[r["page_id"]]:
            train.append((seen(r["url"]), v == "allow"))
    for r in rows[:20]:
        assert got[r["page_id"]]["score"] == pytest.approx(brute_score(train, seen(r["url"]), U.ORDER), abs=1e-9)


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    plan = U.judge(df, queries.URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_repeated_and_one_sided(spark):
    e = spark.createDataFrame([], "page_id long, url string, host string, rule string")
    assert U.judge(e, queries.URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "https://a.org/x", "h")] * 3 + [(2, "https://b.net/", "h")], "page_id long, url string, score string")
    got = U.judge(one, queries.URL_RULES).collect()
    assert len(got) == 4 and {r["verdict"] for r in got} == {"allow"}


def test_one_blocked_url_calibrates_too(spark):
    """The held-out fifth lacks a class: all examples calibrate instead."""
    rows = [f"https://site{i}.org/page/{i}" for i in range(40)] + ["https://example.org/es/1"] * 40 + ["https://other.net/es/1", "https://site7.net/page/7", "other.net/es/1"]
    got = {r["url"]: r for r in U.judge(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), queries.URL_RULES)
           .join(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), "page_id").collect()}
    assert got[rows[-3]]["p_accept"] < 0.5 < got[rows[-2]]["p_accept"] and got[rows[-3]]["verdict"] == got[rows[-1]]["verdict"] == "block"


def test_a_query_string_decides(spark):
    rows = [f"https://a{i}.org/p?id={i}" for i in range(60)] + [f"https://example.org/es/?casino=win&spin={i}" for i in range(60)]
    rows += ["https://new.net/p?casino=win&spin=3", "https://new.net/p?id=3"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r["page_id"]: r for r in U.judge(df, queries.URL_RULES).collect()}
    assert got[120]["score"] < got[121]["score"] and got[120]["verdict"] == "block"
