"""URL filter: rules first, then a character language-model ratio.

Two variable-order Markov models over characters, one of accepted and one of
rejected URLs, are counted by Spark from the URLs that a rule decides.  A
character's probability interpolates all orders from 0 to ``order``
(Witten-Bell: the weight of a context is its count against the number of its
distinct successors), so rare contexts lean on shorter ones.  A URL's score is
the mean per character of the difference of the two log-likelihoods; a
logistic calibration (means and variance of the two classes on URLs left out
of the counts, or on all examples where those lack a class) turns it into a
probability.  The models read the whole URL behind the scheme: host, path, query
and fragment, and all of a URL without a scheme.

Everything is DataFrame functions: no Python runs on executors.  Statistics
cover all URLs.  The grams of the query side are looked up once per distinct
gram, not once per position; grams of one or two characters, which all others end
in, are a small table that is joined by a broadcast when its measured size
allows; and the per-gram scores reach the URLs by a salted join, so a gram that
all URLs share is no hot key.

Defined results: null or URLs without ``://`` have empty host and path and no
rule; a URL without characters, and every URL when the rules leave one class
without examples, scores 0 and is allowed; repeated rows are scored each; an
empty table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import narrow, stored
from lodestone.session import join_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 4
SALTS = 16
#: Grams up to this many characters are few, and met by nearly every other gram.
SHORT = 2


def fold_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z folded."""
    return fold_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def model_text(url: Column) -> Column:
    """What the models read: the host, folded, and all behind it as it stands; the
    URL itself where it has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), rest)).otherwise(url), F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; ``rules`` holds (verdict,
    host, path prefix).  A rule fits its host and all subdomains when the
    URL's path starts with the rule's path.  Rules are a short fixed list; one
    CASE in falling length, ties in the order given."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def grams(urls: DataFrame, order: int) -> DataFrame:
    """A row per character of ``s``: the other columns and ``g``, the
    character with up to ``order`` characters before it (a start mark first)."""
    s = F.concat(F.lit("\u0002"), F.col("s"))
    at = F.transform(F.sequence(F.lit(2), F.length(s)),
                     lambda i: F.substring(s, F.greatest(i - order, F.lit(1)),
                                           F.least(i, F.lit(order + 1))))
    keep = [c for c in urls.columns if c != "s"]
    return (urls.where(F.length("s") > 0)
            .select(*keep, F.explode(at).alias("g")))


def gram_counts(train: DataFrame, order: int) -> DataFrame:
    """Counts (a, r) in accepted and rejected URLs of every gram of every
    order: full grams are counted first, shorter ones are summed from them."""
    full = (grams(train, order).groupBy("g")
            .agg(F.sum(F.col("accept").cast("long")).alias("a"), F.sum((~F.col("accept")).cast("long")).alias("r")))
    parts = F.transform(F.sequence(F.lit(1), F.length("g")), lambda n: F.substring(F.col("g"), -n, n))
    return (full.select(F.explode(parts).alias("g"), "a", "r").groupBy("g")
            .agg(F.sum("a").alias("a"), F.sum("r").alias("r")))


def gram_scores(query: DataFrame, counts: DataFrame, order: int) -> DataFrame:
    """(g, d): log-likelihood difference of the last character of each distinct
    gram of ``query``, both models interpolated over all orders."""
    ctx = F.expr("substring(g, 1, length(g) - 1)")
    context = (counts.groupBy(ctx.alias("ctx"))
               .agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"),
                    F.sum((F.col("a") > 0).cast("long")).alias("ta"), F.sum((F.col("r") > 0).cast("long")).alias("tr")))
    suffix = F.transform(F.sequence(F.lit(1), F.length("g")), lambda n: F.substring(F.col("g"), -n, n))
    asked = query.select("g").distinct()
    long = asked.select(F.col("g").alias("q"), F.explode(suffix).alias("g"))
    # (what stands before a short gram's last character is shorter still)
    parts = []
    for few in (True, False):
        own = F.length("g") <= SHORT if few else F.length("g") > SHORT
        before = F.length("ctx") < SHORT if few else F.length("ctx") >= SHORT
        asks, has, ctxs = long.where(own), counts.where(own), context.where(before)
        got = join_small(asks, has, "g", "left") if few else asks.join(has, "g", "left")
        got = got.withColumn("ctx", ctx)
        parts.append(join_small(got, ctxs, "ctx", "left") if few else got.join(ctxs, "ctx", "left"))
    found = (parts[0].unionByName(parts[1])
             .select("q", F.length("g").alias("n"),
                     *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in ("a", "r", "ca", "cr", "ta", "tr")]))
    # from the shortest order up: p = (count + types * p_shorter) / (context + types)
    rows = found.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "a", "r", "ca", "cr", "ta", "tr"))).alias("o"))
    base = F.lit(1.0 / 256)

    def step(c, n, t):
        return lambda p, x: F.when(x[n] + x[t] > 0, (x[c] + x[t] * p) / (x[n] + x[t])).otherwise(p)
    return rows.select(F.col("q").alias("g"),
                       (F.log(F.aggregate("o", base, step("a", "ca", "ta")))
                        - F.log(F.aggregate("o", base, step("r", "cr", "tr")))).alias("d"))


def url_scores(urls: DataFrame, scores: DataFrame, order: int) -> DataFrame:
    """(uid, x): mean log-likelihood difference per character."""
    salted = (scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    per = (grams(urls.select("uid", "s"), order)
           .groupBy("uid", "g").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("salt", F.pmod(F.col("uid"), F.lit(SALTS)).cast("int")))
    return (per.join(salted, ["g", "salt"]).groupBy("uid")
            .agg((F.sum(F.col("d") * F.col("n")) / F.sum("n")).alias("x")))


def calibration(scored: DataFrame) -> tuple[float, float] | None:
    """Slope and offset of the logistic of two normal classes with a common
    variance and equal priors, from class means and variances (one row); None
    where a class has no row."""
    m = scored.agg(*[F.avg(F.when(F.col("accept") == v, F.col("x"))).alias(f"m{k}") for k, v in ((1, True), (0, False))],
                   *[F.var_pop(F.when(F.col("accept") == v, F.col("x"))).alias(f"v{k}") for k, v in ((1, True), (0, False))]
                   ).first()
    if m["m1"] is None or m["m0"] is None:
        return None
    var = max((m["v1"] + m["v0"]) / 2, 1e-6)
    slope = (m["m1"] - m["m0"]) / var
    return slope, -slope * (m["m1"] + m["m0"]) / 2


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", key: str = "page_id",
          order: int = ORDER, hold_out: int = 5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, p_accept) per input row.
    URLs that a rule decides are the examples; one in ``hold_out`` of them (by
    hash) is kept from the counts and calibrates."""
    u = F.col("url")
    base = narrow(pages, uid=F.monotonically_increasing_id(), page_id=key, url=url)
    base = base.withColumn("host", host_of(u)).withColumn("path", path_of(u))
    rule, by_rule = rule_columns(F.col("host"), F.col("path"), rules)
    base = stored(base.withColumn("rule", rule).withColumn("by_rule", by_rule)
                  .withColumn("s", model_text(u))
                  .withColumn("held", F.pmod(F.xxhash64("s"), F.lit(hold_out)) == 0), "urls")
    known = base.where("by_rule is not null").withColumn("accept", F.col("by_rule") == "allow")
    counts = stored(gram_counts(known.where("not held").select("accept", "s"), order), "counts")
    scores = stored(gram_scores(grams(base.select("s"), order), counts, order), "scores")
    x = stored(url_scores(base, scores, order), "x")
    examples = known.join(x, "uid")
    ab = calibration(examples.where("held")) or calibration(examples) or (0.0, 0.0)
    a, b = ab if math.isfinite(sum(ab)) else (0.0, 0.0)
    p = 1 / (1 + F.exp(-(F.lit(a) * F.col("score") + F.lit(b))))
    return (base.join(x, "uid", "left").withColumn("score", F.coalesce("x", F.lit(0.0)))
            .withColumn("p_accept", F.when(F.length("s") == 0, F.lit(0.5)).otherwise(p))
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(F.col("p_accept") >= 0.5, "allow").otherwise("block")).alias("verdict"),
                    "score", "p_accept"))
