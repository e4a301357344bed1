"""Repeatable splits and stratified folds.

Row order comes from ``md5("<seed>:<key>")`` with the key as tie-break: the
same rows for the same seed whatever the partitioning, and the same order in
any engine that has ``md5``.  A null key sorts before all others and is kept.
Rows of one key are in the order of their other columns (nulls first), so only
rows that are equal in every column are told apart by chance, and then it
shows in no result.  Both operators are exact and skew-safe:

* the train/test split finds the k-th smallest ``(hash, key)`` with a few
  bounded histogram passes over the hash prefix, then splits with a plain
  filter (no shuffle of the rows).  Where the cut falls among the rows of one
  key, those rows alone are numbered over a range partitioning and cut by
  number;
* fold numbers need each row's rank inside its class.  Rows are bucketed by
  a hash prefix whose length grows with the largest class, bucket offsets
  come from a small count table, and ``row_number`` runs per (class, bucket),
  so no class, however large, lands in one task.  A key with so many rows that
  its bucket would be too large (null keys, say) makes all rows be numbered
  over a range partitioning instead, whose ranges end inside a key too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from lodestone.session import global_index, join_small, materialize

_LEVEL_HEX = 4          # hash hex digits resolved per histogram pass
_FINISH_ROWS = 200_000  # keys of a boundary bucket that are ranked directly
GROUP_ROWS = 1_000_000  # target rows per (class, bucket) window group


def seeded_hash(key: str, seed: int = 42) -> Column:
    """The seeded order of a key; empty, and so before all hashes, for null."""
    return F.coalesce(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.lit(""))


def _boundary(hist: DataFrame, k, *order: str) -> dict:
    """The row of a histogram (order columns, ``_n``) that holds the k-th row.
    ``k`` is a row number, or a float fraction of the total (ceil(f * n)).
    The running sum runs in Spark over the bounded histogram; one row comes
    back."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    h = (hist.withColumn("_cum", F.sum("_n").over(w))
         .withColumn("_total", F.sum("_n").over(Window.partitionBy())))
    kk = F.ceil(F.lit(k) * F.col("_total")).cast("long") if isinstance(k, float) else F.lit(int(k))
    h = h.withColumn("_k", F.least(F.greatest(kk, F.lit(0)), F.col("_total")))
    r = h.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_n") < F.col("_k"))).first()
    if r is None:  # k == 0 (or no rows)
        return {"k": 0}
    return {"k": r["_k"], "row": r, "n": r["_n"], "before": r["_cum"] - r["_n"]}


def _others(df: DataFrame, *taken: str) -> list[Column]:
    """The order among rows of one key: the other columns by name, nulls first (a
    map or another value without an order by its JSON)."""
    out = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        if f.name not in taken:
            c = F.col(f"`{f.name}`")
            plain = not any(x in f.dataType.simpleString() for x in ("map<", "variant", "interval"))
            out.append((c if plain else F.to_json(F.struct(c))).asc_nulls_first())
    return out


def _kth_smallest(hashed: DataFrame, key: str, k):
    """(k, hash, key, m) of the k-th smallest (hash, key) row (1-based): ``m`` of
    the rows of that key are among the k; None where all of them are."""
    scope = hashed.select("_h", key)
    remaining, k_total = k, None
    for level in range(32 // _LEVEL_HEX):
        p = F.substring(F.col("_h"), level * _LEVEL_HEX + 1, _LEVEL_HEX)
        b = _boundary(scope.groupBy(p.alias("_p")).agg(F.count(F.lit(1)).alias("_n")), remaining, "_p")
        if k_total is None:
            k_total = b["k"]
        if b["k"] == 0:
            return 0, None, None, None
        remaining = b["k"] - b["before"]
        scope = scope.where(p == F.lit(b["row"]["_p"]))
        if b["n"] <= _FINISH_ROWS or b["row"]["_p"] == "":
            break
    # one row per key: keys with many rows stay small here
    keys = scope.groupBy("_h", key).agg(F.count(F.lit(1)).alias("_n"))
    b = _boundary(keys, remaining, "_h", key)
    inside = remaining - b["before"]
    return k_total, b["row"]["_h"], b["row"][key], inside if inside < b["n"] else None


def split_threshold(df: DataFrame, key: str, test_size=0.2, seed: int = 42):
    """(n_test, hash, key, m) bound of the test part: rows with (hash, key) <=
    the bound are the test rows, of the bound's own key only ``m`` unless that
    is None.  ``test_size`` a fraction -> ceil(f * n) rows, an int -> that
    many.  Each pass reads only the key column."""
    hashed = df.select(F.col(key)).withColumn("_h", seeded_hash(key, seed))
    return _kth_smallest(hashed, key, float(test_size) if isinstance(test_size, float) else int(test_size))


def _in_test(key: str, seed: int, bound) -> Column:
    """Never null: every row is in exactly one part."""
    _, h, kv, _ = bound
    if h is None:
        return F.lit(False)
    hc = seeded_hash(key, seed)
    same = F.col(key).isNull() if kv is None else F.coalesce(F.col(key) <= F.lit(kv), F.lit(False))
    return (hc < F.lit(h)) | ((hc == F.lit(h)) & same)


def _cut_key(df: DataFrame, key: str, bound) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of the key in which the cut falls with
    ``_index`` from 0 in the order of their other columns)."""
    mine = F.col(key).eqNullSafe(F.lit(bound[2]))
    order = _others(df, key)
    # a last column that is different in every row lets a range end among equal rows
    ties = df.where(mine).withColumn("_tie", F.monotonically_increasing_id())
    return df.where(~mine), global_index(ties, *order, F.col("_tie")).drop("_tie")


def train_test_split(df: DataFrame, key: str, test_size=0.2, seed: int = 42):
    """Seeded split -> (train, test); test has ceil(test_size * n) rows, whether
    keys repeat or not."""
    bound = split_threshold(df, key, test_size, seed)
    t = _in_test(key, seed, bound)
    if bound[3] is None:
        return df.where(~t), df.where(t)
    rest, ties = _cut_key(df, key, bound)
    first = F.col("_index") < bound[3]
    return (rest.where(~t).unionByName(ties.where(~first).drop("_index")),
            rest.where(t).unionByName(ties.where(first).drop("_index")))


def with_split(df: DataFrame, key: str, test_size=0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """The split as a column (``train`` / ``test``) on every row."""
    bound = split_threshold(df, key, test_size, seed)
    part = lambda test: F.when(test, "test").otherwise("train")
    if bound[3] is None:
        return df.withColumn(out, part(_in_test(key, seed, bound)))
    rest, ties = _cut_key(df, key, bound)
    return (rest.withColumn(out, part(_in_test(key, seed, bound)))
            .unionByName(ties.withColumn(out, part(F.col("_index") < bound[3])).drop("_index")))


def exact_rank(df: DataFrame, key: str, seed: int = 42, by=(), out: str = "_rank",
               group_rows: int = GROUP_ROWS) -> DataFrame:
    """1-based rank of each row by (seeded hash, key, other columns) within its
    ``by`` group, computed without putting a whole group or a whole key into
    one task."""
    by = [by] if isinstance(by, str) else list(by)
    others = _others(df, key, *by)
    keyed = df.withColumn("_h", seeded_hash(key, seed))
    if by:
        largest = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    else:
        largest = keyed.count()
    digits = 0
    while digits < 8 and largest > group_rows * (16 ** digits):
        digits += 1
    if digits == 0:
        w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("_h", key, *others)
        return keyed.withColumn(out, F.row_number().over(w)).drop("_h")
    # the class columns travel as one struct key: struct equality treats
    # null fields as equal, and the join and the window then hash the same
    # (key, bucket) columns, so the rows are shuffled once even when the
    # offset table is too large to broadcast
    grp = [F.struct(*by).alias("_g")] if by else []
    keyed = keyed.select("*", *grp, F.substring("_h", 1, digits).alias("_b"))
    gcols = ["_g"] if by else []
    counts = keyed.groupBy(*gcols, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*gcols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*gcols, "_b", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_off"))
    offs = materialize(offs)  # counted, then joined: compute it once
    if (counts.agg(F.max("_n")).first()[0] or 0) > 2 * group_rows:
        return _rank_by_index(df, key, seed, by, others, out)
    joined = join_small(keyed, offs, [*gcols, "_b"], "inner")
    w = Window.partitionBy(*gcols, "_b").orderBy("_h", key, *others)
    return joined.withColumn(out, F.col("_off") + F.row_number().over(w)).drop("_h", "_b", "_off", *gcols)


def _rank_by_index(df: DataFrame, key: str, seed: int, by: list[str], others: list[Column], out: str) -> DataFrame:
    """``exact_rank`` where a key has very many rows: all rows are numbered in
    (group, hash, key, other columns) order over a range partitioning, and a
    group's first number is taken off."""
    group = F.struct(*by) if by else F.lit(0)
    keyed = df.withColumn("_g", group).withColumn("_h", seeded_hash(key, seed)).withColumn("_tie", F.monotonically_increasing_id())
    held = global_index(keyed, F.col("_g"), F.col("_h"), F.col(key), *others, F.col("_tie"))
    first = materialize(held.groupBy("_g").agg(F.min("_index").alias("_first")))
    return (join_small(held, first, "_g").withColumn(out, F.col("_index") - F.col("_first") + 1)
            .select(*[F.col(f"`{c}`") for c in df.columns], out))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 3, seed: int = 42,
                     out: str = "fold", group_rows: int = GROUP_ROWS) -> DataFrame:
    """Fold number 0..k-1: rows of each class dealt round-robin in seeded
    hash order, so per class the fold sizes differ by at most one."""
    ranked = exact_rank(df, key, seed, by=[label], out="_rank", group_rows=group_rows)
    return ranked.withColumn(out, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")
