"""Anti join against a large log with a Bloom filter in front.

The filter is an aggregate: every key sets a few bits, bits are OR-ed per
64-bit word first in each partition and then over the shuffle, and the words
become one array that the scan of the other side probes in generated code.  A
key without all its bits is certainly not in the log and passes where it is
scanned; only the others, true members and a small share of false alarms, are
shuffled to the exact anti join.  The result is that of ``unseen``.

The array is at most ``FILTER_BYTES`` long.  A log with more keys than that
holds at ``fp`` is cut by key hash into slices, each with a filter of its own
that only the rows of its slice ask; beyond ``SLICES`` of them the plain anti
join is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.selection import unseen

FILTER_BYTES = 4 << 20
SLICES = 8
FP = 0.01


def filter_size(n: int, fp: float = FP) -> tuple[int, int]:
    """(bits, bits per key) of a filter for ``n`` keys: a power of two, so that
    a place is the low bits of a hash."""
    want = max(64, math.ceil(n * -math.log(fp) / math.log(2) ** 2))
    bits = 1 << (want - 1).bit_length()
    return bits, max(1, min(12, round(bits / max(n, 1) * math.log(2))))


def _places(key: Column, bits: int, per_key: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(per_key)]


def bloom_filter(keys: DataFrame, key: str, bits: int, per_key: int) -> DataFrame:
    """One row, one column ``words``: the filter of a column as an array."""
    place = keys.select(F.explode(F.array(*_places(F.col(key).cast("string"), bits, per_key))).alias("p"))
    words = place.groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"))
    dense = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return dense.agg(F.transform(ordered, lambda x: x["bits"]).alias("words"))


def may_hold(words: Column, key: Column, per_key: int, bits: int) -> Column:
    """Whether all bits of a key are set."""
    out = F.lit(True)
    for p in _places(key.cast("string"), bits, per_key):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
        out = out & (bit == 1)
    return out


def split_by_filter(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None, fp: float = FP,
                    filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, DataFrame] | None:
    """(certainly new, perhaps seen) rows of ``df``; None where the log is too
    large for ``SLICES`` filters."""
    s = seen.select(F.col(seen_key or key).alias(key))
    n = s.count()
    slices = max(1, -(-filter_size(n, fp)[0] // (8 * filter_bytes)))
    if slices > SLICES:
        return None
    bits, per_key = filter_size(-(-n // slices), fp)
    slice_of = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(-1)), F.lit(slices))
    maybe = F.lit(False)
    for i in range(slices):
        words = bloom_filter(s.where(slice_of == i) if slices > 1 else s, key, bits, per_key).scalar()
        maybe = F.when(slice_of == i, may_hold(words, F.col(key), per_key, bits)).otherwise(maybe) if slices > 1 else \
            may_hold(words, F.col(key), per_key, bits)
    maybe = F.coalesce(maybe, F.lit(True))
    return df.where(~maybe), df.where(maybe)


def unseen_filtered(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None, fp: float = FP,
                    filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Rows whose key is not in ``seen``: as ``selection.unseen``, with a filter
    in front.  Null keys are never seen."""
    parts = split_by_filter(df, seen, key, seen_key, fp, filter_bytes)
    if parts is None:
        return unseen(df, seen, key, seen_key)
    new, maybe = parts
    return new.unionByName(unseen(maybe, seen, key, seen_key))
