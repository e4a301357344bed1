"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after lower-casing A-Z; the row with
the largest id of a group stays.  Misra-Gries summaries, one per partition and
merged by Spark, find the frequent digests in bounded memory.  Their winners
are verified by an exact partial aggregate, and as there are at most
``counters`` of them they are broadcast: rows of a frequent digest are decided
where they are scanned and never meet in one task.  All other digests are
grouped by an ordinary shuffle of (digest, id) pairs; texts are not shuffled.

Defined results: null text counts as empty; a null id is smaller than any
other id; of rows with equal text and equal id exactly one stays; an empty
table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import fold_ascii, narrow, stored
from lodestone.session import join_small

COUNTERS = 1024


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(uid, doc_id, digest) per row: a row number, the id and the SHA-256 of
    the normalised text."""
    src = narrow(docs, uid=F.monotonically_increasing_id(), doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    return src.select("uid", "doc_id", F.unhex(sha_of(F.col("text"))).alias("digest"))


def misra_gries(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Candidates for the frequent values of a binary column: at most
    ``counters`` rows (key, estimate).  Every key with more than
    ``rows / (counters + 1)`` rows is in some partition's summary."""
    (name,) = keys.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for b in batches:
            vc = b.column(0).drop_null().value_counts()
            for k, n in zip(vc.field(0).to_pylist(), vc.field(1).to_pylist()):
                held[k] = held.get(k, 0) + n
            held = _shrink(held, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                         names=["key", "estimate"])
    return (keys.mapInArrow(run, "key binary, estimate long").groupBy("key").agg(F.sum("estimate").alias("estimate"))
            .orderBy(F.desc("estimate"), "key").limit(counters))


def _shrink(held: dict, counters: int) -> dict:
    """Misra-Gries reduction: lower every counter by the (counters + 1)-th
    largest and drop those that reach zero."""
    if len(held) <= counters:
        return held
    cut = int(np.partition(np.fromiter(held.values(), np.int64, len(held)), len(held) - counters - 1)[len(held) - counters - 1])
    return {k: n - cut for k, n in held.items() if n > cut}


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    frequent (decided map-side)."""
    rows = stored(digests(docs, doc_id, text), "digests")
    summary = (F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "uid")).alias("win"))
    candidates = misra_gries(rows.select("digest"), counters)
    winners = stored(rows.join(F.broadcast(candidates.select(F.col("key").alias("digest"))), "digest")
                     .groupBy("digest").agg(*summary), "winners")
    few = F.broadcast(winners)  # at most ``counters`` rows
    frequent = rows.join(few, "digest").withColumn("frequent", F.lit(True))
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    plain = (rest.join(rest.groupBy("digest").agg(*summary), "digest")
             .withColumn("frequent", F.lit(False)))
    return frequent.unionByName(plain).select(
        "doc_id", F.col("win.doc_id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("win.uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "frequent")


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    counters: int = COUNTERS) -> DataFrame:
    """The input rows that stay, with all their columns.  The list of ids that
    go meets the texts where they are scanned when its bytes allow, else by one
    shuffle; of fully repeated rows one is taken."""
    decided = stored(exact_duplicates(docs, doc_id, text, counters).select("doc_id", "kept", "text_sha256"), "decided")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*cols).alias("r"), F.col(f"`{doc_id}`").cast("long").alias("i"))
    repeated = stored(decided.groupBy(F.col("doc_id").alias("t")).agg(F.count(F.lit(1)).alias("c"))
                      .where("c > 1").select("t"), "repeated")
    gone = decided.where("not kept").select(F.col("doc_id").alias("k")).distinct()
    if repeated.isEmpty():  # the usual case: an id names a row
        return join_small(whole, gone, F.col("i").eqNullSafe(F.col("k")), "left_anti").select("r.*")
    once = F.col("i").eqNullSafe(F.col("t"))
    lone = (join_small(join_small(whole, repeated, once, "left_anti"), gone, F.col("i").eqNullSafe(F.col("k")), "left_anti"))
    stays = decided.where("kept").select(F.col("doc_id").alias("k"), F.col("text_sha256").alias("h"))
    again = (join_small(whole, repeated, once, "left_semi").withColumn("s", sha_of(F.col("r").getField(text)))
             .join(stays, F.col("i").eqNullSafe(F.col("k")) & (F.col("s") == F.col("h")))
             .groupBy("i", "h").agg(F.first("r").alias("r")))
    return lone.select("r").unionByName(again.select("r")).select("r.*")


def sha_of(text):
    """Hex SHA-256 of a text column after lower-casing A-Z (null: empty)."""
    return F.sha2(fold_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)
