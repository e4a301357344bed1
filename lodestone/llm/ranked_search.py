"""Ranked lexical search with bag deduplication.

For every query item the documents with the highest scores, a sum over the
item's terms of integer weights (the rarer a term, the more) times a saturating
function of its count, with a length norm ``m``.

A document matters to the ranking only by the counts of the terms that some
item holds, its *bag*, and by ``m``.  So each text is read once and reduced to
its bag.  Documents with the same bag and ``m`` are one class: the digest of
both deals them to the shuffle, and equality of the bytes themselves decides.
Each class is scored once against all items, and the members of the few
classes that reach a top are written out in ascending ``doc_id``.  Of a class
at most ``k`` members can appear, so a class with a third of all rows costs
what its ``k`` smallest ids cost (the row limit runs before the shuffle).

Scoring multiplies a block of classes (terms as columns) with a block of items
in numpy.  All numbers are integers; a product sums at most ``SLICE`` terms of
less than 2^36, so doubles hold it exactly, and slices are added as 64-bit
integers.  Every task keeps ``k`` classes per item, a window takes the best.

Items are cut into blocks of ``ITEM_BYTES`` of distinct terms by running size;
the documents are read once per block, so a larger benchmark means more passes
and never a larger broadcast.  Statistics (documents, lengths, document
frequencies) cover all documents.

Defined results: null, empty and blank texts have no term, are not counted and
rank nowhere; an item without terms has no rows; item rows with one id are one
item with the terms of all of them (null ids too); documents with a null id
count, and rank after all others of equal score; repeated rows are documents of
their own; empty tables give an empty result; other columns are ignored
whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.arrays import ragged, text_buffer
from lodestone.llm.common import batches_of, narrow, running_blocks, stored
from lodestone.session import join_small

K = 10
B = 90
K1 = 8
ITEM_BYTES = 1 << 20
SLICE = 1 << 15
PIECE = 4 << 20
LAST = (1 << 63) - 1

#: Bytes that are no part of a term become blanks, A-Z become a-z.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def pieces_of(raw: bytes):
    """The terms of a text as lists, about ``PIECE`` bytes of text at a time."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE) if len(folded) - at > PIECE else -1
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def raw_texts(col):
    """The bytes of each text of an Arrow column (null: empty)."""
    buf, offs = text_buffer(col)
    whole = memoryview(buf)
    for s, e in zip(offs[:-1].tolist(), offs[1:].tolist()):
        yield bytes(whole[s:e])


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, term) without repeats."""
    def run(batches):
        for b in batches:
            ids, terms = [], []
            for i, raw in zip(b.column(0).to_pylist(), raw_texts(b.column(1))):
                own = sorted({t for part in pieces_of(raw) for t in part})
                ids += [i] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])
    rows = narrow(items, item_id=F.col(f"`{item_id}`").cast("long"), text=text)
    return rows.mapInArrow(run, "item_id long, term binary").distinct()


def bags(docs: DataFrame, terms: list[bytes], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, bag) of documents with a term: the number of all its terms
    and, ascending by number in ``terms``, (term, count) as 32-bit pairs."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        at = {t: i for i, t in enumerate(shared.value)}
        for b in batches:
            total, packed = [], []
            for raw in raw_texts(b.column(1)):
                n, held = 0, Counter()
                for part in pieces_of(raw):
                    n += len(part)
                    for t, c in Counter(part).items():
                        if t in at:
                            held[at[t]] += c
                total.append(n)
                packed.append(np.array(sorted(held.items()), "<i4").tobytes())
            some = pa.array(np.array(total, np.int64) > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["doc_id", "n", "bag"]).filter(some)
    rows = narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    return rows.mapInArrow(run, "doc_id long, n long, bag binary")


def unpacked(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the bags of a column."""
    buf, offs = text_buffer(col)
    pairs = np.ascontiguousarray(buf).view("<i4").reshape(-1, 2)
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs) // 8), pairs[:, 0], pairs[:, 1].astype(np.int64)


def statistics(held: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, documents per item term."""
    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for b in batches:
            df += np.bincount(unpacked(b.column(0))[1], minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])
    both = held.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(n_terms, np.int64)
    for r in held.select("bag").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]  # at most a row per term of the block
    return both["docs"], both["terms"], df


def weights(docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Scorer:
    """The items of a block: terms of each, and the best classes so far."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, n_items: int, n_terms: int, weight: np.ndarray, k: int, k1: int,
                 cells: int = 1 << 20):
        self.weight, self.n_terms, self.k, self.k1, self.cells = weight, n_terms, k, k1, cells
        self.n_items = n_items
        self.top = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, first, class
        self.least = np.ones(n_items, np.int64)
        by = np.argsort(owner, kind="stable")
        first = np.searchsorted(owner[by], np.arange(n_items + 1))
        self.groups, i = [], 0
        while i < n_items:  # items side by side while their matrix stays small
            j = i + 1
            while j < n_items and (j + 1 - i) * int(first[j + 1] - first[i]) <= cells:
                j += 1
            own = by[first[i]:first[j]]
            words, at = np.unique(term[own], return_inverse=True)
            self.groups.append((i, j, words, at, owner[own] - i))
            i = j

    def add(self, row, term, tf, m, first, cls) -> None:
        """Score classes: pairs (row, term, count), per row norm, first id, number."""
        worth = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + self.k1 * m[row]))
        local = np.full(self.n_terms, -1, np.int32)
        for i, j, words, at, who in self.groups:
            local[words] = np.arange(len(words))
            inside = local[term] >= 0
            r, t, c = row[inside], local[term[inside]], worth[inside]
            local[words] = -1
            step = max(1, self.cells // max(min(len(words), SLICE), 1))
            for a in range(0, len(m), step):
                z = min(a + step, len(m))
                p, q = np.searchsorted(r, [a, z])
                self._keep(i, self._product(r[p:q] - a, t[p:q], c[p:q], z - a, len(words), at, who, j - i), first[a:z], cls[a:z])

    def _product(self, r, t, c, rows, words, at, who, items) -> np.ndarray:
        total = np.zeros((rows, items), np.int64)
        for lo in range(0, words, SLICE):
            hi = min(lo + SLICE, words)
            left = np.zeros((rows, hi - lo))
            here = (t >= lo) & (t < hi)
            left[r[here], t[here] - lo] = c[here]
            right = np.zeros((hi - lo, items))
            mine = (at >= lo) & (at < hi)
            right[at[mine] - lo, who[mine]] = 1
            total += (left @ right).astype(np.int64)
        return total

    def _keep(self, i, scores, first, cls) -> None:
        r, c = np.nonzero(scores >= self.least[i:i + scores.shape[1]])
        if not len(r):
            return
        held = [np.concatenate(x) for x in zip(self.top, (c + i, scores[r, c], first[r], cls[r]))]
        order = np.lexsort((held[3], held[2], -held[1], held[0]))
        held = [x[order] for x in held]
        begin = np.searchsorted(held[0], np.arange(self.n_items + 1))
        size = np.minimum(np.diff(begin), self.k)
        keep = ragged(begin[:-1], size)
        self.top = [x[keep] for x in held]
        full = np.flatnonzero(size == self.k)  # an equal score may still win by its smaller id
        self.least[full] = self.top[1][np.cumsum(size)[full] - 1]


def best_classes(classes: DataFrame, owner, term, n_items: int, weight: np.ndarray, k: int, k1: int) -> DataFrame:
    """(item, score, first, cls): the ``k`` best classes of each item."""
    shared = classes.sparkSession.sparkContext.broadcast((owner, term, weight))

    def run(batches):
        own, words, w = shared.value
        scorer = Scorer(own, words, n_items, len(w), w, k, k1)
        for b in batches:
            row, t, tf = unpacked(b.column(0))
            scorer.add(row, t, tf, *[b.column(c).to_numpy() for c in (1, 2, 3)])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in scorer.top], names=["item", "score", "first", "cls"])
    each = classes.select("bag", "m", "first", "cls").mapInArrow(run, "item long, score long, first long, cls long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "first", "cls"))
    return each.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def _search_block(docs: DataFrame, block: DataFrame, doc_id: str, text: str, k: int, b: int, k1: int) -> DataFrame:
    spark = docs.sparkSession
    pairs = block.select("item_id", F.explode("terms").alias("term")).collect()  # at most ITEM_BYTES and an item
    ids = sorted({r["item_id"] for r in pairs}, key=lambda i: (i is None, i))
    terms = sorted({bytes(r["term"]) for r in pairs})
    number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(ids)}
    owner = np.array([place[r["item_id"]] for r in pairs], np.int64)
    term = np.array([number[bytes(r["term"])] for r in pairs], np.int64)
    with batches_of(spark):
        held = stored(bags(docs, terms, doc_id, text), "bags")
    n_docs, n_all, df = statistics(held, len(terms))
    norm = F.expr(f"{100 - b}L + ({b}L * n * {n_docs}L) div {max(n_all, 1)}L")
    held = held.where(F.length("bag") > 0).select("doc_id", "bag", norm.alias("m")).withColumn("digest", F.xxhash64("bag", "m"))
    # rows of a digest are one class only if bag and norm themselves are equal
    classes = stored(held.groupBy("digest", "bag", "m").agg(F.coalesce(F.min("doc_id"), F.lit(LAST)).alias("first"))
                     .withColumn("cls", F.monotonically_increasing_id()), "classes")
    best = stored(best_classes(classes, owner, term, len(ids), weights(n_docs, df), k, k1), "best")
    needed = stored(join_small(classes, best.select("cls").distinct(), "cls"), "needed")
    members = join_small(held, needed.select("digest", "bag", "m", "cls"), ["digest", "bag", "m"]).select("cls", "doc_id")
    order = F.col("doc_id").asc_nulls_last()
    members = stored(members.withColumn("r", F.row_number().over(Window.partitionBy("cls").orderBy(order)))
                     .where(F.col("r") <= k).drop("r"), "members")
    names = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "item long, item_id long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), order)).cast("int")
    return (best.join(members, "cls").withColumn("rank", rank).where(F.col("rank") <= k)
            .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = K, b: int = B, k1: int = K1, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): per item the ``k`` documents with the
    highest scores above 0, equal scores by ascending id."""
    own = item_terms(items, item_id, item_text).groupBy("item_id").agg(F.collect_list("term").alias("terms"))
    own = own.withColumn("size", F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.length(t) + 8))
    own = running_blocks(own, "size", item_bytes, F.col("item_id"))
    blocks = [r["block"] for r in own.select("block").distinct().orderBy("block").collect()]
    found = [_search_block(docs, own.where(F.col("block") == n), doc_id, text, k, b, k1) for n in blocks]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
