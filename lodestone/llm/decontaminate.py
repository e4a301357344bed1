"""Benchmark decontamination with SimHash over item-sized windows.

Words are runs of letters, marks and digits of any script (lower case); shingles
are five words.
For each benchmark item, every window of a document that is as long as the item
and shares a shingle with it gets a 64-bit SimHash of its weighted shingles
(weight: how often the shingle occurs).  A multi-index finds the items near a
fingerprint: the 64 bits are cut into ``RADIUS + 1`` blocks, and two
fingerprints within the radius agree in at least one block, so looking up every
block loses none.  Candidates within the radius are verified by the exact
weighted Jaccard similarity of the shingles, ``SIMILARITY`` or more.

(A window without a common shingle has similarity 0, so leaving those out is
exact.  At similarity 0.8 fingerprints differ in about 10 bits with a standard
deviation of 3; the radius of 18 leaves less than one in five hundred outside
exactly at the threshold, and none in practice above it.)

The index is broadcast: distinct item texts are cut into blocks by running size,
less than ``BLOCK_BYTES`` and one text each, and the documents are scanned once
per block, so a large benchmark means more scans and never a larger broadcast.
Ids are joined to the texts found at the end.

Defined results: null and empty texts match nothing; an item of fewer than five
words is one shingle of all its words; items with one text are searched once
and reported each, repeated documents too; a null item id is kept; empty tables
give an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import NOT_ALNUM, Words, gram_hash, ragged, text_buffer, text_parts
from lodestone.llm.common import filtered, narrow, running_blocks
from lodestone.session import join_small

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 18
BLOCK_BYTES = 16 << 20


def _words(col) -> Words:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if text_buffer(col)[0].max(initial=0) > 127:  # quotes, dashes and blanks beyond ASCII
        col = pc.replace_substring_regex(col.cast(pa.large_string()), r"[^\pL\pM\pN]+", " ")
    return Words(*text_buffer(pc.utf8_lower(col.cast(pa.large_string()))), apart=NOT_ALNUM, seed=3)


def fingerprints(grams: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` consecutive shingles (as 64 booleans)."""
    bits = np.unpackbits(np.ascontiguousarray(grams).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return total[size:] - total[:-size] > 0


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    u, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(at[:len(a)], minlength=len(u))
    y = np.bincount(at[len(a):], minlength=len(u))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class Index:
    """Items by shingle, and by fingerprint block per window length."""

    def __init__(self, words: list[np.ndarray], shingle: int = SHINGLE, radius: int = RADIUS):
        self.radius, self.length = radius, np.array([len(w) for w in words], dtype=np.int64)
        self.k = np.minimum(self.length, shingle)
        self.grams = [gram_hash(w, int(k)) if k else np.zeros(0, np.uint64) for w, k in zip(words, self.k)]
        self.print = [fingerprints(g, len(g))[0] if len(g) else np.zeros(64, bool) for g in self.grams]
        cuts = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = list(zip(cuts[:-1], cuts[1:]))
        self.by_block: dict[tuple, list[int]] = {}
        self.shared: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i, (n, p) in enumerate(zip(self.length, self.print)):
            for b, (lo, hi) in enumerate(self.blocks):
                if n:
                    self.by_block.setdefault((int(n), b, p[lo:hi].tobytes()), []).append(i)
        for k in sorted(set(self.k.tolist()) - {0}):
            own = [i for i in range(len(words)) if self.k[i] == k]
            h = np.concatenate([self.grams[i] for i in own])
            who = np.repeat(own, [len(self.grams[i]) for i in own])
            order = np.argsort(h, kind="stable")
            self.shared[k] = h[order], who[order]

    def near(self, n: int, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, item, distance) of all items of ``n`` words within the radius."""
        found: dict[tuple[int, int], int] = {}
        for b, (lo, hi) in enumerate(self.blocks):
            part = np.ascontiguousarray(prints[:, lo:hi])
            for w in range(len(prints)):
                for i in self.by_block.get((n, b, part[w].tobytes()), ()):
                    if (w, i) not in found:
                        found[w, i] = int((prints[w] != self.print[i]).sum())
        return [(w, i, d) for (w, i), d in found.items() if d <= self.radius]

    def search_texts(self, col, least: float) -> dict[tuple[int, int], tuple[float, int, int]]:
        """``search`` over a text column, part by part."""
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        for a, _, part in text_parts(col):
            out.update({(a + d, i): v for (d, i), v in self.search(_words(part), least).items()})
        return out

    def search(self, words: Words, least: float) -> dict[tuple[int, int], tuple[float, int, int]]:
        """(document, item) -> (similarity, distance, first word) of the best window."""
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        doc = words.docs()
        for k, (keys, who) in self.shared.items():
            g = gram_hash(words.hash, k)
            if not len(g):
                continue
            at = np.searchsorted(keys, g)
            at[at == len(keys)] = 0
            hit = np.flatnonzero((keys[at] == g) & (doc[:len(g)] == doc[k - 1:]))
            low = np.searchsorted(keys, g[hit])
            n = np.searchsorted(keys, g[hit], side="right") - low
            p, i = np.repeat(hit, n), who[ragged(low, n)]
            order = np.lexsort((p, i, doc[p]))
            p, i = p[order], i[order]
            d = doc[p]
            for places in np.split(np.arange(len(p)), np.flatnonzero((d[1:] != d[:-1]) | (i[1:] != i[:-1])) + 1):
                if len(places):
                    self._windows(words, g, k, int(d[places[0]]), int(i[places[0]]), p[places], least, out)
        return out

    def _windows(self, words, g, k, d, i, places, least, out) -> None:
        lo, hi, n = int(words.first[d]), int(words.first[d + 1]), int(self.length[i])
        size = min(n, hi - lo) - k + 1  # shingles of a window
        p = np.unique(places)
        starts = np.unique((p[:, None] - np.arange(size)[None, :]).ravel())
        starts = starts[(starts >= lo) & (starts + size + k - 1 <= hi)]
        # neighbouring windows share their sums: fingerprint stretch by stretch
        for part in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            if not len(part):
                continue
            s = int(part[0])
            prints = fingerprints(g[s:int(part[-1]) + size], size)
            for w, j, dist in self.near(n, prints):
                sim = similarity(g[s + w:s + w + size], self.grams[j])
                if sim >= least:
                    best = (sim, -dist, -(s + w - lo))
                    have = out.get((d, j))
                    if have is None or best > (have[0], -have[1], -have[2]):
                        out[d, j] = (sim, dist, s + w - lo)


def _items(items: DataFrame, item_id: str, text: str, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(texts, names): the distinct texts that hold anything, numbered (``row``) and
    in blocks by running size, and (row, item_id) of every item."""
    rows = narrow(items, item_id=F.col(f"`{item_id}`").cast("long"), text=text).where(F.length("text") > 0)
    texts = rows.select("text").distinct().withColumn("size", F.octet_length("text").cast("long"))
    texts = running_blocks(texts, "size", block_bytes, F.col("text"))
    return texts, rows.join(texts.select("text", "row"), "text").select("row", "item_id")


def _searchers(docs: DataFrame, texts: DataFrame):
    """A broadcast (numbers, word hashes) per block that holds a text."""
    for n in [r["block"] for r in texts.select("block").distinct().orderBy("block").collect()]:
        block = texts.where(F.col("block") == n).orderBy("row").select("row", "text").collect()
        w = _words(pa.array([r["text"] for r in block], pa.string()))
        words = [w.hash[w.first[i]:w.first[i + 1]] for i in range(len(block))]
        yield docs.sparkSession.sparkContext.broadcast(([r["row"] for r in block], words))


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text", least: float = SIMILARITY,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, similarity, distance, start_word, n_words): per
    document and item that it holds, the most similar window."""
    out = []
    texts, names = _items(items, item_id, item_text, block_bytes)
    for shared in _searchers(docs, texts):
        def run(batches, shared=shared):
            ids, words = shared.value
            index = Index(words)
            for b in batches:
                found = index.search_texts(b.column(1), least)
                keys = sorted(found)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array([d for d, _ in keys], pa.int64())),
                    pa.array([ids[i] for _, i in keys], pa.int64()),
                    pa.array([found[k][0] for k in keys], pa.float64()), pa.array([found[k][1] for k in keys], pa.int64()),
                    pa.array([found[k][2] for k in keys], pa.int64()),
                    pa.array([int(index.length[i]) for _, i in keys], pa.int64())],
                    names=["doc_id", "row", "similarity", "distance", "start_word", "n_words"])
        out.append(narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text).mapInArrow(
            run, "doc_id long, row long, similarity double, distance long, start_word long, n_words long"))
    if not out:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, distance long, start_word long, n_words long")
    return (join_small(reduce(DataFrame.unionByName, out), names, "row")
            .select("doc_id", "item_id", "similarity", "distance", "start_word", "n_words"))


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", least: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no item, all columns as they are."""
    at = docs.columns.index(text)
    for shared in _searchers(docs, _items(items, item_id, item_text, block_bytes)[0]):
        held: dict = {}  # the index, built once per task

        def clean(b, shared=shared, held=held):
            if "index" not in held:
                held["index"] = Index(shared.value[1])
            mask = np.ones(b.num_rows, bool)
            mask[[d for d, _ in held["index"].search_texts(b.column(at), least)]] = False
            return mask
        docs = filtered(docs, clean)
    return docs
