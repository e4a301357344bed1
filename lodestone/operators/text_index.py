"""Substring search over stored texts by trigram posting lists.

``build`` stores the rows with a number each and an index: per segment of about
``SEGMENT_BYTES`` of text and per trigram of bytes the numbers of the rows that
hold it, ascending, as differences in a varying number of bytes.  A segment is
built by one task from the rows it scans, without a shuffle; posting lists are
then laid out by trigram, so a search reads the row groups of its own trigrams.

A search reads the lists of the term's trigrams, intersects them segment by
segment (a list is never longer than its segment), and tests the term itself
only on the rows that remain.  Substring equality of UTF-8 bytes is substring
equality of characters, so the answer is that of a scan.  Terms of fewer than
three bytes have no trigram and scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.predicates import search
from lodestone.session import join_small, materialize

SEGMENT_BYTES = 8 << 20
ROW = "_row"


def packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, seven bits a byte, low bits first, the
    high bit set on all bytes of a number but its last."""
    d = np.diff(numbers, prepend=0).astype(np.uint64)
    size = np.maximum(1, -(-(np.floor(np.log2(np.maximum(d, 1).astype(float))).astype(np.int64) + 1) // 7))
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        more = (size[own] > k + 1).astype(np.uint8) << 7
        out[(end - size)[own] + k] = (d[own] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    last = b < 128
    start = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1]) if len(b) else np.zeros(0, np.int64)
    place = np.arange(len(b)) - np.repeat(start, np.diff(np.append(start, len(b))))
    value = (b & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.cumsum(np.add.reduceat(value, start)).astype(np.int64) if len(b) else np.zeros(0, np.int64)


def trigrams(text: bytes) -> np.ndarray:
    """The distinct trigrams of a byte string as numbers."""
    b = np.frombuffer(text, np.uint8).astype(np.int32)
    return np.unique(b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else np.zeros(0, np.int32)


def _postings(first: int, texts: list[bytes]):
    """(trigram, rows) of a segment whose rows are numbered from ``first``."""
    found = [trigrams(t) for t in texts]
    row = np.repeat(np.arange(len(found)), [len(g) for g in found])
    gram = np.concatenate(found) if found else np.zeros(0, np.int32)
    order = np.argsort(gram, kind="stable")
    gram, row = gram[order], row[order]
    head = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
    return gram[head], [packed(r) for r in np.split(row, head[1:])] if len(head) else []


@dataclass(frozen=True)
class TextIndex:
    """Stored texts (with their row numbers) and posting lists."""
    spark: SparkSession
    texts: DataFrame
    lists: DataFrame
    text_col: str

    def rows_with(self, grams: list[int]) -> DataFrame:
        """(row) of the rows that hold all of some trigrams."""
        need = len(grams)

        def both(table: pa.Table) -> pa.Table:
            if len(table) < need:  # a trigram that no row of the segment holds
                return pa.table({ROW: pa.array([], pa.int64())})
            lists = sorted((unpacked(r.as_py()) for r in table["rows"]), key=len)
            rows = reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists)
            return pa.table({ROW: pa.array(rows + table["first"][0].as_py(), pa.int64())})
        own = self.lists.where(F.col("trigram").isin(grams)).select("segment", "first", "rows")
        return own.groupBy("segment").applyInArrow(both, f"{ROW} long")

    def candidates(self, terms: list[str]) -> DataFrame | None:
        """The stored rows that hold all trigrams of one of the terms; None where
        a term has none, so that every row is a candidate."""
        found = [sorted(trigrams(t.encode()).tolist()) for t in terms]
        if not all(found):
            return None
        rows = reduce(DataFrame.unionByName, [self.rows_with(g) for g in found]).distinct()
        return join_small(self.texts, materialize(rows), ROW, "left_semi")

    def containing(self, terms: list[str]) -> DataFrame:
        """The stored rows whose text holds one of the terms."""
        got = self.candidates(terms)
        hit = reduce(lambda a, b: a | b, [F.contains(F.col(f"`{self.text_col}`"), F.lit(t)) for t in terms])
        return (self.texts if got is None else got).where(hit).drop(ROW)

    def search(self, term: str, extension: str, path_col: str = "path") -> DataFrame:
        """``predicates.search`` over the candidates only."""
        got = self.candidates([term])
        return search(self.texts if got is None else got, term, extension, self.text_col, path_col).drop(ROW)

    def share_read(self, terms: list[str]) -> float:
        """The share of the texts that a search for the terms tests."""
        got, n = self.candidates(terms), self.texts.count()
        return 1.0 if got is None or not n else got.count() / n


def build(df: DataFrame, text_col: str, segment_bytes: int = SEGMENT_BYTES) -> TextIndex:
    """Store the rows and index a text column (null: empty)."""
    texts = materialize(df.withColumn(ROW, F.monotonically_increasing_id()))

    def run(batches):
        part, k, first, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def segment():
            gram, rows = _postings(first, held)
            return pa.RecordBatch.from_arrays(
                [pa.array(gram.astype(np.int32)), pa.array([part << 32 | k] * len(gram), pa.int64()),
                 pa.array([first] * len(gram), pa.int64()), pa.array(rows, pa.binary())], names=["trigram", "segment", "first", "rows"])
        for b in batches:
            for row, text in zip(b.column(0).to_pylist(), b.column(1)):
                raw = (text.as_py() or "").encode()
                # a segment's rows follow each other
                if held and (size + len(raw) > segment_bytes or row != first + len(held)):
                    yield segment()
                    k, first, held, size = k + 1, None, [], 0
                first = row if first is None else first
                held.append(raw)
                size += len(raw)
        if held:
            yield segment()
    lists = texts.select(ROW, F.col(f"`{text_col}`").cast("string")).mapInArrow(run, "trigram int, segment long, first long, rows binary")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = materialize(lists.repartitionByRange(parts, "trigram", "segment").sortWithinPartitions("trigram", "segment"))
    return TextIndex(df.sparkSession, texts, lists, text_col)
