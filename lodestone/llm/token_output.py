"""Token ids of a corpus as an entropy-coded, randomly decodable file set.

``write_tokens`` puts the documents in ascending id order (a range shuffle),
tokenises each partition and stores *runs* of at most ``RUN`` ids; the exact
counts of all ids give one shared frequency table; every run then becomes one
independent block (``rans.py``).  The file set is a folder with

* ``table``: symbol, freq, bits (one row per symbol of the vocabulary),
* ``blocks``: start (ids before it), doc_ids and n_tokens of the documents in
  it, doc_start of the first one, whether first and last document go on in a
  neighbouring block, and the block's bytes.

Both are Parquet, so any store Spark writes to will do and a lost task is
simply run again.  Blocks are decoded in parallel; a document longer than a
run spans blocks, and its checksum is joined from those of its parts.

Byte-level BPE never merges across the start of white space that follows
another character, so a text is cut there into units and each distinct unit
is encoded once per worker; the result equals encoding the whole text.  An
added token that stands literally in a text (``<|endoftext|>``) is its own id
with ``added``, as the library has it, and the ids of its characters without.

Defined results: null text is empty (its only id is the end id); null ids come
first; repeated ids are ordered by their text; an empty table gives empty
files; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import rans
from lodestone.llm.arrays import SPACE, Remembered, ragged, text_buffer, text_parts, worker_cache
from lodestone.llm.common import narrow, stored

RUN = 1 << 18
#: Text that is tokenised at a time.
PART_BYTES = 6 << 20
#: Distinct units a worker remembers (about 40 bytes each).
REMEMBERED = 1_500_000


#: 1 for an ASCII letter, 2 for ASCII punctuation.
_KIND = np.array([1 if b < 128 and chr(b).isalpha() else 2 if 32 < b < 127 and not chr(b).isalnum() else 0 for b in range(256)], np.uint8)


class UnitEncoder:
    """Token ids of whole batches, each distinct unit encoded once."""

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added
        tokens = self.tok.get_added_tokens_decoder().values() if added else ()
        if any(t.lstrip or t.rstrip or t.single_word for t in tokens):
            raise ValueError("an added token that depends on what is around it")
        names = sorted((t.content.encode() for t in tokens), key=len, reverse=True)
        self.literal = re.compile(b"|".join(map(re.escape, names))) if names else None
        vocab = self.tok.get_vocab()
        self.width = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for t, i in vocab.items():
            self.width[i] = len(t)  # byte-level: one character per byte
        self.held = Remembered(np.uint32, REMEMBERED)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of units, most of them encoded joined to long strings."""
        ends = starts + lens - 1
        # joined units must neither continue a unit before them nor be continued
        joinable = SPACE[buf[starts]] & ~SPACE[buf[ends]] & (buf[ends] < 0x80)
        order = np.concatenate([np.flatnonzero(joinable), np.flatnonzero(~joinable)])
        s, w, n = starts[order], lens[order], int(joinable.sum())
        sizes, ids = [], []
        for a in range(0, n, 20000):
            b = min(a + 20000, n)
            (got,) = self._encode([buf[ragged(s[a:b], w[a:b])].tobytes().decode()])
            cut = np.searchsorted(np.cumsum(self.width[got]), np.cumsum(w[a:b])) + 1
            sizes.append(np.diff(cut, prepend=0))
            ids.append(got)
        rest = self._encode([buf[i:i + k].tobytes().decode() for i, k in zip(s[n:].tolist(), w[n:].tolist())])
        sizes.append(np.array([len(r) for r in rest], dtype=np.int64))
        by_order = np.concatenate(sizes).astype(np.int64)
        flat = np.concatenate([*ids, *rest]) if ids or rest else np.zeros(0, np.uint32)
        size, at = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        size[order], at[order] = by_order, np.cumsum(by_order) - by_order
        return size, flat[ragged(at, size)]

    def batch(self, buf: np.ndarray, offs: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids per text), each
        text closed by ``end_id``."""
        n = len(offs) - 1
        starts = self._apart(buf, offs, self._units(buf, offs))
        lens = np.diff(starts, append=len(buf))
        step = 100_000
        at = self.held.resolve(buf, starts, lens, lambda i: self._learn(buf, starts[i], lens[i]))
        size, begin, flat = self.held.size[at], self.held.at[at], np.append(self.held.flat, np.uint32(end_id))
        doc = np.searchsorted(offs, starts, side="right") - 1
        per_doc = np.bincount(doc, weights=size, minlength=n).astype(np.int64) + 1
        # the end id of each text stands behind its last unit
        close = np.searchsorted(doc, np.arange(n), side="right")
        size = np.insert(size, close, 1)
        begin = np.insert(begin, close, len(flat) - 1)
        out = [flat[ragged(begin[a:a + step], size[a:a + step])] for a in range(0, len(size), step)]
        return np.concatenate(out) if out else np.zeros(0, np.uint32), per_doc

    def _apart(self, buf: np.ndarray, offs: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The starts with every literal added token a unit of its own."""
        raw = buf.tobytes() if self.literal else b""
        if not raw or not self.literal.search(raw):
            return starts
        spans = np.array([m.span() for a, z in zip(offs[:-1].tolist(), offs[1:].tolist()) for m in self.literal.finditer(raw, a, z)],
                         dtype=np.int64).reshape(-1, 2)
        inside = np.searchsorted(spans[:, 0], starts, side="left") > np.searchsorted(spans[:, 1], starts, side="right")
        ends = spans[:, 1]
        return np.unique(np.concatenate([starts[~inside], spans[:, 0], ends[ends < len(buf)]]))

    @staticmethod
    def _units(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Where units start: at texts, at white space after other characters
        and at ASCII punctuation after an ASCII letter (a token never reaches
        across either)."""
        if not len(buf):
            return np.zeros(0, np.int64)
        blank = SPACE[buf]
        cut = blank.copy()
        cut[0] = False
        cut[1:] &= ~blank[:-1]
        c = np.flatnonzero(cut)
        wide = c[buf[c - 1] >= 0x80]
        if len(wide):  # white space of more than one byte before: no cut
            z, y, x = buf[wide - 1], buf[np.maximum(wide - 2, 0)], buf[np.maximum(wide - 3, 0)]
            odd = ((y == 0xC2) & ((z == 0x85) | (z == 0xA0)) | (x == 0xE1) & (y == 0x9A) & (z == 0x80)
                   | (x == 0xE2) & (y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))
                   | (x == 0xE2) & (y == 0x81) & (z == 0x9F) | (x == 0xE3) & (y == 0x80) & (z == 0x80))
            cut[wide[odd]] = False
        kind = _KIND[buf]
        cut[1:] |= (kind[:-1] == 1) & (kind[1:] == 2)
        cut[offs[:-1][np.diff(offs) > 0]] = True
        return np.flatnonzero(cut)


def _encoder(path: str, added: bool) -> UnitEncoder:
    held = worker_cache()
    if ("units", path, added) not in held:
        held["units", path, added] = UnitEncoder(path, added)
    return held["units", path, added]


_RUNS = ("part int, at long, doc_ids array<long>, n_tokens array<long>, doc_start long, "
         "goes_on boolean, went_on boolean, ids binary")


def token_runs(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
               run: int = RUN, added: bool = False) -> DataFrame:
    """Runs of ids in ascending document order; ``at`` and ``doc_start`` count
    from the start of the partition ``part``."""
    src = narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    # the row number lets a range end among rows of one id and text
    src = src.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ordered = (src.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
               .select(F.spark_partition_id().alias("part"), "doc_id", "text"))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = _encoder(tokenizer, added), 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            part = b.column(0)[0].as_py()
            for i0, i1, texts in text_parts(b.column(2), PART_BYTES):
                ids, sizes = enc.batch(*text_buffer(texts), end_id)
                names = b.column(1).slice(i0, i1 - i0).to_pylist()
                ends = np.cumsum(sizes)
                rows = []
                for a in range(0, len(ids), run):
                    z = min(a + run, len(ids))
                    i, j = int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(ends, z))
                    lows = np.maximum(ends[i:j + 1] - sizes[i:j + 1], a)
                    rows.append((part, at + a, names[i:j + 1], (np.minimum(ends[i:j + 1], z) - lows).tolist(),
                                 at + int(ends[i] - sizes[i]), bool(ends[j] > z), bool(ends[i] - sizes[i] < a),
                                 ids[a:z].astype("<u4").tobytes()))
                at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                        (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()))],
                    names=["part", "at", "doc_ids", "n_tokens", "doc_start", "goes_on", "went_on", "ids"])
    return ordered.mapInArrow(tokenise, _RUNS)


def symbol_counts(runs: DataFrame) -> DataFrame:
    """(symbol, n) over all runs, summed per task before the shuffle."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for r in b.column(0):
                c = np.bincount(np.frombuffer(r.as_buffer(), "<u4"))
                if len(c) > len(total):
                    total = np.pad(total, (0, len(c) - len(total)))
                total[:len(c)] += c
        s = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(total[s])], names=["symbol", "n"])
    return runs.select("ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id",
                 text: str = "text", run: int = RUN, added: bool = False) -> None:
    """Write the file set below ``path``."""
    spark = docs.sparkSession
    runs = stored(token_runs(docs, tokenizer, end_id, doc_id, text, run, added), "runs")
    counted = symbol_counts(runs).collect()  # at most one row per entry of the vocabulary
    table = rans.quantise(np.array([r["symbol"] for r in counted], dtype=np.int64),
                          np.array([r["n"] for r in counted], dtype=np.int64))
    spark.createDataFrame([(int(s), int(f), table.bits) for s, f in zip(table.symbols, table.freq)],
                          "symbol long, freq long, bits int").coalesce(1).write.parquet(f"{path}/table")
    sizes = runs.groupBy("part").agg(F.max(F.col("at") + F.length("ids") / 4).cast("long").alias("n"))
    before, total = [], 0
    for r in sizes.orderBy("part").collect():  # a row per partition
        before.append((r["part"], total))
        total += r["n"]
    offset = spark.createDataFrame(before, "part int, before long")
    shared = spark.sparkContext.broadcast((table.symbols, table.freq, table.bits))

    def blocks(batches):
        t = rans.Table(*shared.value)
        for b in batches:
            made = [rans.encode(np.frombuffer(x.as_buffer(), "<u4"), t) for x in b.column("ids")]
            k = b.schema.get_field_index("ids")
            yield b.set_column(k, "block", pa.array(made, pa.binary()))
    placed = runs.join(F.broadcast(offset), "part").select(
        (F.col("before") + F.col("at")).alias("start"), (F.col("before") + F.col("doc_start")).alias("doc_start"),
        "doc_ids", "n_tokens", "went_on", "goes_on", "ids")
    placed.mapInArrow(blocks, "start long, doc_start long, doc_ids array<long>, n_tokens array<long>, "
                              "went_on boolean, goes_on boolean, block binary").write.parquet(f"{path}/blocks")


def read_table_of(spark: SparkSession, path: str) -> rans.Table:
    rows = spark.read.parquet(f"{path}/table").orderBy("symbol").collect()  # at most the vocabulary
    bits = rows[0]["bits"] if rows else 12
    return rans.Table(np.array([r["symbol"] for r in rows], dtype=np.int64),
                      np.array([r["freq"] for r in rows], dtype=np.int64), bits)


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document's part in every block, decoded: doc_id, doc_start, at,
    n, crc, whole and, when asked for, the ids."""
    table = read_table_of(spark, path)
    shared = spark.sparkContext.broadcast((table.symbols, table.freq, table.bits))  # at most the vocabulary

    def run(batches):
        t = rans.Table(*shared.value)
        for b in batches:
            for i in range(b.num_rows):
                r = {k: b.column(k)[i].as_py() for k in ("start", "doc_start", "doc_ids", "n_tokens", "went_on", "goes_on")}
                ids = rans.decode(b.column("block")[i].as_py(), t).astype("<u4")
                size = np.array(r["n_tokens"], dtype=np.int64)
                low = np.cumsum(size) - size
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * s:4 * (s + n)]) for s, n in zip(low.tolist(), size.tolist())]
                m = len(size)
                whole = np.ones(m, bool)
                whole[0] &= not r["went_on"]
                whole[-1] &= not r["goes_on"]
                first = low + r["start"]
                own = first.copy()
                own[0] = r["doc_start"]
                cols = [pa.array(r["doc_ids"], pa.int64()), pa.array(own), pa.array(first), pa.array(size),
                        pa.array(np.array(crc, dtype=np.int64)), pa.array(whole)]
                names = ["doc_id", "doc_start", "at", "n", "crc", "whole"]
                if with_ids:
                    cols.append(pa.array([ids[s:s + n].astype(np.int64) for s, n in zip(low, size)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    out = "doc_id long, doc_start long, at long, n long, crc long, whole boolean" + ", ids array<long>" * with_ids
    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, out)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files."""
    pieces = stored(read_pieces(spark, path), "pieces")  # a row of numbers per document and block
    lone = pieces.where("whole").select("doc_id", F.col("doc_start").alias("start"), F.col("n").alias("n_tokens"),
                                        F.col("crc").alias("ids_crc32"))
    # documents over several blocks: one row of a few numbers per block
    parts = (pieces.where("not whole").groupBy("doc_start")
             .agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
                  F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("parts")))

    def join(batches):
        for b in batches:
            crc = []
            for ps in b.column("parts").to_pylist():
                c = 0
                for p in ps:
                    c = rans.crc32_combine(c, p["crc"], 4 * p["n"])
                crc.append(c)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc_start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return lone.unionByName(parts.mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long"))
