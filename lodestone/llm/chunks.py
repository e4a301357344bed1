"""Texts packed into chunk rows, for operators that meet the same text more
than once and exchange arrays with hash shards in between."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import text_buffer
from lodestone.llm.common import narrow, stored

CHUNK_BYTES = 8 << 20
SCHEMA = "chunk long, doc_ids array<long>, flags array<boolean>, offs binary, body binary"


def chunked(docs: DataFrame, doc_id: str, text: str, flag: Column | None = None,
            size: int = CHUNK_BYTES) -> DataFrame:
    """A stored table with a row per chunk of about ``size`` bytes: whole
    texts (null: empty), compressed, their ids and a flag each.  No shuffle;
    chunk numbers are fixed once written."""
    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            i, n = 0, b.num_rows
            while i < n:
                j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + size, side="right")) - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | k], pa.int64()),
                     pa.array([b.column(0).slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                     pa.array([b.column(2).slice(i, j - i).to_pylist()], pa.list_(pa.bool_())),
                     pa.array([(offs[i:j + 1] - offs[i]).astype("<i8").tobytes()], pa.binary()),
                     pa.array([press.compress(buf[offs[i]:offs[j]].tobytes())], pa.binary())],
                    names=["chunk", "doc_ids", "flags", "offs", "body"])
                i, k = j, k + 1
    flag = F.lit(True) if flag is None else F.coalesce(flag, F.lit(False))
    src = narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text, flag=flag)
    return stored(src.mapInArrow(run, SCHEMA), "chunks")


def shards_for(chunks: DataFrame, chunk_bytes: int, shard_bytes: int) -> int:
    """As many hash shards as the chunks' bytes ask for, at least as many as the
    session's shuffle partitions, so that a shard keeps its size as the corpus grows."""
    least = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-chunks.count() * chunk_bytes // shard_bytes))


def rows(batch: pa.RecordBatch):
    """The rows of a batch of chunks as dictionaries; ``buf`` and ``offs`` as arrays."""
    unpress = zstandard.ZstdDecompressor()
    for i in range(batch.num_rows):
        r = {k: batch.column(k)[i].as_py() for k in batch.schema.names if k not in ("body", "offs")}
        r["offs"] = np.frombuffer(batch.column("offs")[i].as_buffer(), "<i8")
        raw = unpress.decompress(batch.column("body")[i].as_buffer()) if r["offs"][-1] else b""
        r["buf"] = np.frombuffer(raw, np.uint8)
        yield r


def with_answers(chunks: DataFrame, answers: DataFrame, name: str = "answers") -> DataFrame:
    """Chunk rows with ``name``: the shards' blobs for them in order of shard."""
    got = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "blob"))).alias(name))
    return chunks.join(got, "chunk", "left")
