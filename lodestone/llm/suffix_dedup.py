"""Removal of repeated byte strings by distributed suffix arrays.

Texts are bytes.  A byte goes when it lies in a ``LENGTH``-byte string that also
starts in a document with a smaller id (judged on the input).

A window is a string of ``LENGTH`` bytes; its minimiser is the smallest hash of
the ``GRAM``-byte strings in it.  Equal windows have equal minimisers, so each text is
cut into runs of windows with a common minimiser, and a run (at most ``LENGTH - GRAM
+ 1`` windows) goes, with its bytes, to the hash shard of that minimiser.  A first
round of packed hashes finds the minimisers that occur in more than one
document; runs of all others cannot repeat and stay where they are.  A chunk of
texts sends equal runs once, with the smallest id it has them in: all windows of
the copies under larger ids go for certain, so only that one needs an answer.
There are as many shards as the texts' bytes ask for.  In a shard equal runs are
one string with its smallest id.  Where different strings have
a minimiser in common, a suffix array of them (``lyndon_suffixes``, linear
grouping) brings equal windows side by side, and each group of equal windows
gets the smallest id of its strings.  What goes back is one bit per window: does it
start in a document with a smaller id.  A minimiser with very many strings is
split: its strings are cut anew by the minimisers of longer and longer grams, until
a group is small (at the full length equal keys are equal strings), so no group is
unbounded.

Defined results: null and empty texts have no bytes; texts shorter than
``LENGTH`` lose nothing; a null id is smaller than any other; rows with equal id
are not earlier than each other; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import mix64, pack, ragged, same_segments, segment_hash, shard_of, unpack
from lodestone.llm.chunks import chunked, rows, shards_for, with_answers
from lodestone.llm.common import stored
from lodestone.llm.lyndon_suffixes import suffix_orders

LENGTH = 50
GRAM = 16
#: Bytes of the strings of one minimiser that are sorted together.
TEXT_BYTES = 8192
#: Bytes that are sorted in step.
BATCH_BYTES = 1_000_000
#: Text of a chunk row, and of all chunks per hash shard on average.
CHUNK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20
_U = np.uint64
_NULL_ID = -(1 << 63)


def gram_hashes(part: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram``-byte string, by doubling."""
    codes = mix64(np.arange(256, dtype=_U) + _U(31))
    h, size, mul = codes[part], 1, np.array([0x9E3779B97F4A7C15], dtype=_U)
    while size * 2 <= gram:
        h = h[:-size] * mul + h[size:]
        mul = mul * mul
        size *= 2
    if size < gram:  # an overlapping second half
        d = gram - size
        h = h[:-d] * _U(0xD6E8FEB86659FD93) + h[d:]
    h ^= h >> _U(32)
    h *= _U(0xBF58476D1CE4E5B9)
    return h


def runs(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(start, windows, minimiser) of the runs of all texts, in order."""
    most = length - gram + 1
    out = []
    step = 1 << 20
    ends = offs[1:]
    for a in range(0, max(len(buf) - length + 1, 0), step):
        n = min(step, len(buf) - length + 1 - a)  # windows that start in a .. a + n
        m, size = gram_hashes(buf[a:a + n + length - 1], gram), 1
        while size * 2 <= most:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < most:
            m = np.minimum(m[:size - most], m[most - size:])
        # windows across the end of a text are none
        e = ends[(ends > a) & (ends < a + n + length - 1)]
        mark = np.zeros(n + 1, dtype=np.int64)
        lo, hi = np.clip(e - length + 1 - a, 0, n), np.clip(e - a, 0, n)
        np.add.at(mark, lo, 1)
        np.add.at(mark, hi, -1)
        valid = np.cumsum(mark[:-1]) == 0
        edge = np.concatenate([[True], (m[1:] != m[:-1]) | (valid[1:] != valid[:-1])])
        edge[np.clip(e - a, 0, n - 1)[e - a < n]] = True
        s = np.flatnonzero(edge)
        w = np.diff(np.append(s, n))
        ok = valid[s]
        s, w, v = s[ok], w[ok], m[s[ok]]
        if len(w) and w.max() > most:  # one byte over and over
            k = -(-w // most)
            at = ragged(np.zeros(len(k), np.int64), k)
            left = np.repeat(w, k) - at * most
            s, v = np.repeat(s, k) + at * most, np.repeat(v, k)
            w = np.minimum(left, most)
        out.append((s + a, w, v))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    s, w, v = (np.concatenate(x) for x in zip(*out))
    return s, w, mix64(v)  # minima are small numbers; mixed they spread over all shards


def _doc_ids(r: dict) -> np.ndarray:
    return np.array([_NULL_ID if i is None else i for i in r["doc_ids"]], dtype=np.int64)


def _chunk_runs(r: dict, length: int, gram: int):
    s, w, v = runs(r["buf"], r["offs"], length, gram)
    doc = _doc_ids(r)[np.searchsorted(r["offs"], s, side="right") - 1]
    return s, w, v, doc


def minimisers(chunks: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """(shard, chunk, blob): a chunk's distinct minimisers (48 bits, enough to
    propose) and whether more than one of its documents has each."""
    def run(batches):
        for b in batches:
            for r in rows(b):
                _, _, v, doc = _chunk_runs(r, length, gram)
                v = v >> _U(16)
                o = np.argsort(v, kind="stable")
                v, doc = v[o], doc[o]
                head = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
                u = v[head]
                several = np.minimum.reduceat(doc, head) != np.maximum.reduceat(doc, head) if len(v) else np.zeros(0, bool)
                cut = np.searchsorted(shard_of(u << _U(16), shards), np.arange(shards + 1))
                own = [s for s in range(shards) if cut[s + 1] > cut[s]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([r["chunk"]] * len(own), pa.int64()),
                     pa.array([_join(pack(u[cut[s]:cut[s + 1]], True), pack(several[cut[s]:cut[s + 1]].astype(np.uint8))) for s in own], pa.binary())],
                    names=["shard", "chunk", "blob"])
    return chunks.mapInArrow(run, "shard int, chunk long, blob binary")


def repeated(found: DataFrame) -> DataFrame:
    """(shard, chunk, blob): a bit per minimiser: in more than one document."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_split(x) for x in table["blob"].to_pylist()]
        v = [unpack(p[0], _U, True) for p in parts]
        several = np.concatenate([unpack(p[1], np.uint8) for p in parts])
        every = np.concatenate(v)
        o = np.argsort(every, kind="stable")
        s = every[o]
        twin = np.zeros(len(s), bool)
        twin[1:] = s[1:] == s[:-1]
        twin[:-1] |= twin[1:]
        flag = several > 0
        flag[o[twin]] = True
        ends = np.cumsum([len(x) for x in v])
        blobs = [np.packbits(f).tobytes() for f in np.split(flag, ends[:-1])]
        return pa.table({"shard": table["shard"], "chunk": table["chunk"], "blob": pa.array(blobs, pa.binary())})
    return found.groupBy("shard").applyInArrow(run, "shard int, chunk long, blob binary")


def _candidates(r: dict, answers, shards: int, length: int, gram: int):
    """Runs whose minimiser is in several documents, in order of minimiser, the
    first of each string (under its smallest id), and the string of each run."""
    s, w, v, doc = _chunk_runs(r, length, gram)
    u, inv = np.unique(v >> _U(16), return_inverse=True)
    cut = np.searchsorted(shard_of(u << _U(16), shards), np.arange(shards + 1))
    flag = np.zeros(len(u), bool)
    for a in answers or []:
        x, y = cut[a["shard"]], cut[a["shard"] + 1]
        flag[x:y] = np.unpackbits(np.frombuffer(a["blob"], np.uint8), count=y - x)
    use = np.flatnonzero(flag[inv])
    s, w, v, doc = s[use], w[use], v[use], doc[use]
    h = segment_hash(r["buf"], s, w + length - 1, 41)
    by = np.lexsort((doc, h, v))
    s, w, v, doc, h = (x[by] for x in (s, w, v, doc, h))
    same = np.concatenate([[False], (v[1:] == v[:-1]) & (h[1:] == h[:-1]) & (w[1:] == w[:-1])]) if len(s) else np.zeros(0, bool)
    twin = np.flatnonzero(same)
    same[twin] = same_segments(r["buf"], s[twin], r["buf"], s[twin - 1], w[twin] + length - 1)
    return s, w, v, doc, np.flatnonzero(~same), np.cumsum(~same) - 1


def candidate_runs(chunks: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """(shard, chunk, blob): the distinct candidate runs of a chunk with their
    bytes and the smallest id they stand under."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for r in rows(b):
                s, w, v, doc, head, _ = _candidates(r, r["answers"], shards, length, gram)
                s, w, v, doc = s[head], w[head], v[head], doc[head]
                cut = np.searchsorted(shard_of(v, shards), np.arange(shards + 1))
                own, blobs = [], []
                for k in range(shards):
                    x, y = cut[k], cut[k + 1]
                    if y > x:
                        ids, at = np.unique(doc[x:y], return_inverse=True)
                        body = r["buf"][ragged(s[x:y], w[x:y] + length - 1)].tobytes()
                        own.append(k)
                        blobs.append(_join(pack(v[x:y], True), pack(w[x:y].astype(np.uint8)), pack(ids), pack(at.astype(np.uint32)), press.compress(body)))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array([r["chunk"]] * len(own), pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["shard", "chunk", "blob"])
    return chunks.mapInArrow(run, "shard int, chunk long, blob binary")


def window_owners(data: np.ndarray, starts: np.ndarray, wins: np.ndarray, key: np.ndarray, owner: np.ndarray,
                  length: int, gram: int, text_bytes: int = TEXT_BYTES, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """The smallest owner of every window (a row of windows per string, in
    order): over all equal windows of strings with the same key.

    String i is ``data[starts[i] : starts[i] + wins[i] + length - 1]``."""
    out = np.repeat(owner, wins)
    place = np.cumsum(wins) - wins  # where a string's windows stand in the result
    # work items: (key, start, windows, owner, place); equal strings of a key are one
    work = (key, starts, wins, owner, place)
    while len(work[0]):
        k, s, w, own, at = work
        h = mix64(segment_hash(data, s, w + length - 1, 37) ^ k)
        o = np.lexsort((own, h, k))
        k, s, w, own, at, h = (x[o] for x in (k, s, w, own, at, h))
        same = np.concatenate([[False], (h[1:] == h[:-1]) & (k[1:] == k[:-1]) & (w[1:] == w[:-1])])
        twin = np.flatnonzero(same)  # the hash brings equal strings together, the bytes decide
        same[twin] = same_segments(data, s[twin], data, s[twin - 1], w[twin] + length - 1)
        head = np.flatnonzero(~same)
        times = np.diff(np.append(head, len(h)))
        low = own[head]  # sorted: the smallest owner of equal strings stands first
        # every copy gets its string's smallest owner now ...
        idx = ragged(at, w)
        out[idx] = np.minimum(out[idx], np.repeat(np.repeat(low, times), w))
        one = np.flatnonzero(~same)
        dk, ds, dw = k[one], s[one], w[one]
        newkey = np.concatenate([[True], dk[1:] != dk[:-1]])
        gid = np.cumsum(newkey) - 1
        many = np.bincount(gid)[gid] > 1
        if not many.any():
            break
        total = np.bincount(gid, weights=dw + length - 1)[gid]
        small = many & ((total <= text_bytes) | (gram >= length))
        # ... and where strings differ their equal windows are found by suffix order
        pick = np.flatnonzero(small)
        if len(pick):
            best = _sorted_windows(data, ds[pick], dw[pick], gid[pick], low[pick], length, batch_bytes)
            rank = np.full(len(one), -1)
            rank[pick] = np.arange(len(pick))
            begin = np.cumsum(dw[pick]) - dw[pick]
            of = np.repeat(rank, times)  # of every copy: its string among the picked
            c = np.flatnonzero(of >= 0)
            idx = ragged(at[c], w[c])
            out[idx] = np.minimum(out[idx], best[ragged(begin[of[c]], w[c])])
        # large groups: cut anew by the minimisers of longer grams; at the full
        # length a gram is a window, and equal keys are equal strings
        large = np.flatnonzero(np.repeat(many & ~small, times))
        gram = min(gram + 8 if gram < length - 4 else length, length)
        parts = [tuple(x[:0] for x in work)]
        for c in np.split(large, np.flatnonzero(np.diff(np.cumsum(w[large] + length - 1) // (1 << 22))) + 1):
            n = w[c] + length - 1
            offs = np.concatenate([[0], np.cumsum(n)])
            rs, rw, rv = runs(data[ragged(s[c], n)], offs, length, gram)
            of = np.searchsorted(offs, rs, side="right") - 1
            skip = rs - offs[of]
            parts.append((mix64(k[c][of] ^ mix64(rv)), s[c][of] + skip, rw, own[c][of], at[c][of] + skip))
        work = tuple(np.concatenate(x) for x in zip(*parts))
    return out


def _sorted_windows(data, starts, wins, group, owner, length, batch_bytes) -> np.ndarray:
    """Smallest owner per window by suffix arrays of the strings of each group."""
    lens = wins + length - 1
    out = np.empty(int(wins.sum()), dtype=np.int64)
    place = np.cumsum(wins) - wins
    # groups of similar size side by side
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    weight = np.add.reduceat(lens, head)
    count = np.diff(np.append(head, len(group)))
    by = np.argsort(weight, kind="stable")
    load = np.cumsum(weight[by])
    a = 0
    while a < len(by):
        b = max(a + 1, int(np.searchsorted(load, (load[a - 1] if a else 0) + batch_bytes, side="right")))
        pick = by[a:b]
        i = ragged(head[pick], count[pick])
        text = np.repeat(np.arange(len(pick)), count[pick])
        order, _ = suffix_orders(data, starts[i], lens[i], text)
        first = np.cumsum(lens[i]) - lens[i]
        string = np.repeat(np.arange(len(i)), lens[i])[order]
        off = order - first[string]
        ok = off < wins[i][string]  # suffixes that hold a window
        string, off = string[ok], off[ok]
        pos = starts[i][string] + off
        same = np.zeros(len(pos), bool)
        same[1:] = text[string[1:]] == text[string[:-1]]
        for d in [*range(0, length - 7, 8), length - 8]:
            j = np.flatnonzero(same)
            same[j] = _eight(data, pos[j] + d) == _eight(data, pos[j - 1] + d)
        run = np.flatnonzero(~same)
        low = np.minimum.reduceat(owner[i][string], run)
        out[place[i][string] + off] = np.repeat(low, np.diff(np.append(run, len(pos))))
        a = b
    return out


def _eight(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one number."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(_U)[:, 0] if len(at) else np.zeros(0, _U)


def judged(found: DataFrame, length: int, gram: int) -> DataFrame:
    """(shard, chunk, blob): per run a 64-bit mask of its windows that also
    start in a document with a smaller id."""
    def run(table: pa.Table) -> pa.Table:
        unpress = zstandard.ZstdDecompressor()
        parts = [_split(x) for x in table["blob"].to_pylist()]
        key = [unpack(p[0], _U, True) for p in parts]
        wins = np.concatenate([unpack(p[1], np.uint8) for p in parts]).astype(np.int64)
        doc = np.concatenate([unpack(p[2], np.int64)[unpack(p[3], np.uint32)] for p in parts])
        data = np.frombuffer(b"".join(unpress.decompress(p[4]) for p in parts), np.uint8)
        lens = wins + length - 1
        owner = window_owners(data, np.cumsum(lens) - lens, wins, np.concatenate(key), doc, length, gram)
        earlier = owner < np.repeat(doc, wins)
        first = np.cumsum(wins) - wins
        bit = _U(1) << (np.arange(len(earlier)) - np.repeat(first, wins)).astype(_U)
        mask = np.add.reduceat(np.where(earlier, bit, _U(0)), first) if len(first) else np.zeros(0, _U)
        ends = np.cumsum([len(x) for x in key])
        return pa.table({"shard": table["shard"], "chunk": table["chunk"],
                         "blob": pa.array([pack(m) for m in np.split(mask, ends[:-1])], pa.binary())})
    return found.groupBy("shard").applyInArrow(run, "shard int, chunk long, blob binary")


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_spans, n_removed, kept, spans) per row: the bytes
    that stay and the removed spans as (from, to)."""
    if not 8 <= gram <= length or length - gram + 1 > 64:
        raise ValueError("gram must be from 8 to length, and a run at most 64 windows")
    chunks = chunked(docs, doc_id, text, size=CHUNK_BYTES)
    shards = shards_for(chunks, CHUNK_BYTES, SHARD_BYTES)
    flags = stored(repeated(minimisers(chunks, shards, length, gram)), "flags")
    asked = stored(with_answers(chunks, flags), "asked")
    masks = stored(judged(candidate_runs(asked, shards, length, gram), length, gram), "masks")
    marks = masks.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "blob"))).alias("masks"))

    def cut(batches):
        for b in batches:
            for r in rows(b):
                s, w, _, doc, head, one = _candidates(r, r["answers"], shards, length, gram)
                m = [unpack(x["blob"], _U) for x in r["masks"] or []]
                m = np.concatenate(m) if m else np.zeros(0, _U)
                whole = _U(0xFFFFFFFFFFFFFFFF) >> (64 - w).astype(_U)  # every window of a copy under a larger id
                m = np.where(doc > doc[head][one], whole, m[one]) if len(s) else m
                buf, offs = r["buf"], r["offs"]
                starts = np.zeros(len(buf) + length, dtype=np.int32)  # windows to remove, shifted by ``length``
                for o in range(length - gram + 1):
                    starts[s[(m >> _U(o) & _U(1)) == 1] + o + length] = 1
                np.cumsum(starts, out=starts)
                gone = starts[length:] > starts[:len(buf)]  # a window starts among the last ``length`` bytes
                begin, finish = gone.copy(), gone.copy()
                begin[1:] &= ~gone[:-1]
                finish[:-1] &= ~gone[1:]
                full = np.diff(offs) > 0  # spans end with their text
                begin[offs[:-1][full]] = gone[offs[:-1][full]]
                finish[offs[1:][full] - 1] = gone[offs[1:][full] - 1]
                x, y = np.flatnonzero(begin), np.flatnonzero(finish) + 1
                of = np.searchsorted(offs, x, side="right") - 1
                first = np.searchsorted(of, np.arange(len(offs)))
                left = np.concatenate([[0], np.cumsum(~gone, dtype=np.int64)])[offs]
                kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offs) - 1, [
                    None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(buf[~gone].tobytes())])
                spans = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(x - offs[of]), pa.array(y - offs[of])], names=["from", "to"]))
                total = np.diff(offs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(total), pa.array(np.diff(first)),
                     pa.array(total - np.diff(left)), kept.cast(pa.binary()), spans],
                    names=["doc_id", "n_bytes", "n_spans", "n_removed", "kept", "spans"])
    return (asked.join(marks, "chunk", "left").mapInArrow(
        cut, "doc_id long, n_bytes long, n_spans long, n_removed long, kept binary, spans array<struct<from: long, to: long>>"))
