"""Array helpers shared by the operators of this subpackage.

Texts reach the tasks as Arrow batches.  These helpers look at a batch as one
byte buffer plus document offsets and find words and hash them with whole-array
numpy steps, so no Python statement runs per word.  They also pack integer
arrays into small blobs: the operators exchange blobs of many integers per
Spark row instead of one row per integer.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U64 = np.uint64
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and odd multipliers), element by element."""
    x = np.array(x, dtype=U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Every ASCII byte that is neither letter nor digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes with A-Z as a-z.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: The low 0 to 8 bytes of a number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U64)


def worker_cache() -> dict:
    """What this Python process keeps from task to task.  (Functions of this
    package travel to the workers by value, so module variables do not.)"""
    module = sys.modules.setdefault("_lodestone_worker", types.ModuleType("_lodestone_worker"))
    return module.__dict__.setdefault("held", {})


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``n + 1`` offsets of an Arrow string or binary column; null
    counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], pa.string())
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def text_parts(col, limit: int = 1 << 19):
    """A text column in parts of about ``limit`` bytes: (first row, last row + 1,
    part)."""
    sizes = np.asarray(pc.binary_length(col).fill_null(0)).astype(np.int64)
    ends, i = np.cumsum(sizes), 0
    while i < len(col):
        done = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield i, j, col.slice(i, j - i)
        i = j


def slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int):
    """A batch in parts of about ``limit`` units, so that the working arrays of
    a part stay small (a larger row is a part of its own)."""
    ends, i = np.cumsum(sizes, dtype=np.int64), 0
    while i < batch.num_rows:
        done = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(i, j - i)
        i = j


def pieces(buf: np.ndarray, offs: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes that end at a document's end or, inside
    a longer document, before a white space byte, so no word is cut (a longer
    word makes a longer range)."""
    n, at = len(buf), 0
    while at < n:
        to = min(at + limit, n)
        if to < n:
            k = int(offs[np.searchsorted(offs, to, side="right") - 1])
            if k > at:
                to = k
            else:
                end = int(offs[np.searchsorted(offs, to, side="right")])
                while to < end:
                    hit = np.flatnonzero(SPACE[buf[to:min(to + 65536, end)]])
                    if len(hit):
                        to += int(hit[0])
                        break
                    to = min(to + 65536, end)
        yield at, to
        at = to


def eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as a number (0 beyond the end)."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def segment_hash(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of each given segment of ``buf``.  Every eight bytes are mixed
    with their place before they are added, so no arrangement of the bytes makes
    two segments equal by construction."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    held = eights(buf)
    salt = int(seed) * 0xA24BAED4963EE407 + 0x9FB21C651E98DF25
    h = mix64((held[starts] & _LOW[np.minimum(lens, 8)]) + U64(salt & _MASK))
    long = np.flatnonzero(lens > 8)
    step = 1 << 16
    for a in range(0, len(long), step):  # the blocks behind the first one
        i = long[a:a + step]
        n = (lens[i] - 1) >> 3
        first = np.cumsum(n) - n
        k = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(first, n) + 1
        at = np.repeat(starts[i], n) + 8 * k
        left = np.minimum(np.repeat(lens[i], n) - 8 * k, 8)
        block = (held[at] & _LOW[left]) + (k.astype(U64) * U64(0xD1342543DE82EF95) + U64(salt & _MASK))
        h[i] += np.add.reduceat(mix64(block), first)
    return mix64(h + lens.astype(U64) * U64(0xD6E8FEB86659FD93))


def same_segments(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether segments of equal lengths hold the same bytes."""
    x, y = eights(a), eights(b)
    same = (x[a_at] ^ y[b_at]) & _LOW[np.minimum(lens, 8)] == 0
    long = np.flatnonzero(same & (lens > 8))
    for c in range(0, len(long), 1 << 16):
        i = long[c:c + (1 << 16)]
        n = (lens[i] - 1) >> 3
        k = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n) + 1
        left = np.minimum(np.repeat(lens[i], n) - 8 * k, 8)
        odd = (x[np.repeat(a_at[i], n) + 8 * k] ^ y[np.repeat(b_at[i], n) + 8 * k]) & _LOW[left] != 0
        same[np.repeat(i, n)[odd]] = False
    return same


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch: hash (A-Z folded) of each and,
    per document, the range of its words."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, fold_case: bool = True, seed: int = 1,
                 spans: bool = False, apart: np.ndarray = SPACE):
        hashes, starts_all, lens_all = [], [], []
        is_doc_start = np.zeros(len(buf) + 1, dtype=bool)
        is_doc_start[offs[:-1]] = True
        for a, b in pieces(buf, offs):
            part = _FOLD[buf[a:b]] if fold_case else buf[a:b]
            solid = ~apart[part]
            head = solid.copy()
            head[1:] &= ~solid[:-1] | is_doc_start[a + 1:b]
            tail = solid.copy()
            tail[:-1] &= ~solid[1:] | is_doc_start[a + 1:b]
            s = np.flatnonzero(head)
            n = np.flatnonzero(tail) + 1 - s
            hashes.append(segment_hash(part, s, n, seed))
            starts_all.append(s + a)
            if spans:
                lens_all.append(n)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, U64)
        self.start = np.concatenate(starts_all) if starts_all else np.zeros(0, np.int64)
        if spans:
            self.length = np.concatenate(lens_all) if lens_all else np.zeros(0, np.int64)
        #: words of document i are first[i]:first[i + 1]
        self.first = np.searchsorted(self.start, offs)

    def docs(self) -> np.ndarray:
        """The document number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of each run of ``n`` consecutive word hashes."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=U64)
    h = np.zeros(m, dtype=U64)
    for k in range(n):
        h ^= h >> U64(32)
        h *= U64(_BASE)
        h += words[k:k + m]
    return mix64(h)


def doc_grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every ``n``-word shingle; a shorter non-empty
    document gives its whole sequence as one shingle."""
    doc = words.docs()
    h = gram_hash(words.hash, n)
    inside = doc[:len(h)] == doc[n - 1:] if len(h) else np.zeros(0, bool)
    d, g = doc[:len(h)][inside], h[inside]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        sh = np.array([_short(words.hash[words.first[i]:words.first[i + 1]]) for i in short], dtype=U64)
        d, g = np.concatenate([d, short]), np.concatenate([g, sh])
    return d, g


def _short(words: np.ndarray) -> int:
    h = len(words)
    for w in words.tolist():
        h = ((h ^ h >> 32) * _BASE + w) & _MASK
    return int(mix64(np.array([h ^ 0xA5A5A5A5A5A5A5A5], dtype=U64))[0])


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lens[i] - 1`` of all i, in order."""
    total = int(lens.sum())
    first = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lens)


class Remembered:
    """Id sequences of byte strings, looked up by hash whole arrays at a time.
    A hit counts only if the bytes are the same; a string whose hash another
    one holds goes on under a second hash.  Starts over when it holds more than
    ``limit`` strings, so its memory is bounded."""

    def __init__(self, dtype, limit: int, seed: int = 23):
        self.dtype, self.limit, self.seed = dtype, limit, seed
        self.bits = max(8, limit.bit_length() - 1)  # of the slots by which hashes are looked up
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(1, U64)  # one more than is used: a safe place to look
        self.at, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.text_at, self.text_len = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.start = np.zeros(1, U64)  # the first eight bytes
        self.flat, self.text = np.zeros(0, self.dtype), np.zeros(0, np.uint8)
        self.first = np.zeros((1 << self.bits) + 1, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where it is not held."""
        slot = (h >> U64(64 - self.bits)).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        hit = (self.key[at] == h) & (at < end)
        out = np.where(hit, at, np.int32(-1))
        rest = np.flatnonzero(~hit & (end - at > 1))
        while len(rest):
            at[rest] += 1
            r = at[rest]
            ok = self.key[r] == h[rest]
            out[rest[ok]] = r[ok]
            rest = rest[~ok & (end[rest] - r > 1)]
        return out

    def add(self, h: np.ndarray, size: np.ndarray, ids: np.ndarray, start: np.ndarray, lens: np.ndarray, text: np.ndarray) -> None:
        """Add strings of ascending hashes that are not held."""
        place = np.searchsorted(self.key[:-1], h) + np.arange(len(h))
        old = np.ones(len(self.key) + len(h), dtype=bool)
        old[place] = False

        def put(held: np.ndarray, new: np.ndarray) -> np.ndarray:
            out = np.empty(len(old), held.dtype)
            out[old], out[place] = held, new
            return out
        self.key, self.size, self.start, self.text_len = put(self.key, h), put(self.size, size), put(self.start, start), put(self.text_len, lens)
        self.at = put(self.at, len(self.flat) + np.cumsum(size) - size)
        self.text_at = put(self.text_at, len(self.text) + np.cumsum(lens) - lens)
        self.flat, self.text = np.concatenate([self.flat, ids]), np.concatenate([self.text, text])
        slot = (self.key[:-1] >> U64(64 - self.bits)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=1 << self.bits))]).astype(np.int32)

    def resolve(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray, learn) -> np.ndarray:
        """Index of each segment of ``buf``; ``learn(places)`` gives (sizes, ids)
        of segments that are new, by where they first stand."""
        h, turn = segment_hash(buf, starts, lens, self.seed), 0
        begin = eights(buf)[starts] & _LOW[np.minimum(lens, 8)]
        long = np.flatnonzero(lens > 8)
        while True:
            out = self._held(h, begin, buf, starts, lens, learn)
            same = (self.start[out] == begin) & (self.text_len[out] == lens)
            i = long[same[long]]
            same[i] = same_segments(buf, starts[i], self.text, self.text_at[out[i]], lens[i])
            odd = np.flatnonzero(~same)
            if not len(odd):
                return out
            turn += 1
            h[odd] = segment_hash(buf, starts[odd], lens[odd], self.seed + turn)

    def _held(self, h, begin, buf, starts, lens, learn) -> np.ndarray:
        out = self.find(h)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            u, one = np.unique(h[missing], return_index=True)
            if len(self.key) + len(u) > self.limit and len(self.key) > 1:
                self.forget()
                return self._held(h, begin, buf, starts, lens, learn)
            i = missing[one]
            size, ids = learn(i)
            self.add(u, size, ids, begin[i], lens[i], buf[ragged(starts[i], lens[i])])
            out = self.find(h)
        return out


def pack(a: np.ndarray, ascending: bool = False) -> bytes:
    """An integer array as a compressed blob: differences when ascending, byte
    planes apart, zstandard."""
    a = np.ascontiguousarray(a)
    if ascending and len(a):
        a = np.diff(a, prepend=a.dtype.type(0))
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, dtype, ascending: bool = False) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(b, max_output_size=0)
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(size, len(raw) // size)
    a = np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
    return np.cumsum(a, dtype=dtype) if ascending else a


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit hash, by its high bits (ascending hashes give
    ascending shards)."""
    return ((h >> U64(40)) * U64(shards) >> U64(24)).astype(np.int64)


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark longs."""
    return h.view(np.int64)
