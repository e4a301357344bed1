"""Elias-Fano coded monotone sequences with whole-array queries.

A value's low bits are stored as they are, packed; its high part in unary: bit
``high + index`` is set, so every zero ends a bucket of equal high parts.  A
search finds its bucket by selecting two zeros and halves it by low bits.
All parts are views over one buffer, so a sequence can be memory-mapped.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        """From an ascending array of unsigned integers."""
        v = np.asarray(values, dtype=_U)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, int(top // max(n, 1)).bit_length() - 1)
        low = np.zeros((n * bits + 63) // 64 + 2, dtype=_U)
        if bits:
            at = np.arange(n, dtype=_U) * _U(bits)
            part = v & _U((1 << bits) - 1)
            word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
            np.bitwise_or.at(low, word, part << off)
            over = np.flatnonzero(off + _U(bits) > _U(64))
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - off[over]))
        size = n + (top >> bits) + 1
        flags = np.zeros((size + 127) // 128 * 128, dtype=np.uint8)
        flags[(v >> _U(bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(_U)
        free = 128 - np.bitwise_count(high).reshape(-1, 2).sum(axis=1).astype(np.int64)
        return cls(n, bits, low, high, np.concatenate([[0], np.cumsum(free)]))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.zeros)], dtype="<i8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.zeros.astype("<i8").tobytes()

    @classmethod
    def view(cls, buf, at: int = 0) -> tuple["EliasFano", int]:
        """A sequence over a buffer (or memory map) from byte ``at``, and where it ends."""
        n, bits, a, b, c = (int(x) for x in np.frombuffer(buf, "<i8", 5, at))
        at += 40
        low = np.frombuffer(buf, "<u8", a, at)
        high = np.frombuffer(buf, "<u8", b, at + 8 * a)
        zeros = np.frombuffer(buf, "<i8", c, at + 8 * (a + b))
        return cls(n, bits, low, high, zeros), at + 8 * (a + b + c)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=_U)
        at = i.astype(_U) * _U(self.low_bits)
        word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
        v = self.low[word] >> off
        over = np.flatnonzero(off + _U(self.low_bits) > _U(64))
        v[over] |= self.low[word[over] + 1] << (_U(64) - off[over])
        return v & _U((1 << self.low_bits) - 1)

    def _select0(self, j: np.ndarray) -> np.ndarray:
        """Position of the j-th zero (from 0) of the high part."""
        block = np.searchsorted(self.zeros, j, side="right") - 1
        r = (j - self.zeros[block]).astype(np.int64)
        word = 2 * block
        z = 64 - np.bitwise_count(self.high[word]).astype(np.int64)
        second = r >= z
        r -= np.where(second, z, 0)
        word = word + second
        w, pos = ~self.high[word], np.zeros(len(j), dtype=np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            c = np.bitwise_count(w & _U((1 << half) - 1)).astype(np.int64)
            up = r >= c
            r -= np.where(up, c, 0)
            pos += np.where(up, half, 0)
            w = np.where(up, w >> _U(half), w)
        return word * 64 + pos

    def find(self, x: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Index of each value, -1 where it does not occur (or not within
        ``start`` to ``end``)."""
        x = np.asarray(x, dtype=_U)
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n or not len(x):
            return out
        top = x >> _U(self.low_bits)
        here = np.flatnonzero(top < _U(int(self.zeros[-1])))
        h = top[here].astype(np.int64)
        low = np.zeros(len(here), dtype=np.int64)
        later = np.flatnonzero(h > 0)
        low[later] = self._select0(h[later] - 1) - (h[later] - 1)
        high = np.minimum(self._select0(h) - h, self.n)  # the bucket is low .. high
        if start is not None:
            low = np.maximum(low, start[here])
        if end is not None:
            high = np.minimum(high, end[here])
        want = x[here] & _U((1 << self.low_bits) - 1)
        go = np.flatnonzero(low < high)
        here, low, high, want = here[go], low[go], high[go], want[go]
        while len(here):  # halve the buckets
            mid = (low + high) >> 1
            v = self._low(mid)
            hit = v == want
            out[here[hit]] = mid[hit]
            less = v < want
            low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
            go = np.flatnonzero(~hit & (low < high))
            here, low, high, want = here[go], low[go], high[go], want[go]
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at indices ``i``."""
        i = np.asarray(i, dtype=np.int64)
        ones = np.arange(len(self.zeros), dtype=np.int64) * 128 - self.zeros
        block = np.searchsorted(ones, i, side="right") - 1
        r = i - ones[block]
        word = 2 * block
        z = np.bitwise_count(self.high[word]).astype(np.int64)
        second = r >= z
        r -= np.where(second, z, 0)
        word = word + second
        w, pos = self.high[word].copy(), np.zeros(len(i), dtype=np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            c = np.bitwise_count(w & _U((1 << half) - 1)).astype(np.int64)
            up = r >= c
            r -= np.where(up, c, 0)
            pos += np.where(up, half, 0)
            w = np.where(up, w >> _U(half), w)
        return (word * 64 + pos - i).astype(_U) << _U(self.low_bits) | self._low(i)
