"""Range asymmetric numeral system over integer symbols, vectorised.

A block of symbols is dealt round robin over ``LANES`` independent coder
states; every step codes one symbol per lane with whole-array arithmetic.
States are 64-bit in [2^31, 2^63) and move 32-bit words.  The table is static
and shared: ``quantise`` makes frequencies that sum to ``2^bits`` and give
every symbol that occurs at least one slot.

A block is self-contained: header, lane states and word stream, plus a
checkpoint (lane states and stream position) every ``EVERY`` steps, so parts
of a block can be decoded on their own, and a CRC-32 of its symbols per
checkpoint interval, so a damaged part is found.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 1024
EVERY = 128
LOW = np.uint64(1 << 31)
_MAGIC = b"RANS1\0\0\0"
_HEAD = "<8sIIQQI"  # magic, bits, lanes, symbols, words, checkpoints


class Table:
    """Quantised symbol frequencies: ``symbols`` ascending, ``freq`` summing to ``2**bits``."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray, bits: int):
        self.bits = bits
        self.symbols = np.asarray(symbols, dtype=np.uint32)
        self.freq = np.asarray(freq, dtype=np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        size = int(self.symbols[-1]) + 1 if len(self.symbols) else 0
        self.index = np.full(size, -1, dtype=np.int64)
        self.index[self.symbols] = np.arange(len(self.symbols))
        self.slot = np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freq.astype(np.int64))


def quantise(symbols: np.ndarray, counts: np.ndarray, bits: int | None = None) -> Table:
    """Frequencies in proportion to ``counts``, none below 1, that sum to 2^bits."""
    order = np.argsort(symbols)
    symbols, counts = np.asarray(symbols)[order], np.asarray(counts, dtype=np.float64)[order]
    n = len(symbols)
    bits = bits or max(12, int(np.ceil(np.log2(max(n, 1)))) + 2)
    if n > 1 << bits or bits > 24:
        raise ValueError(f"{n} symbols do not fit {bits} bits")
    if not n:
        return Table(symbols, np.zeros(0), bits)
    free = (1 << bits) - n
    share = counts / counts.sum() * free
    freq = 1 + np.floor(share).astype(np.int64)
    rest = (1 << bits) - int(freq.sum())
    freq[np.argsort(np.floor(share) - share, kind="stable")[:rest]] += 1
    return Table(symbols, freq, bits)


def encode(ids: np.ndarray, t: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    """One block of symbols as bytes."""
    n = len(ids)
    steps = -(-n // lanes)
    k = t.index[ids]
    if n and k.min() < 0:
        raise ValueError("a symbol is not in the table")
    freq, start = t.freq[k], t.start[k]
    state = np.full(lanes, LOW, dtype=np.uint64)
    bits, up = np.uint64(t.bits), np.uint64(63 - t.bits)
    chunks, marks, written = [], [], 0
    for s in range(steps - 1, -1, -1):
        a, b = s * lanes, min(n, (s + 1) * lanes)
        x, f = state[:b - a], freq[a:b]
        full = x >> up >= f
        if full.any():
            chunks.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1])
            written += len(chunks[-1])
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[:b - a] = (q << bits) + (x - q * f) + start[a:b]
        if s % every == 0:
            marks.append((state.copy(), written))
    words = np.concatenate(chunks)[::-1] if chunks else np.zeros(0, "<u4")
    marks.reverse()  # marks[c]: the state from which step c * every decodes
    sums = [zlib.crc32(np.ascontiguousarray(ids[c * every * lanes:(c + 1) * every * lanes], dtype="<u4"))
            for c in range(len(marks))]
    head = struct.pack(_HEAD, _MAGIC, t.bits, lanes, n, len(words), len(marks))
    body = b"".join(m.astype("<u8").tobytes() + struct.pack("<QI", written - w, c) for (m, w), c in zip(marks, sums))
    return head + struct.pack("<I", every) + body + words.astype("<u4").tobytes()


def decode(block: bytes, t: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The symbols of checkpoint intervals ``first`` to ``last`` (all by
    default); every interval's checksum is verified."""
    magic, bits, lanes, n, n_words, n_marks = struct.unpack_from(_HEAD, block)
    if magic != _MAGIC or bits != t.bits:
        raise ValueError("not a block of this table")
    (every,) = struct.unpack_from("<I", block, struct.calcsize(_HEAD))
    at, size = struct.calcsize(_HEAD) + 4, 8 * lanes + 12
    words = np.frombuffer(block, "<u4", n_words, at + size * n_marks).astype(np.uint64)
    out = []
    for c in range(first, n_marks if last is None else last):
        state = np.frombuffer(block, "<u8", lanes, at + c * size).astype(np.uint64)
        pos, crc = struct.unpack_from("<QI", block, at + c * size + 8 * lanes)
        low, high = c * every * lanes, min(n, (c + 1) * every * lanes)
        got = np.empty(high - low, dtype=np.uint32)
        mask, bits64 = np.uint64((1 << bits) - 1), np.uint64(bits)
        for a in range(low, high, lanes):
            b = min(high, a + lanes)
            x = state[:b - a]
            slot = x & mask
            k = t.slot[slot.astype(np.int64)]
            got[a - low:b - low] = t.symbols[k]
            x = t.freq[k] * (x >> bits64) + slot - t.start[k]
            need = np.flatnonzero(x < LOW)
            if len(need):
                x[need] = x[need] << np.uint64(32) | words[pos:pos + len(need)]
                pos += len(need)
            state[:b - a] = x
        if zlib.crc32(got.astype("<u4", copy=False)) != crc:
            raise ValueError(f"checksum of interval {c} does not match")
        out.append(got)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def crc32_combine(a: int, b: int, length: int) -> int:
    """CRC-32 of two joined byte strings from their own CRCs and the second's
    length, by multiplication with x^(8 * length) modulo the CRC polynomial."""
    def times(p: int, q: int) -> int:  # carry-less product modulo the polynomial, bits reflected
        r = 0
        for _ in range(32):
            if q & 0x80000000:
                r ^= p
            p = p >> 1 ^ (0xEDB88320 if p & 1 else 0)
            q = q << 1 & 0xFFFFFFFF
        return r
    shift, power = 0x80000000, 0x00800000  # 1 and x^8
    while length:
        if length & 1:
            shift = times(shift, power)
        power = times(power, power)
        length >>= 1
    return times(a, shift) ^ b
