"""N-gram Jaccard self-join with signature trees.

A document's set holds its distinct word n-grams; two documents link when the
Jaccard similarity of their sets is ``percent`` / 100 or more.  Equal sets form
a class that is represented by its smallest id; all further work is on classes.

Candidates, without loss.  Sizes are cut into intervals so that linked sets
lie in the same or in neighbouring ones.  Linked sets of a pair of intervals
differ in at most H elements, so if the hash range is cut into more than H
parts they agree in a whole part.  Every non-empty part is a signature; classes
with a common signature are candidates.  (A set with so many empty parts that
the agreeing one may be empty also sends its prefix, the ``n - ceil(t n) + 1``
smallest hashes: its partners then are in the same case, and two prefixes of
linked sets meet.)  A part holds few elements, so texts that share a line share
parts too.  Neighbouring parts therefore form bands, and a signature travels
with a sketch of its band, the parity of the elements per bit.  The differences
of a linked pair are fewer than the non-empty parts of either set, so in some
band they are fewer than its non-empty parts: there the pair agrees in a part
and the sketches differ in fewer bits than the band has parts.  Only signatures
that are equal and whose sketches are that near make a candidate.  Signatures
travel as packed arrays per hash shard, and the connected components of the
candidates, near copies but for a few, are the blocks of the join.

Join of a block.  A signature tree holds in its leaves a bitmap of each set
(hash bits) and its size; nodes above hold the OR of the bitmaps, the range of
sizes and the largest collision surplus (size minus bits).  Two nodes are
traversed together; a pair is pruned when the most its sets can overlap, the
common bits plus the smaller surplus, or the smaller size, is less than a link
needs, and also when both lie in one component already, so a group of near
copies costs about as many comparisons as it has members.  Surviving leaves are
compared exactly.  Blocks larger than ``BLOCK`` elements are divided into groups of
neighbouring size intervals, and groups still larger are cut by hash; parts
that did not grow together are compared part against part, the rest need not be.

Defined results: null, empty and blank texts have size 0 and link to nothing;
fewer words than n are one n-gram; rows with a null id have a null component;
repeated rows get the same result each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm.arrays import Words, doc_grams, mix64, pack, ragged, shard_of, slices, text_buffer, text_parts, unpack
from lodestone.llm.common import narrow, stored
from lodestone.llm.components import connected_components, lowest
from lodestone.session import join_small

WORDS = 4
PERCENT = 85
#: Elements of the sets of a block; labels with fewer share a task up to an
#: eighth of it on average.
BLOCK = 8_000_000
#: Text that is hashed at a time.
SLICE_BYTES = 4 << 20
#: Text whose signatures a hash shard holds on average.
SHARD_BYTES = 8 << 20
FANOUT = 8
#: Parts of a band, about.
BAND = 8
#: Limit of a sketch that says nothing; the lowest four bits of a sketch are its
#: limit, the most bits in which linked sets differ.
UNLIMITED = 15
#: Pairs of sketches that are compared at a time.
PAIRS = 1 << 19
#: Orders in which neighbours are compared before the tree is.
ORDERS = 4
_U = np.uint64


def batch_sets(col, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first): the sorted distinct n-gram hashes of each text, one
    after another; those of text i are elements[first[i]:first[i + 1]]."""
    w = Words(*text_buffer(col))
    doc, g = doc_grams(w, n)
    order = np.argsort(doc, kind="stable") if len(doc) and (np.diff(doc) < 0).any() else slice(None)
    doc, g = doc[order], g[order]
    cut = np.searchsorted(doc, np.arange(len(w.first)))
    sets = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        s = np.sort(g[a:b])
        sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if b > a else s)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, _U), first


def row_sets(col, n: int) -> list[np.ndarray]:
    """The set of every text, read part by part."""
    out = []
    for _, _, part in text_parts(col, SLICE_BYTES):
        elements, first = batch_sets(part, n)
        out += [elements[a:b].copy() for a, b in zip(first[:-1], first[1:])]
    return out


def digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def class_key(d: bytes) -> int:
    return int.from_bytes(d[:8], "little", signed=True)


class Intervals:
    """Size intervals and, per group of two neighbours, how much linked sets
    can differ and into how many parts the hash range is cut."""

    def __init__(self, percent: int, largest: int):
        self.percent, low = percent, [1]
        while low[-1] <= largest:
            low.append(low[-1] * 100 // percent + 1)
        low.append(low[-1] * 100 // percent + 1)
        self.low = np.array(low, dtype=np.int64)

    def differ(self, n: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The most elements in which a set of size ``n`` and a linked set of
        its group differ (one of the two is in the group's lower interval)."""
        top, p = self.low[np.minimum(group + 1, len(self.low) - 1)] - 1, self.percent
        partner = np.where(n <= top, n * 100 // p, top)
        return (n + partner) * (100 - p) // (100 + p)

    def parts(self, group: np.ndarray) -> np.ndarray:
        top = self.low[np.minimum(group + 1, len(self.low) - 1)] - 1
        most = (top + top * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)
        return most + 1 + (most + 19) // 20  # a few more, so empty parts seldom matter


def signatures(elements: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of all signatures of the given sets."""
    return sketched_signatures(elements, first, percent)[:2]


def sketched_signatures(elements: np.ndarray, first: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, signature, sketch) of all signatures of the given sets.  Linked
    sets that are not equal have a signature in common whose sketches are ``near``."""
    size = np.diff(first)
    if not len(size) or not size.any():
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, _U)
    iv = Intervals(percent, int(size.max()))
    own = np.searchsorted(iv.low, size, side="right") - 1
    who = np.repeat(np.arange(len(size)), size)
    spread = mix64(elements ^ _U(0x5851F42D4C957F2D))
    # 60 bits above the four of the limit
    bit = _U(1) << (((spread & _U(0xFFFFFFFF)) * _U(60) >> _U(32)) + _U(4))
    out_set, out_sig, out_sketch = [], [], []
    for group in (own, own - 1):
        differ = np.where((size > 0) & (group >= 0), iv.differ(size, np.maximum(group, 0)), 0)
        use = differ > 0  # otherwise only equal sets link, and those are one class
        k = np.where(use, iv.parts(np.maximum(group, 0)), 0)
        base = np.cumsum(k) - k
        on = use[who]
        part = ((spread[on] >> _U(32)) * k[who[on]].astype(_U) >> _U(32)).astype(np.int64)
        at = base[who[on]] + part
        total = int(k.sum())
        e = elements[on]
        low = np.bincount(at, weights=(e & _U(0xFFFFFFFF)).astype(np.float64), minlength=total)
        high = np.bincount(at, weights=(e >> _U(32)).astype(np.float64), minlength=total)
        full = np.flatnonzero(np.bincount(at, minlength=total))
        owner = np.searchsorted(base + k, full, side="right")
        content = (low[full] % 2.0**32).astype(_U) | (high[full] % 2.0**32).astype(_U) << _U(32)
        place = (group[owner].astype(_U) << _U(32)) + (full - base[owner]).astype(_U)
        bands = np.maximum((k + BAND // 2) // BAND, 1)
        first_band = np.cumsum(bands) - bands
        parity = np.zeros(int(bands.sum()), _U)
        np.bitwise_xor.at(parity, first_band[who[on]] + part * bands[who[on]] // np.maximum(k, 1)[who[on]], bit[on])
        limit = -(-k // bands) - 1
        band = first_band[owner] + (full - base[owner]) * bands[owner] // np.maximum(k, 1)[owner]
        out_set.append(owner)
        out_sig.append(mix64(mix64(content) ^ mix64(place + _U(1))))
        out_sketch.append(parity[band] | limit[owner].astype(_U))
        filled = np.bincount(owner, minlength=len(size))
        for i in np.flatnonzero(use & (filled <= differ)).tolist():
            s = elements[first[i]:first[i + 1]]
            p = s[:len(s) - -(-percent * len(s) // 100) + 1]
            whole = int(np.bitwise_xor.reduce(bit[first[i]:first[i + 1]]))
            out_set.append(np.full(len(p), i))
            out_sig.append(mix64(mix64(p) ^ _U((int(group[i]) << 1 | 1) * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF)))
            out_sketch.append(np.full(len(p), whole | min(int(k[i]) - 1, UNLIMITED), _U))  # fewer than k elements differ
    return np.concatenate(out_set), np.concatenate(out_sig), np.concatenate(out_sketch)


def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two sketches have the same limit and differ in no more bits."""
    limit, odd = x & _U(15), x ^ y
    return ((odd & _U(15)) == 0) & ((np.bitwise_count(odd) <= limit) | (limit == UNLIMITED))


def candidate_components(sig: np.ndarray, cls: np.ndarray, size: np.ndarray, sketch: np.ndarray,
                         percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The components of the candidates among a shard's signatures, as (class,
    smallest class).  Rows with equal signature and sketch are runs; runs of a
    signature are compared with its longest first, then those outside of that
    one's component with all others, unless they are in one component already."""
    o = np.argsort(sig, kind="stable")
    twin = sig[o][1:] == sig[o][:-1]  # signatures that occur more than once
    o = o[np.concatenate([twin, [False]]) | np.concatenate([[False], twin])] if len(o) else o
    o = o[np.lexsort((cls[o], size[o], sketch[o], sig[o]))]
    if not len(o):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, k, n = sig[o], sketch[o], size[o]
    nodes, node = np.unique(cls[o], return_inverse=True)
    same = (s[1:] == s[:-1]) & (k[1:] == k[:-1]) & (100 * n[:-1] >= percent * n[1:])
    low = lowest(np.arange(len(nodes)), node[:-1][same], node[1:][same])
    # the runs, by signature
    a = np.flatnonzero(np.concatenate([[True], ~same]))
    b = np.concatenate([a[1:], [len(s)]])
    k, node, small, large, rows = k[a], node[a], n[a], n[b - 1], b - a
    start = np.flatnonzero(np.concatenate([[True], s[a][1:] != s[a][:-1]]))
    count = np.diff(np.concatenate([start, [len(a)]]))

    def join(x, y) -> None:
        nonlocal low
        fit = ((low[node[x]] != low[node[y]]) & (100 * large[x] >= percent * small[y]) & (100 * large[y] >= percent * small[x]))
        x, y = x[fit], y[fit]
        fit = near(k[x], k[y])
        if fit.any():
            low = lowest(low, node[x[fit]], node[y[fit]])

    group = np.repeat(np.arange(len(start)), count)
    order = np.lexsort((-rows, group))
    pivot = order[start]
    join(np.arange(len(a)), pivot[group])
    # the smaller groups first: what they join need not be compared in larger ones
    left = np.flatnonzero(np.maximum.reduceat(low[node], start) != np.minimum.reduceat(low[node], start))
    left = left[np.argsort(count[left], kind="stable")]
    cost = np.cumsum(count[left].astype(np.float64) ** 2)
    at = 0
    while at < len(left):
        upto = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + PAIRS, side="right")))
        g, at = left[at:upto], upto
        x = ragged(start[g], count[g])
        x = x[low[node[x]] != low[node[pivot[group[x]]]]]
        step = max(1, PAIRS // int(count[g].max())) if len(g) == 1 else max(1, len(x))
        for i in range(0, len(x), step):
            r = x[i:i + step]
            r = r[low[node[r]] != low[node[pivot[group[r]]]]]
            join(np.repeat(r, count[group[r]]), ragged(start[group[r]], count[group[r]]))
    far = low != np.arange(len(nodes))
    return nodes[far], nodes[low[far]]


_SCAN = "doc_id long, n long, digest binary, cls long, shard int, blob binary"


def scan_documents(docs: DataFrame, doc_id: str, text: str, n: int, percent: int, shards: int) -> DataFrame:
    """One pass over the texts: a row per document (doc_id, n, digest, cls),
    dealt in turn to shards of their own (``shards`` and on), and rows of packed
    signatures per shard."""
    def parts(batches):
        for b in batches:
            yield from slices(b, np.asarray(pc.binary_length(b.column(1)).fill_null(0)), SLICE_BYTES)

    def run(batches):
        seen = TaskContext.get().partitionId()
        for b in parts(batches):
            elements, first = batch_sets(b.column(1), n)
            m = b.num_rows
            place, seen = shards + (seen + np.arange(m)) % shards, seen + m
            size = np.diff(first)
            d = [digest(elements[first[i]:first[i + 1]]) for i in range(m)]
            cls = [class_key(x) for x in d]
            null = pa.nulls
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(d, pa.binary()), pa.array(cls, pa.int64()),
                                              pa.array(place.astype(np.int32)), null(m, pa.binary())],
                                             names=_names(_SCAN))
            one = {c: i for i, (c, known) in enumerate(zip(cls, b.column(0).is_valid().to_pylist())) if known}
            keep = np.array(sorted(one.values()), dtype=np.int64)
            sub = np.concatenate([elements[first[i]:first[i + 1]] for i in keep]) if len(keep) else elements[:0]
            sub_first = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int64)
            who, sig, sketch = sketched_signatures(sub, sub_first, percent)
            # 48 bits are enough to propose a candidate, every candidate is verified
            sig = sig >> _U(16)
            order = np.argsort(sig)
            sig, who, sketch = sig[order], who[order], sketch[order]
            cut = np.searchsorted(shard_of(sig << _U(16), shards), np.arange(shards + 1))
            own = np.array(cls, dtype=np.int64)[keep]
            blobs, at = [], []
            for s in range(shards):
                if cut[s + 1] > cut[s]:
                    u, inv = np.unique(who[cut[s]:cut[s + 1]], return_inverse=True)
                    blobs.append(_join(pack(sig[cut[s]:cut[s + 1]], True), pack(inv.astype(np.uint32)), pack(own[u]), pack(size[keep][u]),
                                       pack(sketch[cut[s]:cut[s + 1]])))
                    at.append(s)
            z = len(at)
            yield pa.RecordBatch.from_arrays([null(z, pa.int64()), null(z, pa.int64()), null(z, pa.binary()), null(z, pa.int64()),
                                              pa.array(at, pa.int32()), pa.array(blobs, pa.binary())], names=_names(_SCAN))
    return narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text).mapInArrow(run, _SCAN)


def _names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    return out


_ROUTED = "doc_id long, n long, digest binary, cls long, a long, b long"


def chains(scan: DataFrame, percent: int, shards: int) -> DataFrame:
    """(a, b): classes that are candidates by a signature of the shard, as stars of
    the components they form there.  Document rows pass as they are, so one shuffle
    carries both and the packed signatures are never stored."""
    def route(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() < shards:
            pairs = run(table)  # at most a link per class
            blank = {c: pa.nulls(len(pairs), table.schema.field(c).type) for c in ("doc_id", "n", "digest", "cls")}
            return pa.table({**blank, "a": pairs["a"], "b": pairs["b"]})
        none = pa.nulls(len(table), pa.int64())
        return table.select(["doc_id", "n", "digest", "cls"]).append_column("a", none).append_column("b", none)

    def run(table: pa.Table) -> pa.Table:
        sig, cls, size, sketch = [], [], [], []
        for blob in table["blob"].to_pylist():
            s, i, c, n, k = _split(blob)
            i = unpack(i, np.uint32)
            sig.append(unpack(s, _U, True))
            cls.append(unpack(c, np.int64)[i])
            size.append(unpack(n, np.int64)[i])
            sketch.append(unpack(k, _U))
        a, b = candidate_components(*map(np.concatenate, (sig, cls, size, sketch)), percent)
        return pa.table({"a": a, "b": b})
    return scan.groupBy("shard").applyInArrow(route, _ROUTED)


class UnionFind:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def union(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        r = self.up
        while True:
            n = r[r]
            if (n == r).all():
                self.up = r.copy()
                return self.up
            r = n


class SignatureTree:
    """Levels of nodes over sets: OR-combined bitmaps, size ranges, surpluses."""

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets], dtype=np.int64)
        width = 1 << int(np.clip(np.ceil(np.log2(4 * max(int(size.max()), 16))), 8, 14))
        bits = np.zeros((len(sets), width // 64), dtype=_U)
        for i, s in enumerate(sets):
            h = s * _U(0x9E3779B97F4A7C15) >> _U(64 - int(np.log2(width)))
            np.bitwise_or.at(bits[i], (h >> _U(6)).astype(np.int64), _U(1) << (h & _U(63)))
        surplus = size - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        # neighbours in size and smallest element share a parent
        self.order = np.lexsort(([int(s[0]) for s in sets], [int(s[-1]) for s in sets], size))
        self.levels = [(bits[self.order], size[self.order], size[self.order], surplus[self.order])]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, sp = self.levels[-1]
            at = np.arange(0, len(b), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at),
                                np.maximum.reduceat(hi, at), np.maximum.reduceat(sp, at)))

    def possible(self, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Node pairs whose sets can overlap as much as a link needs."""
        b, lo, hi, sp = self.levels[level]
        small = np.maximum(np.minimum(lo[x], hi[x]), 0) + np.maximum(lo[y], 0)
        need = -(-percent * small // (100 + percent))
        ok = (100 * hi[x] >= percent * lo[y]) & (100 * hi[y] >= percent * lo[x]) & (np.minimum(hi[x], hi[y]) >= need)
        i = np.flatnonzero(ok)
        common = np.bitwise_count(b[x[i]] & b[y[i]]).sum(axis=1).astype(np.int64)
        ok[i] = common + np.minimum(sp[x[i]], sp[y[i]]) >= need[i]
        return ok


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have the similarity, exactly."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def join_block(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None,
               links: UnionFind | None = None) -> UnionFind:
    """Components of the link graph of ``sets``.  With ``side`` only sets of
    different sides need comparing; ``links`` are components known before."""
    uf = links or UnionFind(len(sets))
    if len(sets) < 2:
        return uf

    def test(pairs) -> None:
        for i, j in pairs:
            if uf.root(i) != uf.root(j) and linked(sets[i], sets[j], percent):
                uf.union(i, j)
    # near copies have smallest elements in common: neighbours in such orders first
    for salt in range(ORDERS if len(sets) > 3 else 0):
        low = [int((s * _U(2 * salt + 1) ^ _U(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)).min()) for s in sets]
        o = np.lexsort(([len(s) for s in sets], low)).tolist()
        test(zip(o, o[1:]))
    tree = SignatureTree(sets)
    stack = [(len(tree.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, x, y = stack.pop()
        if len(x) > 4096:  # a bounded frontier, and new links prune what waits
            h = len(x) // 2
            stack += [(level, x[h:], y[h:]), (level, x[:h], y[:h])]
            continue
        span = FANOUT ** level
        comp = uf.roots()[tree.order]
        edge = np.arange(0, len(sets), span)
        low, high = np.minimum.reduceat(comp, edge), np.maximum.reduceat(comp, edge)
        apart = ~((low[x] == high[x]) & (low[y] == high[y]) & (low[x] == low[y]))
        if side is not None:
            s = side[tree.order]
            a, b = np.minimum.reduceat(s, edge), np.maximum.reduceat(s, edge)
            apart &= ~((a[x] == b[x]) & (a[y] == b[y]) & (a[x] == a[y]))
        x, y = x[apart], y[apart]
        ok = tree.possible(level, x, y, percent)
        x, y = x[ok], y[ok]
        if not len(x):
            continue
        if level == 0:
            test(zip(tree.order[x].tolist(), tree.order[y].tolist()))
            continue
        n = len(tree.levels[level - 1][0])
        k = np.arange(FANOUT)
        cx = np.repeat(x[:, None] * FANOUT + k, FANOUT, axis=1).ravel()
        cy = np.tile(y[:, None] * FANOUT + k, (1, FANOUT)).ravel()
        same = np.repeat(x == y, FANOUT * FANOUT)
        fit = (cx < n) & (cy < n) & (~same | (cx < cy) | ((cx == cy) & (level > 1)))
        stack.append((level - 1, cx[fit], cy[fit]))
    return uf


def _block_links(percent: int, n: int, two_sided: bool):
    """Task function: rows (task, label, side, comp, doc_id, digest, text) to
    the links (a, b) of a spanning forest of each label's components.  A node is
    the smallest id of a class with the class, as an id may stand at two texts."""
    def run(table: pa.Table) -> pa.Table:
        sets = row_sets(table["text"], n)
        table = table.drop_columns("text")
        ids = list(zip(table["doc_id"].to_pylist(), map(class_key, table["digest"].to_pylist())))
        label, want = table["label"].to_pylist(), table["digest"].to_pylist()
        side, known = table["side"].to_numpy(), table["comp"].to_pylist()
        rows: dict[int, dict[tuple[int, int], int]] = {}
        for i, (l, d) in enumerate(zip(label, want)):
            if digest(sets[i]) == d:  # the other text of an id is not meant
                rows.setdefault(l, {}).setdefault(ids[i], i)
        a, b = [], []
        for own in rows.values():
            at = sorted(own.values(), key=lambda i: ids[i])
            uf = UnionFind(len(at))
            if two_sided:
                one: dict = {}
                for k, i in enumerate(at):
                    uf.union(one.setdefault(known[i], k), k)
            uf = join_block([sets[i] for i in at], percent, side[at] if two_sided else None, uf)
            for k, r in enumerate(uf.roots().tolist()):
                if r != k:
                    a.append(ids[at[k]])
                    b.append(ids[at[r]])
        node = pa.struct([("id", pa.int64()), ("cls", pa.int64())])
        return pa.table({k: pa.array([dict(id=i, cls=c) for i, c in v], node) for k, v in (("a", a), ("b", b))})
    return run


_LINKS = "a struct<id: long, cls: long>, b struct<id: long, cls: long>"


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                       percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) per row: the size of its
    set, the smallest id reachable by links, the smallest id with an equal set."""
    return _components(docs, doc_id, text, words, percent, block).select("doc_id", "n_shingles", "component_id", "class_id")


def _shards(docs: DataFrame, text: str) -> int:
    """As many hash shards as the texts' bytes ask for, at least as many as the
    session's shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`"))).alias("n")).first()["n"] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))


def _components(docs, doc_id, text, words, percent, block) -> DataFrame:
    """``jaccard_components`` with the digest of each row's set and whether the
    row is of the class its component is named after (``first``)."""
    shards = _shards(docs, text)
    routed = stored(chains(scan_documents(docs, doc_id, text, words, percent, shards), percent, shards), "scan")
    rows = routed.where("a is null").select("doc_id", "n", "digest", "cls")
    pairs = routed.where("a is not null").select("a", "b")
    classes = stored(rows.where("n > 0 and doc_id is not null").groupBy("digest")
                     .agg(F.min("doc_id").alias("class_id"), F.first("n").alias("n"), F.first("cls").alias("cls"),
                          F.count(F.lit(1)).alias("copies")), "classes")
    label = connected_components(pairs).select(F.col("node").alias("cls"), F.col("component").alias("label"))
    members = stored(classes.join(label, "cls").select("class_id", "digest", "cls", "n", "label"), "members")
    links = _member_links(docs, members, doc_id, text, words, percent, block)
    comp = connected_components(links).select(F.col("node.cls").alias("cls"), F.col("component.id").alias("comp"),
                                              (F.col("component.cls") == F.col("node.cls")).alias("first"))
    known = stored(classes.join(comp, "cls", "left").select("digest", "class_id", "copies", F.coalesce("comp", "class_id").alias("comp"),
                                                            F.coalesce("first", F.lit(True)).alias("first")), "known")
    # a class with more than a thousandth of all rows (fewer than a thousand are) meets its rows by a broadcast
    large = known.where(F.col("copies") * 1000 > max(rows.count(), 1000)).drop("copies")
    none, full = rows.where("n = 0"), rows.where("n > 0")
    plain = full.join(F.broadcast(large.select("digest")), "digest", "left_anti").join(known.drop("copies"), "digest", "left")
    both = plain.unionByName(full.join(F.broadcast(large), "digest"))
    own = F.col("doc_id").isNotNull()
    return (both.select("doc_id", "digest", F.col("n").alias("n_shingles"), F.when(own, F.col("comp")).alias("component_id"),
                        F.when(own, F.col("class_id")).alias("class_id"), F.coalesce("first", F.lit(True)).alias("first"))
            .unionByName(none.select("doc_id", "digest", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                     F.col("doc_id").alias("class_id"), F.lit(True).alias("first"))))


def _by_size(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Labels larger than a block fall into groups of two neighbouring size
    intervals: linked sets share a group, and a set is in two."""
    largest = members.agg(F.max("n").alias("n")).first()["n"] or 1
    low = F.array(*[F.lit(int(x)) for x in Intervals(percent, largest).low])
    own = F.size(F.filter(low, lambda t: t <= F.col("n"))) - 1
    total = members.groupBy("label").agg(F.sum("n").alias("total"))
    groups = F.when(F.col("total") > block, F.array(own, own - 1)).otherwise(F.array(F.lit(-1)))
    return (members.join(total, "label").withColumn("own", F.explode(groups))
            .withColumn("label", F.when(F.col("total") > block, F.xxhash64("label", "own")).otherwise(F.col("label")))
            .drop("total", "own"))


def _member_links(docs, members, doc_id, text, words, percent, block) -> DataFrame:
    """Links of a spanning forest between class representatives."""
    members = _by_size(members, percent, block)
    total = members.groupBy("label").agg(F.sum("n").alias("total"))
    members = members.join(total, "label").withColumn("cuts", F.ceil(F.col("total") / block).cast("int"))
    members = stored(members.withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("cuts")).cast("int")), "parts")
    whole = members.agg(F.sum("n").alias("n"), F.max("cuts").alias("cuts")).first()
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-8 * (whole["n"] or 0) // block))
    src = narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    held = join_small(src, members.withColumnRenamed("class_id", "doc_id"), "doc_id")
    columns = ["task", "label", "side", "comp", "doc_id", "digest", "text"]
    first = held.withColumn("task", F.pmod(F.xxhash64("label", "part"), F.lit(tasks))).withColumn("side", F.lit(0)).withColumn("comp", F.lit(0).cast("long"))
    links = stored(first.select(columns).groupBy("task").applyInArrow(_block_links(percent, words, False), _LINKS), "links")
    if (whole["cuts"] or 0) <= 1:
        return links
    cut = stored(_second_pass(held, links, block), "cut")
    more = stored(cut.select(columns).groupBy("task").applyInArrow(_block_links(percent, words, True), _LINKS), "more")
    return links.unionByName(more)


def _second_pass(held: DataFrame, links: DataFrame, block: int) -> DataFrame:
    """Rows of the labels cut in parts with the tasks of their second pass: the
    largest component against the rest, and the rest among itself.  Two rows of
    a label meet in a task on different sides unless the first pass has them in
    one part or both are of the largest component."""
    comp = connected_components(links).select(F.col("node.cls").alias("cls"), F.col("component.cls").alias("comp"))
    cut = held.where("cuts > 1").join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    counts = cut.groupBy("label", "comp").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("label").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"))
    cut = stored(cut.join(main, "label").withColumn("rest", F.col("comp") != F.col("main")), "rest")
    rest_cuts = cut.where("rest").groupBy("label").agg(F.ceil(F.sum("n") / block).cast("int").alias("rest_cuts"))
    cut = cut.join(rest_cuts, "label")
    me = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("rest_cuts")).cast("int")
    # a task is a part of the rest and any other part; the rest is copied to all parts it meets
    # a part of the rest that meets itself has the parts of the first pass as sides
    as_rest = (cut.where("rest").withColumn("p", me).withColumn("q", F.explode(F.expr("sequence(0, cuts + rest_cuts - 1)")))
               .withColumn("side", F.when(F.col("q") == F.col("cuts") + F.col("p"), F.col("part")).otherwise(0)))
    as_main = cut.where("not rest").withColumn("q", F.col("part")).withColumn("p", F.explode(F.expr("sequence(0, rest_cuts - 1)"))).withColumn("side", F.lit(1))
    rest_too = (cut.where("rest").withColumn("q", F.col("cuts") + me).withColumn("p", F.explode(F.expr("sequence(0, rest_cuts - 1)")))
                .where(F.col("p") < me).withColumn("side", F.lit(2)))
    both = as_rest.unionByName(as_main).unionByName(rest_too)
    return both.withColumn("task", F.xxhash64("label", "p", "q"))


def near_duplicate_survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5,
                             percent: int = 80) -> DataFrame:
    """The rows that stay when one document of each group of linked documents
    does: the smallest id (and of two texts with this id one); rows without words
    and rows with a null id stay, and rows that repeat the id and the set of the one
    that stays do.  A text is judged by its id and its set, so an id at two texts can
    lose one and keep the other.  All columns are returned."""
    comp = stored(_components(docs, doc_id, text, words, percent, BLOCK), "judged")
    stays = (F.col("doc_id") == F.col("component_id")) & F.col("first")
    gone = stored(comp.where("doc_id is not null").where(~stays).select(F.col("doc_id").alias("gone"), "digest").distinct(), "gone")
    several = stored(comp.where("doc_id is not null").groupBy(F.col("doc_id").alias("several")).agg(F.min("digest").alias("x"), F.max("digest").alias("y"))
                     .where("x <> y").select("several"), "several")
    key = docs[f"`{doc_id}`"]
    if several.isEmpty():  # the usual case: an id names a text
        return join_small(docs, gone, key == gone["gone"], "left_anti")
    once = join_small(join_small(docs, several, key == several["several"], "left_anti"), gone, key == gone["gone"], "left_anti")
    again = join_small(docs, several, key == several["several"], "left_semi")
    names, at = [f"c{i}" for i in range(len(docs.columns))], docs.columns.index(text)

    def run(batches):
        for b in batches:
            found = [digest(s) for s in row_sets(b.column(at), words)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], names=[*names, "digest"])
    plain = again.toDF(*names)
    held = plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("digest", T.BinaryType())]))
    same = (held[names[docs.columns.index(doc_id)]] == gone["gone"]) & (held["digest"] == gone["digest"])
    return once.unionByName(join_small(held, gone, same, "left_anti").select(*names).toDF(*docs.columns))
