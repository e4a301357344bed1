"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) and one end token per
text.  The model is a bigram model over add-one unigrams,

    p(w | h) = (c(h w) + k(h) p(w)) / (c(h) + k(h)),   p(w) = (c(w) + 1) / (N + V + 1),

with k(h) = c(h) ** ``CONCENTRATION``: frequent contexts see new successors more
often, but in falling proportion.  It sums to one for every h.  The log of a
text is a sum of three parts, log p(w), log of k / (c + k), and for bigrams seen
in training delta = log(1 + c(h w) / (k(h) p(w))), which is what the trie stores.
With ``order`` 3 the same step is taken once more over contexts of two words,

    p(w | g h) = (c(g h w) + k(g h) p(w | h)) / (c(g h) + k(g h)),

the second level's answers (count and quantised delta of every bigram) going back
to the chunks before they send their trigrams, whose contexts are the bigrams.

The corpus and the model are spread over hash shards, as many as the texts' bytes
ask for; no task holds the vocabulary or all bigrams.  Texts are packed in chunk rows.  Every chunk sends its
distinct words to the word shards and gets back id and count; with them it sums
the unigram parts and sends its distinct bigrams, with the texts they stand in, to
the bigram shards.  A shard merges the counts of all chunks, builds its part of
the trie (contexts, monotone pointers to their successors, successor ids made
monotone per context, all Elias-Fano coded, and 8-bit quantised deltas), finds
each chunk's bigrams by context and then among that context's successors, and
returns one sum per text.  Contexts more frequent than a quarter of a shard's share
(at most four per shard) are spread over all shards by successor.

What is gathered grows with the corpus; nothing is pruned.  Defined results:
null text is empty (one token, the end); a null flag does not train; without training
texts all counts are 0 and score equals the base; repeated rows are scored (and
counted) each; an empty table gives an empty result.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import Words, mix64, pack, shard_of, unpack
from lodestone.llm.chunks import CHUNK_BYTES, chunked, rows, shards_for, with_answers
from lodestone.llm.common import stored
from lodestone.llm.elias_fano import EliasFano

CONCENTRATION = 0.9
#: Text of all chunks per hash shard on average.
SHARD_BYTES = 16 << 20
_U = np.uint64
#: Ids: 0 is a word that training did not see, 1 the end of a text (and the
#: context of its first word), 2 and on the words.
END, FIRST_WORD = 1, 2
_SCALE = 64.0  # steps per factor of two of the weight sent with a bigram


class TrieLevel:
    """Bigrams of a shard: contexts, pointers, successors, quantised deltas."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, stride: int,
                 codes: np.ndarray, book: np.ndarray):
        self.contexts, self.pointers, self.successors = contexts, pointers, successors
        self.stride, self.codes, self.book = stride, codes, book

    @classmethod
    def build(cls, key: np.ndarray, delta: np.ndarray) -> "TrieLevel":
        """From ascending keys ``context << 32 | successor``."""
        return cls.build_pairs(key >> _U(32), key & _U(0xFFFFFFFF), delta)

    @classmethod
    def build_pairs(cls, ctx: np.ndarray, suc: np.ndarray, delta: np.ndarray) -> "TrieLevel":
        """From contexts and successors in ascending order."""
        head = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
        stride = int(suc.max()) + 1 if len(suc) else 1
        rank = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(ctx))))
        low, high = (float(delta.min()), float(delta.max())) if len(delta) else (0.0, 0.0)
        step = max((high - low) / 256, 1e-12)
        code = np.minimum((delta - low) / step, 255).astype(np.uint8)
        n = np.bincount(code, minlength=256)
        book = np.where(n > 0, np.bincount(code, weights=delta, minlength=256) / np.maximum(n, 1), low)
        return cls(EliasFano.build(ctx[head]), EliasFano.build(np.append(head, len(ctx)).astype(_U)),
                   EliasFano.build(rank.astype(_U) * _U(stride) + suc), stride, code, book)

    def to_bytes(self) -> bytes:
        head = np.array([self.stride, len(self.codes)], dtype="<i8").tobytes()
        return b"".join([head, self.book.astype("<f8").tobytes(), self.contexts.to_bytes(), self.pointers.to_bytes(),
                         self.successors.to_bytes(), self.codes.tobytes()])

    @classmethod
    def view(cls, buf) -> "TrieLevel":
        """The level over a buffer, without copying (``numpy.memmap`` will do)."""
        stride, n = (int(x) for x in np.frombuffer(buf, "<i8", 2))
        book = np.frombuffer(buf, "<f8", 256, 16)
        contexts, at = EliasFano.view(buf, 16 + 2048)
        pointers, at = EliasFano.view(buf, at)
        successors, at = EliasFano.view(buf, at)
        return cls(contexts, pointers, successors, stride, np.frombuffer(buf, np.uint8, n, at), book)

    def delta(self, key: np.ndarray) -> np.ndarray:
        """The stored delta of each ascending key, 0 where training had none."""
        at = self.places(key >> _U(32), key & _U(0xFFFFFFFF))
        return np.where(at >= 0, self.book[self.codes[np.maximum(at, 0)]], 0.0) if len(self.codes) else np.zeros(len(key))

    def places(self, ctx: np.ndarray, suc: np.ndarray) -> np.ndarray:
        """Where each pair, in ascending order, stands in the level; -1 where it
        does not: the context is looked up, then the successor among its own."""
        out = np.full(len(ctx), -1, dtype=np.int64)
        if not len(ctx) or not self.contexts.n:
            return out
        head = np.concatenate([[True], ctx[1:] != ctx[:-1]])
        at = self.contexts.find(ctx[head])
        known = np.maximum(at, 0)
        start = self.pointers.access(known).astype(np.int64)
        end = self.pointers.access(known + 1).astype(np.int64)
        which = np.cumsum(head) - 1
        ask = np.flatnonzero((at[which] >= 0) & (suc < _U(self.stride)))
        w = which[ask]
        out[ask] = self.successors.find(at[w].astype(_U) * _U(self.stride) + suc[ask], start[w], end[w])
        return out


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    return out


def _words(r: dict):
    """Word hashes of a chunk: (Words, distinct ascending, index of each word)."""
    w = Words(r["buf"], r["offs"])
    u, inv = np.unique(w.hash, return_inverse=True)
    return w, u, inv


def word_counts(chunks: DataFrame, shards: int) -> DataFrame:
    """(shard, chunk, blob): a chunk's distinct words and their training counts."""
    def run(batches):
        for b in batches:
            for r in rows(b):
                w, u, inv = _words(r)
                trains = np.array(r["flags"], dtype=bool)[w.docs()] if len(w.hash) else np.zeros(0, bool)
                count = np.bincount(inv[trains], minlength=len(u)).astype(np.uint32)
                cut = np.searchsorted(shard_of(u, shards), np.arange(shards + 1))
                own = [s for s in range(shards) if cut[s + 1] > cut[s]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([r["chunk"]] * len(own), pa.int64()),
                     pa.array([_join(pack(u[cut[s]:cut[s + 1]], True), pack(count[cut[s]:cut[s + 1]])) for s in own], pa.binary())],
                    names=["shard", "chunk", "blob"])
    return chunks.mapInArrow(run, "shard int, chunk long, blob binary")


def vocabulary(words: DataFrame) -> DataFrame:
    """(shard, chunk, blob, n, v): for every blob of words their rank in the
    shard and their count over all chunks; n and v, tokens and distinct words of the
    shard, stand in its first row."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_split(x) for x in table["blob"].to_pylist()]
        h = [unpack(p[0], _U, True) for p in parts]
        u, inv = np.unique(np.concatenate(h), return_inverse=True)
        count = np.bincount(inv, weights=np.concatenate([unpack(p[1], np.uint32) for p in parts]), minlength=len(u)).astype(np.int64)
        rank = np.where(count > 0, np.cumsum(count > 0), 0).astype(np.uint32)  # 1 and on; 0: not in training
        at, out = 0, []
        for x in h:
            i = inv[at:at + len(x)]
            out.append(_join(pack(rank[i]), pack(count[i].astype(_U))))
            at += len(x)
        first = np.arange(len(out)) == 0
        return pa.table({"shard": table["shard"], "chunk": table["chunk"], "blob": pa.array(out, pa.binary()),
                         "n": pa.array(np.where(first, count.sum(), 0), pa.int64()),
                         "v": pa.array(np.where(first, (count > 0).sum(), 0), pa.int64())})
    return words.groupBy("shard").applyInArrow(run, "shard int, chunk long, blob binary, n long, v long")


_TEXTS = "chunk long, shard int, blob binary, doc_ids array<long>, n_tokens array<long>, n_known array<long>, base array<double>, part array<double>"


def _stream(r: dict, shards: int, offset: np.ndarray, n: int, v: int, ends: int, concentration: float) -> SimpleNamespace:
    """The tokens of a chunk with the word shards' answers: ids, counts, the
    context of each and its share for what the context has not seen."""
    floor = float(n + v + 1)
    w, u, inv = _words(r)
    got = [_split(a["blob"]) for a in r["answers"] or []]
    shard = shard_of(u, shards)
    rank = np.concatenate([unpack(g[0], np.uint32) for g in got]).astype(np.int64) if got else np.zeros(0, np.int64)
    count = np.concatenate([unpack(g[1], _U) for g in got]).astype(np.int64) if got else np.zeros(0, np.int64)
    ident = np.where(rank > 0, offset[shard] + rank - 1 + FIRST_WORD, 0) if len(u) else rank
    m = len(r["offs"]) - 1
    size = np.diff(w.first)
    # one stream of tokens: the words of each text and its end
    slot = np.arange(len(w.hash)) + w.docs()
    stop = w.first[1:] + np.arange(m)
    token = np.empty(len(w.hash) + m, dtype=np.int64)
    seen = np.empty(len(token), dtype=np.int64)
    token[slot], token[stop] = ident[inv], END if ends else 0
    seen[slot], seen[stop] = count[inv], ends
    doc = np.repeat(np.arange(m), size + 1)
    context = np.empty_like(token)
    context[1:] = token[:-1]
    weight = np.empty_like(seen)
    weight[1:] = seen[:-1]
    begin = stop - size
    context[begin], weight[begin] = END if ends else 0, ends  # a text starts after an end
    p = (seen + 1) / floor
    k = np.where(weight > 0, weight, 1) ** concentration
    back = np.where(weight > 0, k / (weight + k), 1.0)
    return SimpleNamespace(m=m, size=size, token=token, seen=seen, doc=doc, context=context, weight=weight, begin=begin, p=p, k=k, back=back,
                           trains=np.array(r["flags"], dtype=bool))


def _distinct(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each run of equal rows, length of each run) of sorted columns."""
    new = np.concatenate([[True], (a[..., 1:] != a[..., :-1]).any(axis=0)]) if a.shape[-1] else np.zeros(0, bool)
    head = np.flatnonzero(new)
    return head, np.diff(np.append(head, a.shape[-1])).astype(np.uint32)


def _weight_code(share: np.ndarray) -> np.ndarray:
    """The weight that a count is held against, as a rounded logarithm."""
    return np.clip(np.rint((np.log2(share) + 40) * _SCALE), 0, 65535).astype(np.uint16)


def _bigrams(s: SimpleNamespace, shards: int, n: int) -> SimpleNamespace:
    """The distinct bigrams of a chunk, ascending, by shard; ``pair`` are the
    tokens in their order."""
    pair = np.flatnonzero((s.token > 0) & (s.context > 0))
    key = s.context[pair].astype(_U) << _U(32) | s.token[pair].astype(_U)
    by = np.argsort(key, kind="stable")
    key, pair = key[by], pair[by]
    head, times = _distinct(key[None])
    trained = np.add.reduceat(s.trains[s.doc[pair]], head, dtype=np.uint32) if len(head) else np.zeros(0, np.uint32)
    key, one = key[head], pair[head]
    x = _weight_code(s.k[one] * s.p[one])
    hot = s.weight[one] * 4 * shards > n
    to = shard_of(mix64(np.where(hot, key, key >> _U(32))), shards)
    order = np.argsort(to, kind="stable")
    return SimpleNamespace(pair=pair, head=head, times=times, trained=trained, key=key, x=x, order=order,
                           cut=np.searchsorted(to[order], np.arange(shards + 1)))


def _names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _text_row(r: dict, s: SimpleNamespace, shards: int, base: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """The sums per text that need no shard, addressed to shards of their own
    (``shards`` and on)."""
    known = np.bincount(s.doc, weights=s.seen > 0, minlength=s.m).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array([r["chunk"]], pa.int64()), pa.array([shards + r["chunk"] % shards], pa.int32()), pa.nulls(1, pa.binary()),
         pa.array([r["doc_ids"]], pa.list_(pa.int64())), pa.array([s.size + 1], pa.list_(pa.int64())), pa.array([known], pa.list_(pa.int64())),
         pa.array([base], pa.list_(pa.float64())), pa.array([part], pa.list_(pa.float64()))], names=_names(_TEXTS))


def _blob_rows(r: dict, own: list[int], blobs: list[bytes]) -> pa.RecordBatch:
    z = len(own)
    return pa.RecordBatch.from_arrays(
        [pa.array([r["chunk"]] * z, pa.int64()), pa.array(own, pa.int32()), pa.array(blobs, pa.binary()),
         *[pa.nulls(z, pa.list_(t)) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]], names=_names(_TEXTS))


def _texts_of(i: np.ndarray, start: np.ndarray, times: np.ndarray, docs: np.ndarray, m: int) -> list[bytes]:
    """The texts in which some n-grams stand, packed."""
    t = times[i].astype(np.int64)
    first = np.cumsum(t) - t
    at = np.arange(int(t.sum())) + np.repeat(start[i] - first, t)
    return [pack(times[i]), pack(docs[at]), np.array([m, docs.dtype.itemsize], "<i8").tobytes()]


def _chunk_sums(shards: int, offset: list[int], n: int, v: int, ends: int, concentration: float):
    """Task function over chunks with the word shards' answers: the unigram
    parts per text and the bigrams, with the texts they stand in, per shard."""
    offset = np.array(offset, dtype=np.int64)

    def run(batches):
        for b in batches:
            for r in rows(b):
                s = _stream(r, shards, offset, n, v, ends, concentration)
                base = np.bincount(s.doc, weights=np.log10(s.p), minlength=s.m)
                yield _text_row(r, s, shards, base, base + np.bincount(s.doc, weights=np.log10(s.back), minlength=s.m))
                g = _bigrams(s, shards, n)
                docs = s.doc[g.pair].astype(np.uint16 if s.m < 65536 else np.uint32)
                own, blobs = [], []
                for k in range(shards):
                    i = g.order[g.cut[k]:g.cut[k + 1]]
                    if len(i):
                        own.append(k)
                        blobs.append(_join(pack(g.key[i], True), pack(g.trained[i]), pack(g.x[i]), *_texts_of(i, g.head, g.times, docs, s.m)))
                yield _blob_rows(r, own, blobs)
    return run


def _chunk_bigrams(shards: int, offset: list[int], n: int, v: int, ends: int, concentration: float):
    """Task function over chunks with the word shards' answers: the distinct
    bigrams per shard (what a third level asks of the second)."""
    offset = np.array(offset, dtype=np.int64)

    def run(batches):
        for b in batches:
            for r in rows(b):
                g = _bigrams(_stream(r, shards, offset, n, v, ends, concentration), shards, n)
                own = [k for k in range(shards) if g.cut[k + 1] > g.cut[k]]
                part = [g.order[g.cut[k]:g.cut[k + 1]] for k in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array([r["chunk"]] * len(own), pa.int64()),
                     pa.array([_join(pack(g.key[i], True), pack(g.trained[i]), pack(g.x[i])) for i in part], pa.binary())],
                    names=["shard", "chunk", "blob"])
    return run


def bigram_answers(sent: DataFrame) -> DataFrame:
    """(shard, chunk, blob): for every blob of bigrams their count over all
    chunks and the quantised delta of the shard's trie level."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_split(x) for x in table["blob"].to_pylist()]
        keys = [unpack(p[0], _U, True) for p in parts]
        u, inv = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(inv, weights=np.concatenate([unpack(p[1], np.uint32) for p in parts]), minlength=len(u)).astype(np.int64)
        x = np.empty(len(u), np.uint16)
        x[inv] = np.concatenate([unpack(p[2], np.uint16) for p in parts])
        seen = count > 0
        trie = TrieLevel.view(TrieLevel.build(u[seen], np.log10(1 + count[seen] / np.exp2(x[seen] / _SCALE - 40))).to_bytes())
        out, at = [], 0
        for k in keys:
            i = trie.places(k >> _U(32), k & _U(0xFFFFFFFF))
            code = np.where(i >= 0, trie.codes[np.maximum(i, 0)], 0) if len(trie.codes) else np.zeros(len(k))
            out.append(_join(pack(count[inv[at:at + len(k)]].astype(np.uint32)), pack(code.astype(np.uint8)), trie.book.tobytes()))
            at += len(k)
        return pa.table({"shard": table["shard"], "chunk": table["chunk"], "blob": pa.array(out, pa.binary())})
    return sent.groupBy("shard").applyInArrow(run, "shard int, chunk long, blob binary")


def _chunk_trigrams(shards: int, offset: list[int], n: int, v: int, ends: int, concentration: float):
    """Task function over chunks with the answers of the word and the bigram
    shards: the parts of both orders per text, and the trigrams per shard."""
    offset = np.array(offset, dtype=np.int64)

    def run(batches):
        for b in batches:
            for r in rows(b):
                s = _stream(r, shards, offset, n, v, ends, concentration)
                g = _bigrams(s, shards, n)
                got = [_split(a["blob"]) for a in r["bigrams"] or []]
                count, delta = np.zeros(len(g.key), np.int64), np.zeros(len(g.key))
                if got:
                    count[g.order] = np.concatenate([unpack(x[0], np.uint32) for x in got])
                    delta[g.order] = np.concatenate([np.frombuffer(x[2])[unpack(x[1], np.uint8)] for x in got])
                    delta[count == 0] = 0
                which = np.full(len(s.token), -1)
                which[g.pair] = np.repeat(np.arange(len(g.key)), g.times)
                low = np.log10(s.p) + np.log10(s.back) + np.where(which >= 0, np.append(delta, 0)[which], 0)
                # the context of order 3: the bigram that ends before this token, in the same text
                last = np.full(len(s.token), -1)
                last[1:] = which[:-1]
                last[s.begin] = -1
                c = np.where(last >= 0, np.append(count, 0)[last], 0)
                k = np.where(c > 0, c, 1) ** concentration
                back = np.where(c > 0, k / (c + k), 1.0)
                base = np.bincount(s.doc, weights=np.log10(s.p), minlength=s.m)
                yield _text_row(r, s, shards, base, np.bincount(s.doc, weights=low + np.log10(back), minlength=s.m))
                at = np.flatnonzero((c > 0) & (s.token > 0))
                ctx, suc = g.key[last[at]] if len(at) else np.zeros(0, _U), s.token[at].astype(_U)
                by = np.lexsort((suc, ctx))
                at, ctx, suc = at[by], ctx[by], suc[by]
                head, times = _distinct(np.stack([ctx, suc]))
                docs = s.doc[at].astype(np.uint16 if s.m < 65536 else np.uint32)
                trained = np.add.reduceat(s.trains[s.doc[at]], head, dtype=np.uint32) if len(head) else np.zeros(0, np.uint32)
                one, ctx, suc = at[head], ctx[head], suc[head]
                x = _weight_code(k[one] * 10.0 ** low[one])
                hot = c[one] * 4 * shards > n
                to = shard_of(mix64(np.where(hot, ctx ^ mix64(suc), ctx)), shards)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(shards + 1))
                own, blobs = [], []
                for z in range(shards):
                    i = order[cut[z]:cut[z + 1]]
                    if len(i):
                        own.append(z)
                        blobs.append(_join(pack(ctx[i], True), pack(trained[i]), pack(x[i]), *_texts_of(i, head, times, docs, s.m),
                                           pack(suc[i].astype(np.uint32))))
                yield _blob_rows(r, own, blobs)
    return run


def last_shards(sent: DataFrame, shards: int, order: int, keep_levels: bool = False) -> DataFrame:
    """(chunk, blob): per chunk the sum of the deltas of each of its texts in
    this shard of the last level; the parts of lower orders pass as they are, so one
    shuffle carries both; with ``keep_levels`` also the shard's trie level (chunk null)."""
    def route(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() >= shards:
            return table.drop_columns("shard")
        out = run(table)
        for name in table.column_names[3:]:
            out = out.append_column(name, pa.nulls(len(out), table.schema.field(name).type))
        return out

    def run(table: pa.Table) -> pa.Table:
        parts = [_split(x) for x in table["blob"].to_pylist()]
        keys = [unpack(p[0], _U, True) for p in parts]
        if order == 2:
            pairs = [(k >> _U(32), k & _U(0xFFFFFFFF)) for k in keys]
        else:
            pairs = [(k, unpack(p[6], np.uint32).astype(_U)) for k, p in zip(keys, parts)]
        ctx, suc = (np.concatenate(c) for c in zip(*pairs))
        by = np.lexsort((suc, ctx))
        ctx, suc = ctx[by], suc[by]
        head, _ = _distinct(np.stack([ctx, suc]))
        count = np.add.reduceat(np.concatenate([unpack(p[1], np.uint32) for p in parts])[by], head, dtype=np.int64)
        x = np.concatenate([unpack(p[2], np.uint16) for p in parts])[by][head]
        seen = count > 0
        delta = np.log10(1 + count[seen] / np.exp2(x[seen] / _SCALE - 40))
        level = TrieLevel.build_pairs(ctx[head][seen], suc[head][seen], delta).to_bytes()
        trie = TrieLevel.view(level)
        chunk, out = table["chunk"].to_pylist(), []
        for (a, b), p in zip(pairs, parts):
            m, width = (int(v) for v in np.frombuffer(p[5], "<i8"))
            docs = unpack(p[4], np.uint16 if width == 2 else np.uint32)
            at = trie.places(a, b)
            d = np.where(at >= 0, trie.book[trie.codes[np.maximum(at, 0)]], 0.0) if len(trie.codes) else np.zeros(len(at))
            d = np.repeat(d, unpack(p[3], np.uint32))
            out.append(np.bincount(docs, weights=d, minlength=m).tobytes())
        if keep_levels:
            chunk.append(None)
            out.append(level)
        return pa.table({"chunk": pa.array(chunk, pa.int64()), "blob": pa.array(out, pa.binary())})
    return sent.groupBy("shard").applyInArrow(route, _TEXTS.replace("shard int, ", ""))


def corpus_scores(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
                  concentration: float = CONCENTRATION, levels_to: str | None = None, order: int = 2) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row,
    learning from the rows where ``train`` holds, with contexts of up to
    ``order`` - 1 words (2 or 3).  ``levels_to`` names a folder for the trie's
    last level (Parquet rows of one binary level per shard)."""
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    chunks = chunked(docs, doc_id, text, train)
    shards = shards_for(chunks, CHUNK_BYTES, SHARD_BYTES)
    ends = chunks.agg(F.sum(F.size(F.filter("flags", lambda f: f))).alias("n")).first()["n"] or 0
    answers = stored(vocabulary(word_counts(chunks, shards)), "vocabulary")
    per = {r["shard"]: (r["n"], r["v"]) for r in answers.groupBy("shard").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    offset, total = [], 0  # a row per shard
    for s in range(shards):
        offset.append(total)
        total += per.get(s, (0, 0))[1]
    if total + FIRST_WORD >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")
    n = sum(x for x, _ in per.values()) + ends
    v = total + (1 if ends else 0)
    ready = with_answers(chunks, answers.select("chunk", "shard", "blob"))
    about = (shards, offset, n, v, ends, concentration)
    if order == 2:
        sent = ready.mapInArrow(_chunk_sums(*about), _TEXTS)
    else:
        asked = ready.mapInArrow(_chunk_bigrams(*about), "shard int, chunk long, blob binary")
        told = stored(bigram_answers(asked), "bigrams")
        sent = with_answers(ready, told, "bigrams").mapInArrow(_chunk_trigrams(*about), _TEXTS)
    back = stored(last_shards(sent, shards, order, levels_to is not None), "sums")
    if levels_to is not None:
        back.where("chunk is null").select("blob").write.parquet(levels_to)
    gathered = back.where("chunk is not null and blob is not null").groupBy("chunk").agg(F.collect_list("blob").alias("blobs"))
    texts = back.where("blob is null").drop("blob").join(gathered, "chunk", "left")

    def finish(batches):
        for b in batches:
            for r in b.to_pylist():  # a row per chunk
                s = np.array(r["part"])
                for x in r["blobs"] or []:
                    s = s + np.frombuffer(x, np.float64)
                m = len(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["n_tokens"], pa.int64()), pa.array(r["n_known"], pa.int64()),
                     pa.array([n] * m, pa.int64()), pa.array(r["base"], pa.float64()), pa.array(s)],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return texts.select("doc_ids", "n_tokens", "n_known", "base", "part", "blobs").mapInArrow(
        finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
