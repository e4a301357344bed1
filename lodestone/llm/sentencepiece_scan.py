"""SentencePiece encoding by merges or as a max-plus product, and decoding.

The pieces and scores are those of a SentencePiece model.  A model of merges
(its type is BPE) is segmented in merge order, by the library, stretch by
stretch; giant documents are split at cuts that no piece contains, so ids are
the library's.  For any other model the segmentation is
the one with the largest sum of piece scores (ties: the earlier, longer piece,
as in a left-to-right Viterbi pass).  Spaces become the mark U+2581, one mark is put
in front, unknown characters fall back to byte pieces.

No piece has the mark after another character, so every mark that follows
another character is a cut all segmentations share.  Between cuts, all distinct
stretches of a batch run through one vectorised Viterbi pass side by side (or
through the merges), and a worker remembers what it has seen.

Without merges, giant documents (more than ``CHUNK`` characters) are split into chunks that are
rows of their own.  A chunk's state is how many characters a piece reaches
beyond its edge (0 .. K - 1, K the longest piece).  Its transfer matrix, the best score
from every entering to every leaving state, is computed on its own;
matrices combine associatively under max-plus, a parallel scan over them
gives the scores with which every chunk is entered; with these each chunk finds
for every leaving state the entering state it comes from, and, once the chain of
states is known, traces its own pieces back independently.

Defined results: null and empty texts have no ids; a literal U+2581 is kept as
byte pieces, so decoding is exact; repeated rows are encoded each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrays import Remembered, ragged, slices, text_buffer, worker_cache
from lodestone.llm.common import narrow, stored

MARK = 0x2581
LITERAL = 0x110000 + MARK  # a mark that was in the text
CHUNK = 1 << 16
GROUP_BYTES = 1 << 20
GROUP_IDS = 200_000
REMEMBERED = 300_000
NONE = -np.inf
_UNKNOWN_PENALTY = 10.0
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 19


def load_pieces(path: str) -> tuple[list[str], list[float], list[int], int]:
    """(pieces, scores, byte value or -1 or -2 for pieces that text never
    becomes, unknown id) of a model file; bounded by its vocabulary."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    kind = [int(pieces[i][3:5], 16) if sp.is_byte(i) else -2 if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else -1
            for i in range(n)]
    return pieces, [sp.get_score(i) for i in range(n)], kind, sp.unk_id()


def merge_model(path: str) -> bytes | None:
    """A model of merges without the mark it puts in front (``code_points``
    does that), None for other models."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    if m.trainer_spec.model_type != pb.TrainerSpec.BPE:
        return None
    m.normalizer_spec.add_dummy_prefix = False
    return m.SerializeToString()


def char_codes(cp: np.ndarray) -> np.ndarray:
    return (cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def maxplus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of (stacks of) matrices."""
    return (a[..., :, :, None] + b[..., None, :, :]).max(axis=-2)


def scan(mats: np.ndarray) -> np.ndarray:
    """Inclusive max-plus prefix products in log2(n) parallel steps."""
    out, step = mats.copy(), 1
    while step < len(out):
        nxt = out.copy()
        for at in range(step, len(out), 4096):
            to = min(at + 4096, len(out))
            nxt[at:to] = maxplus(out[at - step:to - step], out[at:to])
        out, step = nxt, 2 * step
    return out


class Encoder:
    """Pieces as a hash table of all their prefixes, and the Viterbi pass."""

    def __init__(self, pieces, scores, kind, unknown, merges: bytes | None = None):
        self.merges = None
        if merges is not None:
            import sentencepiece
            self.merges = sentencepiece.SentencePieceProcessor(model_proto=merges)
            inside = {(ord(a), ord(b)) for p, k in zip(pieces, kind) if k == -1 for a, b in zip(p, p[1:])}
            self.pairs = np.sort(np.array([a << 32 | b for a, b in inside], dtype=np.uint64))
            self.known = {ord(c) for p, k in zip(pieces, kind) if k == -1 for c in p}
        self.unknown = unknown
        self.byte = np.full(256, unknown, dtype=np.int32)
        prefixes: dict[str, int] = {}
        self.scores = np.array(scores, dtype=np.float64)
        normal = [i for i, k in enumerate(kind) if k == -1]
        for i, k in enumerate(kind):
            if k >= 0:
                self.byte[k] = i
        for i in normal:
            p = pieces[i]
            for n in range(1, len(p)):
                prefixes.setdefault(p[:n], -1)
            prefixes[p] = i
        for i in normal:
            body = pieces[i].lstrip(chr(MARK))
            if chr(MARK) in body:
                raise ValueError("a piece has the space mark after another character")
        self.longest = max((len(pieces[i]) for i in normal), default=1)
        self.low = float(min((scores[i] for i in normal), default=0.0)) - _UNKNOWN_PENALTY
        keys, ids = [], []
        for p, i in prefixes.items():
            h = 0
            for c in char_codes(np.frombuffer(p.encode("utf-32-le"), "<u4")).tolist():
                h = (h * int(_MUL) + c) & 0xFFFFFFFFFFFFFFFF
            keys.append(h)
            ids.append(i)
        keys = np.array(keys, dtype=np.uint64)
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys = np.append(keys[order], np.uint64(0))
        self.ids = np.append(np.array(ids, dtype=np.int32)[order], np.int32(-1))
        self.first = np.searchsorted(slot[order], np.arange((1 << _SLOT_BITS) + 1)).astype(np.int32)
        self.deep = int(np.diff(self.first).max(initial=0))
        text = [b"" if k == -2 else bytes([k]) if k >= 0 else p.replace(chr(MARK), " ").encode() for p, k in zip(pieces, kind)]
        self.size = np.array([len(t) for t in text], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(text), np.uint8)
        #: what an id adds to the score of a path (a byte piece: the first byte of its character)
        self.worth = self.scores.copy()
        for i, k in enumerate(kind):
            if k >= 0:
                self.worth[i] = 0.0 if k & 0xC0 == 0x80 else self.low
        self.held = Remembered(np.int32, REMEMBERED)

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash in the prefix table, -1 where it is no prefix."""
        slot = self._slot(h)
        at, end = self.first[slot], self.first[slot + 1]
        hit = (self.keys[at] == h) & (at < end)
        out = np.where(hit, at, -1)
        rest = np.flatnonzero(~hit & (end - at > 1))
        for k in range(1, self.deep):
            if not len(rest):
                break
            p = at[rest] + k
            ok = (p < end[rest]) & (self.keys[np.minimum(p, len(self.keys) - 1)] == h[rest])
            out[rest[ok]] = p[ok]
            rest = rest[~ok & (end[rest] - at[rest] > k + 1)]
        return out

    def viterbi(self, chars: np.ndarray, length: np.ndarray, stop: np.ndarray, enter: np.ndarray | None = None):
        """Best scores over ``chars[position, row]``; pieces start before
        ``stop``.  ``enter[state, row]`` are the scores of the first positions
        (only position 0 by default).  Returns (best, back, piece), each
        [position, row]; back is the piece length, 0 at an entry."""
        top, n = chars.shape
        best = np.full((top + 1, n), NONE)
        back = np.zeros((top + 1, n), dtype=np.uint8)
        pid = np.zeros((top + 1, n), dtype=np.int32)
        if enter is None:
            best[0] = 0.0
        else:
            k = min(len(enter), top + 1)
            best[:k] = enter[:k]
        code = char_codes(chars)
        for s in range(int(stop.max(initial=0))):
            act = np.flatnonzero((stop > s) & (best[s] > NONE))
            if not len(act):
                continue
            base = best[s][act]
            h = np.zeros(len(act), dtype=np.uint64)
            for l in range(1, self.longest + 1):
                e = s + l
                if l > 1:
                    fits = length[act] >= e
                    if not fits.all():
                        act, base, h = act[fits], base[fits], h[fits]
                    if not len(act):
                        break
                h = h * _MUL + code[e - 1][act]
                idx = self.find(h)
                p = np.where(idx >= 0, self.ids[idx], -1)
                if l == 1:
                    rows, cand = act, base + np.where(p >= 0, self.scores[p], self.low)
                    what = np.where(p >= 0, p, -2 - chars[s][act].astype(np.int64)).astype(np.int32)
                else:
                    has = np.flatnonzero(p >= 0)
                    rows, what = act[has], p[has]
                    cand = base[has] + self.scores[what]
                up = cand > best[e][rows]
                rows = rows[up]
                best[e][rows] = cand[up]
                back[e][rows] = l
                pid[e][rows] = what[up]
                go = idx >= 0
                act, base, h = act[go], base[go], h[go]
                if not len(act):
                    break
        return best, back, pid

    def trace(self, back: np.ndarray, pid: np.ndarray, end: np.ndarray):
        """(ids of all rows in order, number per row, entry position per row)
        of the paths that end at ``end``."""
        n = len(end)
        pos, col = end.copy(), np.arange(n)
        steps = []
        while len(col):
            b = back[pos[col], col]
            col = col[b > 0]
            if not len(col):
                break
            steps.append((col, pid[pos[col], col]))
            pos[col] -= back[pos[col], col]
        count = np.zeros(n, dtype=np.int64)
        for c, _ in steps:
            count[c] += 1
        first = np.cumsum(count) - count
        out = np.empty(int(count.sum()), dtype=np.int32)
        for t, (c, p) in enumerate(steps):
            out[first[c] + count[c] - 1 - t] = p
        return out, count, pos

    def to_bytes(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters (-2 - code point) replaced by byte pieces."""
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids, count
        size = np.ones(len(ids), dtype=np.int64)
        raw = [(chr(c - 0x110000) if c > 0x10FFFF else chr(c)).encode("utf-8", "surrogatepass")
               for c in (-2 - ids[odd].astype(np.int64)).tolist()]
        size[odd] = [len(r) for r in raw]
        out = np.empty(int(size.sum()), dtype=np.int32)
        to = np.cumsum(size) - size
        out[to[ids >= 0]] = ids[ids >= 0]
        out[ragged(to[odd], size[odd])] = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        row = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(row, weights=size, minlength=len(count)).astype(np.int64)

    def stretches(self, cp: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of stretches between cuts, each distinct one
        segmented once per worker."""
        raw = np.ascontiguousarray(cp, "<u4").view(np.uint8)
        at = self.held.resolve(raw, 4 * starts, 4 * lens, lambda i: self.segment(cp, starts[i], lens[i])[::-1])
        size = self.held.size[at]
        return self.held.flat[ragged(self.held.at[at], size)], size

    def segment(self, cp: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over the given stretches, side by side in order of length."""
        if self.merges is not None:
            return self.merged(cp, starts, lens)
        order = np.argsort(lens, kind="stable")
        parts, counts = [], np.zeros(len(starts), dtype=np.int64)
        a = 0
        while a < len(order):
            b = a + 1
            z = min(len(order), a + 400_000 // max(1, int(lens[order[a]])))
            while b < z and int(lens[order[b]]) * (b + 1 - a) <= 400_000 and int(lens[order[b]]) <= 2 * int(lens[order[a]]) + 4:
                b = min(z, b + 256)
                if int(lens[order[b - 1]]) * (b - a) > 400_000:
                    break
            rows = order[a:b]
            w = lens[rows]
            chars = np.zeros((int(w.max()), len(rows)), dtype=np.uint32)
            col = np.repeat(np.arange(len(rows)), w)
            idx = ragged(starts[rows], w)
            chars[idx - np.repeat(starts[rows], w), col] = cp[idx]
            _, back, pid = self.viterbi(chars, w, w)
            ids, count, _ = self.trace(back, pid, w.copy())
            ids, count = self.to_bytes(ids, count)
            parts.append(ids)
            counts[rows] = count
            a = b
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        by_order = counts[order]
        at = np.empty(len(order), dtype=np.int64)
        at[order] = np.cumsum(by_order) - by_order
        return flat[ragged(at, counts)], counts

    def merged(self, cp: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The given stretches in the merge order of the model."""
        literal, stand = cp == LITERAL, 0
        if literal.any():  # an unknown character in place of literal marks
            used = self.known | set(np.unique(cp).tolist())
            stand = next(c for c in range(0x10FFFD, 0xFFFFF, -1) if c not in used)
            cp = np.where(literal, np.uint32(stand), cp)
        text = cp.astype("<u4").tobytes().decode("utf-32-le")
        old, new = ([int(self.byte[b]) for b in chr(c).encode()] if stand else [] for c in (stand, MARK))
        flat, count = [], []
        for a in range(0, len(starts), 16_384):  # the library's answers are lists: a few at a time
            got = self.merges.encode([text[s:s + w] for s, w in zip(starts[a:a + 16_384].tolist(), lens[a:a + 16_384].tolist())], num_threads=1)
            for i, ids in enumerate(got if stand else ()):
                for j in reversed([j for j in range(len(ids)) if ids[j:j + len(old)] == old]):
                    ids[j:j + len(old)] = new
            n = np.array([len(g) for g in got], dtype=np.int64)
            count.append(n)
            flat.append(np.fromiter((i for g in got for i in g), np.int32, int(n.sum())))
        return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), (np.concatenate(count) if count else np.zeros(0, np.int64))

    def safe_parts(self, cp: np.ndarray, chunk: int) -> list[tuple[int, int]]:
        """Parts of a text of at most ``chunk`` characters (more where it has
        no cut) between characters that no piece has side by side."""
        pair = cp[:-1].astype(np.uint64) << np.uint64(32) | cp[1:].astype(np.uint64)
        apart = np.flatnonzero(~np.isin(pair, self.pairs)) + 1
        safe = np.union1d(apart, cuts(cp, np.array([0, len(cp)])))
        out, a = [], 0
        while len(cp) - a > chunk:
            i = int(np.searchsorted(safe, a + chunk, side="right"))
            z = int(safe[i - 1]) if i and safe[i - 1] > a else int(safe[i]) if i < len(safe) else len(cp)
            out.append((a, z))
            a = z
        return out + [(a, len(cp))] if a < len(cp) else out

    def batch(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number per text)."""
        n, ids, counts = len(offs) - 1, [], []
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + GROUP_BYTES, side="right")) - 1)
            j = min(j, n)
            cp, at = code_points(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], mark=True)
            starts = cuts(cp, at)
            out, size = self.stretches(cp, starts, np.diff(starts, append=len(cp)))
            doc = np.searchsorted(at, starts, side="right") - 1
            ids.append(out)
            counts.append(np.bincount(doc, weights=size, minlength=j - i).astype(np.int64))
            i = j
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32),
                np.concatenate(counts) if counts else np.zeros(0, np.int64))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, bytes per text); the mark in front goes."""
        size = self.size[ids]
        raw = self.bytes[ragged(self.at[ids], size)]
        row = np.repeat(np.arange(len(counts)), counts)
        n = np.bincount(row, weights=size, minlength=len(counts)).astype(np.int64)
        first = np.cumsum(n) - n
        keep = np.ones(len(raw), dtype=bool)
        keep[first[n > 0]] = raw[first[n > 0]] != 32
        dropped = np.zeros(len(counts), dtype=np.int64)
        dropped[n > 0] = ~keep[first[n > 0]]
        return raw[keep], n - dropped

    # giant documents -----------------------------------------------------

    def chunk_cuts(self, cp: np.ndarray, n: int) -> np.ndarray:
        """Cuts after the first character of a chunk of ``n`` characters."""
        is_mark = cp == MARK
        cut = np.flatnonzero(is_mark[1:] & ~is_mark[:-1]) + 1
        return cut[cut <= n] if len(cp) > n else cut[cut < n]

    def transfer(self, cp: np.ndarray, n: int) -> np.ndarray:
        """Transfer matrix of a chunk of ``n`` characters followed by up to
        K - 1 characters of its successor in ``cp``.  Through a cut all paths
        go together, so with cuts it is a column plus a number plus a row."""
        k = self.longest
        cut = self.chunk_cuts(cp, n)
        out = np.full((k, k), NONE)
        if not len(cut):
            for i in range(min(k, n + 1)):
                out[i] = self._leave(cp[i:], n - i)
            for i in range(n + 1, k):  # a piece across a chunk shorter than it
                out[i, i - n] = 0.0
            return out
        f, g = int(cut[0]), int(cut[-1])
        head = np.full(k, NONE)
        for i in range(min(k, f + 1)):
            head[i] = self._leave(cp[i:f], f - i)[0]
        ids, _ = self.stretches(cp[:g], cut[:-1], np.diff(cut))
        return head[:, None] + float(self.worth[ids].sum()) + self._leave(cp[g:], n - g)[None, :]

    def _leave(self, cp: np.ndarray, n: int) -> np.ndarray:
        out = np.full(self.longest, NONE)
        got = self.viterbi(cp[:, None], np.array([len(cp)]), np.array([n]))[0][n:n + self.longest, 0]
        out[:len(got)] = got
        return out

    def _within(self, cp: np.ndarray, n: int, enter: np.ndarray | None):
        """Back pointers over ``n`` characters entered with the given scores."""
        return self.viterbi(cp[:, None], np.array([len(cp)]), np.array([n]),
                            None if enter is None else enter[:, None])[1:]

    def origins(self, cp: np.ndarray, n: int, enter: np.ndarray) -> list[int]:
        """For every leaving state the entering state its best path comes from."""
        cut = self.chunk_cuts(cp, n)
        if len(cut):  # all paths go through the first cut
            f = int(cut[0])
            back, pid = self._within(cp[:f], f, enter)
            return [int(self.trace(back, pid, np.array([f]))[2][0])] * self.longest
        back, pid = self._within(cp, n, enter)
        return [int(self.trace(back, pid, np.array([min(n + j, len(cp))]))[2][0]) for j in range(self.longest)]

    def emit(self, cp: np.ndarray, n: int, enter: np.ndarray, leave: int) -> np.ndarray:
        """The ids of a chunk's part of the best path, from its leaving state."""
        cut = self.chunk_cuts(cp, n)
        f, g = (int(cut[0]), int(cut[-1])) if len(cut) else (n + leave, 0)
        back, pid = self._within(cp[:f], f, enter) if len(cut) else self._within(cp, n, enter)
        parts = [self.to_bytes(*self.trace(back, pid, np.array([f]))[:2])[0]]
        if len(cut):
            parts.append(self.stretches(cp[:g], cut[:-1], np.diff(cut))[0])
            back, pid = self._within(cp[g:], n - g, None)
            parts.append(self.to_bytes(*self.trace(back, pid, np.array([n - g + leave]))[:2])[0])
        return np.concatenate(parts)


def code_points(buf: np.ndarray, offs: np.ndarray, mark: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code points with spaces as marks, and offsets per text; ``mark`` puts
    one mark in front of each text that is not empty."""
    lead = (buf & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])[offs]
    cp = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), "<u4").copy()
    cp[cp == MARK] = LITERAL
    cp[cp == 32] = MARK
    if not mark:
        return cp, at
    full = np.diff(at) > 0
    cp = np.insert(cp, at[:-1][full], np.uint32(MARK))
    return cp, at + np.concatenate([[0], np.cumsum(full)])


def cuts(cp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where stretches start: at texts and at marks after other characters."""
    is_mark = cp == MARK
    cut = is_mark.copy()
    cut[1:] &= ~is_mark[:-1]
    cut[at[:-1][np.diff(at) > 0]] = True
    return np.flatnonzero(cut)


def _encoder(spark_value) -> Encoder:
    held, key = worker_cache(), ("pieces", spark_value[4])
    if key not in held:
        held[key] = Encoder(*spark_value[:4], spark_value[5])
    return held[key]


def _share(spark, path: str):
    model, merges = load_pieces(path), merge_model(path)
    name = hashlib.sha256(repr((model, merges)).encode()).hexdigest()
    return spark.sparkContext.broadcast((*model, name, merges))  # a vocabulary


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(doc_id, ids, text_hash) per row; ``text_hash`` is Spark's xxhash64 of
    the text (null: empty), to hold a decoded text against."""
    model = _share(docs.sparkSession, path)
    src = narrow(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    src = src.withColumn("text_hash", F.xxhash64("text"))

    def run(batches):
        enc = _encoder(model.value)
        for b in batches:
            for part in slices(b, np.asarray(pc.binary_length(b.column(1))), GROUP_BYTES):
                ids, counts = enc.batch(*text_buffer(part.column(1)))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, part.column(2)], names=["doc_id", "ids", "text_hash"])
    small = src.where(F.length("text") <= chunk).mapInArrow(run, "doc_id long, ids array<int>, text_hash long")
    giant = _encode_giant if model.value[5] is None else _merge_giant
    return small.unionByName(giant(src.where(F.length("text") > chunk), model, chunk))


def _merge_giant(docs: DataFrame, model, chunk: int) -> DataFrame:
    """Documents longer than a chunk by merges, in parts between safe cuts."""
    def split(batches):
        enc = _encoder(model.value)
        for b in batches:
            for i in range(b.num_rows):
                cp, _ = code_points(*text_buffer(b.column(2).slice(i, 1)), mark=True)
                for k, (a, z) in enumerate(enc.safe_parts(cp, chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, 1), b.column(1).slice(i, 1), b.column(3).slice(i, 1), pa.array([k], pa.int64()),
                         pa.array([cp[a:z].astype("<u4").tobytes()], pa.binary())],
                        names=["uid", "doc_id", "text_hash", "k", "cp"])

    def emit(batches):
        enc = _encoder(model.value)
        for b in batches:
            out = []
            for c in b.column("cp"):
                cp = np.frombuffer(c.as_buffer(), "<u4")
                starts = cuts(cp, np.array([0, len(cp)]))
                out.append(enc.stretches(cp, starts, np.diff(starts, append=len(cp)))[0])
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), b.column("text_hash"), b.column("k"),
                                              pa.array(out, pa.list_(pa.int32()))], names=["uid", "doc_id", "text_hash", "k", "ids"])
    rows = stored(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", "text_hash")
                  .mapInArrow(split, "uid long, doc_id long, text_hash long, k long, cp binary")
                  .repartition("uid", "k"), "chunks")
    return _joined(rows.mapInArrow(emit, "uid long, doc_id long, text_hash long, k long, ids array<int>"))


def _joined(done: DataFrame) -> DataFrame:
    return (done.groupBy("uid").agg(F.first("doc_id").alias("doc_id"),
                                    F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("p"), F.first("text_hash").alias("text_hash"))
            .select("doc_id", F.flatten(F.col("p.ids")).alias("ids"), "text_hash"))


def _encode_giant(docs: DataFrame, model, chunk: int) -> DataFrame:
    """Documents longer than a chunk, chunk by chunk (see the module's text)."""
    def split(batches):
        enc = _encoder(model.value)
        for b in batches:
            for i in range(b.num_rows):
                buf, offs = text_buffer(b.column(2).slice(i, 1))
                cp, _ = code_points(buf, offs, mark=True)
                for k, a in enumerate(range(0, len(cp), chunk)):
                    n = min(chunk, len(cp) - a)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, 1), b.column(1).slice(i, 1), b.column(3).slice(i, 1), pa.array([k], pa.int64()),
                         pa.array([n], pa.int64()), pa.array([cp[a:a + n + enc.longest - 1].astype("<u4").tobytes()], pa.binary())],
                        names=["uid", "doc_id", "text_hash", "k", "n", "cp"])

    def matrices(batches):
        enc = _encoder(model.value)
        for b in batches:
            m = [enc.transfer(np.frombuffer(c, "<u4"), n).tobytes()
                 for c, n in zip(b.column("cp").to_pylist(), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("k"), pa.array(m, pa.binary())], names=["uid", "k", "m"])

    def entered(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")  # a few kilobytes per chunk of one document
        m = np.stack([np.frombuffer(x, np.float64) for x in table["m"].to_pylist()])
        side = int(round(m.shape[1] ** 0.5))
        pre = scan(m.reshape(-1, side, side))
        start = np.full((1, side), NONE)
        start[0, 0] = 0.0
        v = np.concatenate([start, pre[:-1, 0, :]])
        return pa.table({"uid": table["uid"], "k": table["k"], "v": pa.array([x.tobytes() for x in v], pa.binary())})

    def origins(batches):
        enc = _encoder(model.value)
        for b in batches:
            out = [enc.origins(np.frombuffer(c, "<u4"), n, np.frombuffer(v, np.float64))
                   for c, n, v in zip(*(b.column(x).to_pylist() for x in ("cp", "n", "v")))]
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("k"), pa.array(out, pa.list_(pa.int64()))], names=["uid", "k", "o"])

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        leave, j = [], 0
        for o in reversed(table["o"].to_pylist()):
            leave.append(j)
            j = o[j]
        return pa.table({"uid": table["uid"], "k": table["k"], "leave": pa.array(leave[::-1], pa.int64())})

    def emit(batches):
        enc = _encoder(model.value)
        for b in batches:
            out = [enc.emit(np.frombuffer(c, "<u4"), n, np.frombuffer(v, np.float64), j)
                   for c, n, v, j in zip(*(b.column(x).to_pylist() for x in ("cp", "n", "v", "leave")))]
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), b.column("text_hash"), b.column("k"),
                                              pa.array(out, pa.list_(pa.int32()))], names=["uid", "doc_id", "text_hash", "k", "ids"])
    rows = stored(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", "text_hash")
                  .mapInArrow(split, "uid long, doc_id long, text_hash long, k long, n long, cp binary")
                  .repartition("uid", "k"), "chunks")
    v = stored(rows.select("uid", "k", "n", "cp").mapInArrow(matrices, "uid long, k long, m binary")
               .groupBy("uid").applyInArrow(entered, "uid long, k long, v binary"), "entered")
    with_v = rows.join(v, ["uid", "k"])
    leave = stored(with_v.select("uid", "k", "n", "cp", "v").mapInArrow(origins, "uid long, k long, o array<long>")
                   .groupBy("uid").applyInArrow(chain, "uid long, k long, leave long"), "leave")
    done = (with_v.join(leave, ["uid", "k"])
            .mapInArrow(emit, "uid long, doc_id long, text_hash long, k long, ids array<int>"))
    return _joined(done)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The input rows with ``text``, the text their ids stand for."""
    model = _share(encoded.sparkSession, path)
    keep = [c for c in encoded.columns if c != "text"]
    plain = encoded.select(*[F.col(f"`{c}`") for c in keep]).toDF(*[f"c{i}" for i in range(len(keep))])
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes) + ", text string"
    at = keep.index(ids)

    def run(batches):
        enc = _encoder(model.value)
        for b in batches:
            sizes = np.asarray(b.column(at).value_lengths().fill_null(0)).astype(np.int64)
            for part in slices(b, sizes, GROUP_IDS):
                col = part.column(at)
                counts = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)
                raw, n = enc.decode(np.asarray(col.flatten()).astype(np.int64), counts)
                ends = np.concatenate([[0], np.cumsum(n)])
                data = raw.tobytes()
                texts = [data[s:e].decode() for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])
    return plain.mapInArrow(run, schema).toDF(*keep, "text")
