import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from lodestone.llm import arrays as A
from lodestone.llm.elias_fano import EliasFano

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fold(b):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in b)


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \n\tZz", max_size=40)), max_size=8))
@settings(max_examples=80, deadline=None)
def test_words_and_grams_match_regex(texts):
    w = A.Words(*A.text_buffer(pa.array(texts, pa.string())))
    want = [WORD.findall(fold((t or "").encode())) for t in texts]
    assert np.diff(w.first).tolist() == [len(x) for x in want]
    by_hash = {}
    for h, x in zip(w.hash.tolist(), [y for x in want for y in x]):
        assert by_hash.setdefault(h, x) == x
    doc, g = A.doc_grams(w, 3)
    sets = [{tuple(x[i:i + 3]) for i in range(len(x) - 2)} if len(x) >= 3 else {tuple(x)} if x else set() for x in want]
    for i in range(len(texts)):
        assert len(set(g[doc == i].tolist())) == len(sets[i])


def test_pieces_cut_at_white_space_only():
    text = (b"abc def " * 1000)
    buf = np.frombuffer(text, np.uint8)
    cuts = list(A.pieces(buf, np.array([0, len(buf)]), limit=100))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(buf)
    assert all(a[1] == b[0] and buf[b[0]] == 32 for a, b in zip(cuts, cuts[1:]))


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_pack_round_trip(xs):
    a = np.array(sorted(xs), dtype=np.uint64)
    assert (A.unpack(A.pack(a, True), np.uint64, True) == a).all()
    assert (A.unpack(A.pack(a), np.uint64) == a).all()


def test_remembered_forgets_when_full():
    r = A.Remembered(np.int32, 100)
    rng = np.random.default_rng(0)
    for _ in range(20):
        words = [b"w%d" % i for i in rng.integers(0, 500, 60)]
        lens = np.array([len(w) for w in words])
        buf, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lens) - lens
        value = np.array([int(w[1:]) for w in words], np.int32)
        at = r.resolve(buf, starts, lens, lambda i: (np.ones(len(i), np.int64), value[i]))
        assert (r.flat[r.at[at]] == value).all()
        assert len(r.key) <= 161


@given(st.lists(st.integers(0, 10**7), max_size=300))
@settings(max_examples=60, deadline=None)
def test_elias_fano(xs):
    v = np.array(sorted(xs), dtype=np.uint64)
    e, _ = EliasFano.view(EliasFano.build(v).to_bytes())
    assert (e.access(np.arange(len(v))) == v).all()
    ask = np.array(sorted(xs + [x + 1 for x in xs] + [0, 10**9]), dtype=np.uint64)
    got = e.find(ask)
    have = set(xs)
    for q, i in zip(ask.tolist(), got.tolist()):
        assert (i >= 0) == (q in have)
        if i >= 0:
            assert int(v[i]) == q


def thue_morse(n, a, b):
    """A word of 2 ** n letters and its complement: polynomial hashes modulo a
    power of two cannot tell them apart."""
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [10, 11, 12, 14, 16])
def test_no_arrangement_of_bytes_collides(n):
    a, b = thue_morse(n, b"a", b"b")
    buf = np.frombuffer(a + b, np.uint8)
    h = A.segment_hash(buf, np.array([0, len(a)]), np.array([len(a), len(b)]))
    assert h[0] != h[1]
    w = A.Words(*A.text_buffer(pa.array([a.decode(), b.decode()])))
    assert len(set(w.hash.tolist())) == 2
    x, y = thue_morse(n - 7, [1], [2])
    words = A.mix64(np.array(x + y, np.uint64))
    assert A.gram_hash(words[:len(x)], len(x))[0] != A.gram_hash(words[len(x):], len(x))[0]


@given(st.lists(st.binary(max_size=40), min_size=1, max_size=30))
@settings(max_examples=60, deadline=None)
def test_segment_hash_tells_segments_apart_by_content_alone(parts):
    buf = np.frombuffer(b"".join(parts), np.uint8)
    lens = np.array([len(p) for p in parts])
    h = A.segment_hash(buf, np.cumsum(lens) - lens, lens)
    assert len(set(h.tolist())) == len(set(parts))
    by = {}
    assert all(by.setdefault(p, v) == v for p, v in zip(parts, h.tolist()))


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    real = A.segment_hash
    # the first hash says nothing, the next ones are sound
    monkeypatch.setattr(A, "segment_hash", lambda b, s, n, seed=1: real(b, s, n, seed) * np.uint64(seed != 23) + np.uint64(seed == 23))
    words = [b"one", b"two", b"three", b"one", b"a longer word than eight", b"a longer word than eighx", b"two"]
    lens = np.array([len(w) for w in words])
    buf, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lens) - lens
    r = A.Remembered(np.int32, 100)
    for _ in range(2):
        at = r.resolve(buf, starts, lens, lambda i: (np.ones(len(i), np.int64), starts[i].astype(np.int32)))
        got = r.flat[r.at[at]].tolist()
        assert [words[starts.tolist().index(g)] for g in got] == words
