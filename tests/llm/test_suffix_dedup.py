import random
from collections import defaultdict

import numpy as np
from fixtures_llm import awkward, awkward_rows, empty

from lodestone.llm import suffix_dedup as X
from lodestone.llm.lyndon_suffixes import suffix_orders

LOW = -(1 << 62)


def brute(rows, n=50):
    first = {}
    for i, b in sorted(((LOW if i is None else i, b) for i, b in rows), key=lambda r: r[0]):
        for p in range(len(b) - n + 1):
            first.setdefault(b[p:p + n], i)
    out = defaultdict(list)
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < (LOW if i is None else i):
                gone[p:p + n] = b"\1" * n
        spans = sum(g and not h for g, h in zip(gone, [0, *gone]))
        out[i].append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def check(df, rows, **kw):
    got = defaultdict(list)
    for r in X.remove_repeats(df, **kw).collect():
        got[r["doc_id"]].append((r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])))
        assert sum(s["to"] - s["from"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
    want = brute([(i, (t or "").encode()) for i, t in rows])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_awkward_rows_against_brute_force(spark):
    check(awkward(spark), awkward_rows())


def near_rows():
    rnd = random.Random(7)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    rows = []
    for i in range(80):
        t = list(base)
        for _ in range(rnd.randrange(4)):
            t[rnd.randrange(300)] = rnd.choice("xyz")
        a = rnd.randrange(100)
        rows.append((rnd.randrange(60), "".join(t[a:a + rnd.randrange(40, 200)])))
    return rows + [(200, "z" * 400), (201, "z" * 120), (202, "ab" * 90), (203, "ba" * 90), (204, "é" * 60), (205, "q" + "é" * 40)]


def test_near_copies_and_repetitions(spark):
    rows = near_rows()
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_large_groups_are_split_without_loss():
    rows = [(i, t.encode()) for i, t in near_rows()]
    buf = np.frombuffer(b"".join(b for _, b in rows), np.uint8)
    offs = np.cumsum([0] + [len(b) for _, b in rows])
    s, w, v = X.runs(buf, offs)
    doc = np.array([i for i, _ in rows])[np.searchsorted(offs, s, side="right") - 1]
    whole = X.window_owners(buf, s, w, v, doc, 50, 16)
    split = X.window_owners(buf, s, w, v, doc, 50, 16, text_bytes=100, batch_bytes=500)
    assert (whole == split).all()
    first = {}
    for i, b in sorted(rows):
        for p in range(len(b) - 49):
            first.setdefault(b[p:p + 50], i)
    at = 0
    for a, n in zip(s.tolist(), w.tolist()):
        for p in range(a, a + n):
            assert whole[at] == first[buf[p:p + 50].tobytes()]
            at += 1


def test_suffix_orders_against_sorting():
    rnd = random.Random(2)
    for trial in range(150):
        texts = [[bytes(rnd.choice(b"ab" if trial % 2 else b"abcdz") for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 5))]
                 for _ in range(rnd.randint(1, 6))]
        strs = [s for t in texts for s in t]
        lens = np.array([len(s) for s in strs])
        starts = np.cumsum(lens) - lens
        order, base = suffix_orders(np.frombuffer(b"".join(strs), np.uint8), starts, lens,
                                    np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
        flat, end = b"".join(strs), np.repeat(starts + lens, lens)
        for t in range(len(texts)):
            o = order[base[t]:base[t + 1]].tolist()
            assert sorted(o) == list(range(base[t], base[t + 1]))
            suffixes = [flat[p:end[p]] for p in o]
            assert suffixes == sorted(suffixes)


def test_empty(spark):
    assert X.remove_repeats(empty(spark)).count() == 0


def test_copies_are_sent_once_per_chunk(spark):
    """A third of all rows one text: a chunk sends its runs once, not once per copy."""
    rnd = random.Random(5)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(200))
    rows = [(i, line) for i in range(400)] + [(1000 + i, "".join(rnd.choice("ijklmnop ") for _ in range(120))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    chunks = X.chunked(df, "doc_id", "text", size=X.CHUNK_BYTES)
    flags = X.repeated(X.minimisers(chunks, 8, 50, 16))
    sent = X.candidate_runs(X.with_answers(chunks, flags), 8, 50, 16).collect()
    n = sum(len(X.unpack(X._split(r["blob"])[1], np.uint8)) for r in sent)
    assert 0 < n <= chunks.count() * 200  # at most a run per byte of the line and chunk
    check(df, rows)


def test_shards_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(X, "SHARD_BYTES", 400)
    monkeypatch.setattr(X, "CHUNK_BYTES", 2000)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert X.shards_for(X.chunked(df, "doc_id", "text", size=2000), 2000, 400) > 20
    check(df, rows)
