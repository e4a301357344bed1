import numpy as np
import pyarrow as pa
import pytest
from fixtures_llm import awkward, awkward_rows, empty
from pyspark.sql import functions as F

from lodestone.llm import sentencepiece_scan as S
from lodestone.llm.arrays import text_buffer
from lodestone.llm.queries import piece_model


@pytest.fixture(scope="module")
def enc():
    return S.Encoder(*S.load_pieces(piece_model()))


def brute(enc, model, text):
    """Plain left-to-right Viterbi over the pieces of the model."""
    pieces, scores, kind, _ = model
    table = {p: i for i, p in enumerate(pieces) if kind[i] == -1}
    if not text:
        return []
    s = "\u2581" + text.replace("\u2581", "\ufffe").replace(" ", "\u2581")
    best, back = [0.0] + [-np.inf] * len(s), [None] * (len(s) + 1)
    for i in range(len(s)):
        if s[i] not in table and best[i] + enc.low > best[i + 1]:
            best[i + 1], back[i + 1] = best[i] + enc.low, (i, None)
        for j in range(i + 1, min(len(s), i + enc.longest) + 1):
            k = table.get(s[i:j])
            if k is not None and best[i] + scores[k] > best[j]:
                best[j], back[j] = best[i] + scores[k], (i, k)
    out, j = [], len(s)
    while j:
        i, k = back[j]
        out.append([k] if k is not None else [int(enc.byte[b]) for b in s[i:j].replace("\ufffe", "\u2581").encode()])
        j = i
    return [x for part in reversed(out) for x in part]


TEXTS = ["", "a", "Hello  world\n new\tline", "Straße 日本語 テキスト \U0001F600", "  lead and tail  ", "▁ literal ▁▁ mark", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa b",
         "The quick brown fox, jumps!! over: the (lazy) dog. " * 3, " ", "x\x00y"]


def test_against_plain_viterbi(enc):
    model = S.load_pieces(piece_model())
    ids, n = enc.batch(*text_buffer(pa.array(TEXTS)))
    ends = np.cumsum(n)
    for t, a, b in zip(TEXTS, ends - n, ends):
        assert ids[a:b].tolist() == brute(enc, model, t), t
    raw, m = enc.decode(ids, n)
    ends = np.cumsum(m)
    assert [raw[a:b].tobytes().decode() for a, b in zip(ends - m, ends)] == TEXTS


@pytest.mark.parametrize("chunk", [17, 40, 90])
def test_chunks_give_the_same_pieces(enc, chunk):
    for t in TEXTS:
        buf, offs = text_buffer(pa.array([t]))
        ids, _ = enc.batch(buf, offs)
        if not len(ids):
            continue
        cp, _ = S.code_points(buf, offs, mark=True)
        parts = [(cp[a:a + min(chunk, len(cp) - a) + enc.longest - 1], min(chunk, len(cp) - a)) for a in range(0, len(cp), chunk)]
        mats = np.stack([enc.transfer(p, n) for p, n in parts])
        pre = S.scan(mats)
        start = np.full((1, enc.longest), S.NONE)
        start[0, 0] = 0.0
        v = np.concatenate([start, pre[:-1, 0, :]])
        leave, j = [], 0
        for (p, n), x in zip(reversed(parts), v[::-1]):
            leave.append(j)
            j = enc.origins(p, n, x)[j]
        got = np.concatenate([enc.emit(p, n, x, e) for (p, n), x, e in zip(parts, v, leave[::-1])])
        assert got.tolist() == ids.tolist()
        assert pre[-1, 0, 0] == pytest.approx(enc.worth[ids].sum())


def test_products_are_associative():
    rng = np.random.default_rng(0)
    m = rng.integers(-50, 50, (9, 4, 4)).astype(float)
    left = m[0]
    for x in m[1:]:
        left = S.maxplus(left, x)
    assert (S.scan(m)[-1] == left).all()
    assert (S.maxplus(m[0], S.maxplus(m[1], m[2])) == S.maxplus(S.maxplus(m[0], m[1]), m[2])).all()


def test_awkward_rows_round_trip_and_chunked(spark):
    df = awkward(spark)
    whole = S.encode(df, piece_model())
    assert whole.count() == len(awkward_rows())
    assert S.decode(whole, piece_model()).where("xxhash64(text) <> text_hash").count() == 0
    short = df.where("doc_id <> 6 or doc_id is null")
    a = sorted((r["doc_id"] or 0, r["ids"]) for r in S.encode(short, piece_model()).collect())
    b = sorted((r["doc_id"] or 0, r["ids"]) for r in S.encode(short, piece_model(), chunk=150).collect())
    assert a == b


def test_empty(spark):
    e = S.encode(empty(spark), piece_model())
    assert e.count() == 0 and S.decode(e, piece_model()).count() == 0
    assert S.decode(e.select(F.lit("x").alias("a.b"), "ids"), piece_model()).columns == ["a.b", "ids", "text"]


@pytest.mark.parametrize("chunk", [S.CHUNK, 40])
def test_ids_are_those_of_the_library(spark, chunk):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    more = ["un  b" * 40, "abab" * 100 + "\u65e5\u672c\u8a9e" * 60, "<s> </s> <0x41> <unk>", "Unbelievably, the internationalisation of tokenisers; (re)considered\u2026\n\n\tfoo_bar(baz)  " * 5]
    texts = [t for t in TEXTS if "\u2581" not in t] + more
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in S.encode(df, piece_model(), chunk=chunk).collect()}
    assert got == {i: sp.encode(t) for i, t in enumerate(texts)}


def test_stretches_a_polynomial_cannot_tell_apart(spark):
    x, y = "a", "b"
    for _ in range(12):
        x, y = x + y, y + x
    df = spark.createDataFrame([(1, x), (2, y), (3, f"{x} {y}")], "doc_id long, text string").coalesce(1)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    encoded = S.encode(df, piece_model())
    got = {r["doc_id"]: r for r in S.decode(encoded, piece_model()).collect()}
    for d, t in ((1, x), (2, y), (3, f"{x} {y}")):
        assert got[d]["text"] == t and list(got[d]["ids"]) == sp.encode(t)
