import zlib

import numpy as np
import pytest
from fixtures_llm import awkward, awkward_rows, empty

from lodestone.llm import rans, token_output as T
from lodestone.llm.queries import byte_bpe
from lodestone.session import scratch_path


def expected(rows):
    """By the untouched library."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(byte_bpe())
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("run", [T.RUN, 700])  # 700: long texts span blocks
def test_files_against_the_tokenizer(spark, run):
    path = scratch_path(spark, "t")
    # two rows with a null id are ordered by a hash of their text: leave one
    df = awkward(spark).where("doc_id is not null or text is not null")
    rows = [r for r in awkward_rows() if r != (None, None)]
    extra = [(50, "don't they'll (a) x.y@z.com it's... \"q\"'d <|endoftext|>.x l'été a1b2,3.4"), (51, " lead"), (52, "tail    x\x85y\n\n z ")]
    df = df.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)  # clashing names stay
    T.write_tokens(df, path, byte_bpe(), 2, run=run, added=True)
    got = sorted(map(tuple, T.read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(rows + extra)


def test_empty(spark):
    path = scratch_path(spark, "t")
    T.write_tokens(empty(spark), path, byte_bpe(), 2)
    assert T.read_documents(spark, path).count() == 0


def test_rans_round_trip_parts_and_damage():
    rng = np.random.default_rng(0)
    ids = (rng.zipf(1.3, 300_000) % 5000).astype(np.uint32)
    t = rans.quantise(*np.unique(ids, return_counts=True))
    assert int(t.freq.sum()) == 1 << t.bits and int(t.freq.min()) >= 1
    block = rans.encode(ids, t, lanes=64, every=16)
    assert (rans.decode(block, t) == ids).all()
    assert (rans.decode(block, t, 3, 5) == ids[3 * 1024:5 * 1024]).all()
    for n in (0, 1, 63, 64, 65):
        assert (rans.decode(rans.encode(ids[:n], t, lanes=64), t) == ids[:n]).all()
    bad = bytearray(block)
    bad[-9] ^= 4
    with pytest.raises(ValueError):
        rans.decode(bytes(bad), t)
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert 8 * len(rans.encode(ids, t, lanes=64, every=4096)) / len(ids) < 1.02 * entropy + 0.1


def test_crc_of_joined_parts():
    a, b = b"x" * 1000, bytes(range(256)) * 9
    assert rans.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert rans.crc32_combine(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def test_literal_added_tokens_as_the_untouched_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer
    from lodestone.llm.queries import QUERIES
    tok = Tokenizer.from_file(byte_bpe())
    texts = ["end <|endoftext|>|", "<|endoftext|>", "<|endoftext|><|endoftext|> y", "x  <|endoftext|>  y\n", "don't<|endoftext|>'s a.b",
             "<|endof", "text|> <|endoftext|", "> z", None, "", "plain text"]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(path)
    got = sorted(map(tuple, QUERIES["op3_token_output"](spark, str(tmp_path)).collect()))
    want, at = [], 0
    for d, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_units_a_polynomial_cannot_tell_apart(spark):
    x, y = "a", "b"
    for _ in range(12):
        x, y = x + y, y + x
    rows = [(1, x), (2, y), (3, "pre " + x + " and " + y)]
    path = scratch_path(spark, "t")
    T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), path, byte_bpe(), 2, added=True)
    assert sorted(map(tuple, T.read_documents(spark, path).collect())) == expected(rows)


def test_equal_rows_are_dealt_to_several_ranges(spark):
    df = spark.createDataFrame([(None, "one text")] * 600 + [(i, f"t{i}") for i in range(600)], "doc_id long, text string").repartition(6)
    runs = T.token_runs(df, byte_bpe(), 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert runs.where("exists(doc_ids, x -> x is null)").groupBy("part").count().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    path = scratch_path(spark, "t")
    T.write_tokens(df, path, byte_bpe(), 2)
    assert T.read_documents(spark, path).count() == 1200
