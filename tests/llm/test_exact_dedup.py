import hashlib
from collections import Counter, defaultdict

from fixtures_llm import awkward, awkward_rows, empty
from lodestone.llm import exact_dedup


def digest(t):
    return hashlib.sha256("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode()).hexdigest()


def test_awkward_rows_against_brute_force(spark):
    got = exact_dedup.exact_duplicates(awkward(spark)).collect()
    groups = defaultdict(list)
    for d, t in awkward_rows():
        groups[digest(t)].append(d)
    assert len(got) == len(awkward_rows())
    for r in got:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in got) == len(groups)
    assert all(n == 1 for n in Counter(r["text_sha256"] for r in got if r["kept"]).values())


def test_drop_duplicates_keeps_columns_and_one_row(spark):
    df = awkward(spark)
    out = exact_dedup.drop_duplicates(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert len({digest(r["text"]) for r in rows}) == len(rows) == len({digest(t) for _, t in awkward_rows()})
    plain = exact_dedup.drop_duplicates(df.where("doc_id < 8")).collect()  # no repeated id: the short way
    assert len(plain) == len({digest(t) for d, t in awkward_rows() if d is not None and d < 8})


def test_few_counters_give_the_same_result(spark):
    rows = [(i, "same" if i % 3 else f"t{i % 20}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    a = sorted(map(tuple, exact_dedup.exact_duplicates(df, counters=1).select(cols).collect()))
    b = sorted(map(tuple, exact_dedup.exact_duplicates(df).select(cols).collect()))
    assert a == b and len(a) == 600


def test_misra_gries_finds_every_frequent_key(spark):
    keys = [("hot",)] * 500 + [("warm",)] * 200 + [(f"k{i}",) for i in range(300)]
    df = spark.createDataFrame([(k.encode(),) for (k,) in keys], "k binary").repartition(5)
    got = {bytes(r["key"]) for r in exact_dedup.misra_gries(df, counters=9).collect()}
    assert len(got) <= 9 and {b"hot", b"warm"} <= got


def test_empty(spark):
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0
    assert exact_dedup.drop_duplicates(empty(spark)).count() == 0
