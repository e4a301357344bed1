import itertools

import pytest
from sf_dirs import SF_SMALL
from fixtures_llm import awkward, empty
from test_decontaminate import best, words
from test_exact_dedup import digest
from test_ngram_join import shingles

import corpus_pipeline as P
from lodestone.llm import quality
from lodestone.llm.common import fold_of, read_table, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF_SMALL, "documents"), []
    for name, f in P.STAGES:
        nxt = stored(f(spark, docs, SF_SMALL), name)
        out.append((docs, nxt))
        docs = nxt
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "tokenise"]
    assert all(o.columns == COLUMNS for _, o in stages[:-1])
    assert P.ORACLE_SQL is None


def test_quality_stage_keeps_what_the_classifier_accepts(spark, stages):
    before, after = stages[0]
    model = quality.learn(before, read_table(spark, SF_SMALL, "labels"), fold_of("doc_id", 5) != 0)
    assert ids(after) == ids(quality.score(before, model).where("predicted = 1"))


def test_exact_stage(stages):
    before, after = (texts(x) for x in stages[1])
    keep = {}
    for d, t in before.items():
        keep[digest(t)] = max(d, keep.get(digest(t), d))
    assert sorted(after) == sorted(keep.values())


def test_near_stage(stages):
    before, after = (texts(x) for x in stages[2])
    sets = {d: shingles(t, 5) for d, t in before.items()}
    up = {d: d for d in before}

    def root(x):
        return x if up[x] == x else root(up[x])
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    assert sorted(after) == sorted(d for d in up if root(d) == d)


def test_decontamination_stage(spark, stages):
    before, after = (texts(x) for x in stages[3])
    items = [words(r["text"]) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    grams = {tuple(w[i:i + 5]) for w in items for i in range(len(w) - 4)}
    leaked = set()
    for d, t in before.items():
        w = [x.strip(".,") for x in t.lower().split()]
        if any(tuple(w[i:i + 5]) in grams for i in range(len(w) - 4)) and any(best(words_of(t), words_of(" ".join(x))) >= 0.8 for x in items):
            leaked.add(d)
    assert set(before) - set(after) >= leaked and leaked


def words_of(t):
    import re
    return re.findall(r"[^\W_]+", t.lower())


def test_last_stage_is_lossless(stages):
    before, after = stages[4]
    assert ids(before) == ids(after) and after.where("not lossless").count() == 0


@pytest.mark.parametrize("name,f", P.STAGES)
def test_stages_take_awkward_and_empty_tables(spark, name, f):
    df = awkward(spark)
    out = f(spark, df, SF_SMALL)
    assert out.count() <= df.count() and (name == "tokenise" or out.columns == df.columns)
    e = f(spark, empty(spark), SF_SMALL)
    assert e.count() == 0 and (name == "tokenise" or e.columns == COLUMNS)


def test_tokenise_stage_gives_the_librarys_ids(stages):
    import sentencepiece

    from lodestone.llm.queries import piece_model
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    before, after = stages[4]
    want = texts(before)
    for r in after.collect():
        assert list(r["ids"]) == sp.encode(want[r["doc_id"]]) and r["n_ids"] == len(r["ids"])


def test_decontamination_removes_nothing_else(spark, stages):
    """Every removed text holds a window as similar to an item as the stage asks."""
    before, after = (texts(x) for x in stages[3])
    items = [words_of(r["text"]) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    for d in set(before) - set(after):
        assert max(best(words_of(before[d]), x) for x in items) >= 0.8


def test_an_id_at_two_texts_passes_all_filtering_stages(spark):
    """Texts that share an id are judged one by one in every stage."""
    a, b = (" ".join(f"{c}{i}word" for i in range(60)) for c in "xy")
    rows = [(1, a), (5, a + " tail"), (5, b), (7, b), (9, "z " + a)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = stored(P.drop_exact_copies(spark, df, SF_SMALL), "a")
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted([(1, a), (5, a + " tail"), (7, b), (9, "z " + a)])
    out = P.drop_near_copies(spark, df, SF_SMALL)
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted([(1, a), (5, b)])
