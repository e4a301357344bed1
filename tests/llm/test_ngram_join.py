import itertools
import random

import numpy as np
import pytest
from fixtures_llm import awkward, awkward_rows, empty

from lodestone.llm import ngram_join as J


def shingles(t, n):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\v", " ").replace("\f", " ")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(rows, n, percent):
    """id -> smallest id reachable, and the number of links between ids."""
    sets = {}
    for d, t in rows:
        if d is not None:
            sets.setdefault(d, []).append(shingles(t, n))
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    links = 0
    for a, b in itertools.combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            links += 1
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: root(d) for d in sets}, links


def near_rows():
    rnd = random.Random(1)
    voc = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(voc) for _ in range(rnd.choice([5, 8, 20, 60, 150, 400]))]
        for _ in range(rnd.choice([3, 10, 40])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 40))):
                w[rnd.randrange(len(w))] = rnd.choice(voc)
            if rnd.random() < .3:
                w += [rnd.choice(voc) for _ in range(rnd.randint(0, len(base) // 12 + 1))]
            rows.append((len(rows), " ".join(w)))
    passage = " ".join(rnd.choice(voc) for _ in range(60))  # shared by documents that are not alike
    for _ in range(30):
        rows.append((len(rows), " ".join(rnd.choice(voc) for _ in range(rnd.randint(1, 200))) + " " + passage))
    for _ in range(40):
        rows.append((len(rows), " ".join(rnd.choice(voc[:20]) for _ in range(rnd.randint(1, 9)))))
    return rows


@pytest.mark.parametrize("n,percent,block", [(4, 85, J.BLOCK), (4, 85, 2500), (5, 80, J.BLOCK)])
def test_against_all_pairs(spark, n, percent, block):
    rows = near_rows()
    want, links = components(rows, n, percent)
    assert links > 200
    got = J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), words=n, percent=percent, block=block).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["n_shingles"] == len(shingles(dict(rows)[r["doc_id"]], n)) for r in got)


def test_signatures_lose_no_pair():
    rnd = random.Random(8)
    for percent in (80, 85, 90):
        for _ in range(300):
            n = rnd.choice([5, 6, 7, 9, 12, 17, 25, 60, 200])
            a = {rnd.getrandbits(64) for _ in range(n)}
            b = set(a)
            while True:  # move away until the link would break
                c = set(b)
                if rnd.random() < .5 and len(c) > 1:
                    c.discard(rnd.choice(sorted(c)))
                else:
                    c.add(rnd.getrandbits(64))
                if 100 * len(a & c) < percent * len(a | c):
                    break
                b = c
            if a == b:
                continue
            both = np.concatenate([np.array(sorted(x), dtype=np.uint64) for x in (a, b)])
            who, sig = J.signatures(both, np.array([0, len(a), len(a) + len(b)]), percent)
            assert set(sig[who == 0].tolist()) & set(sig[who == 1].tolist())


def test_tree_join_against_all_pairs():
    rnd = random.Random(3)
    sets = []
    for _ in range(12):
        base = [rnd.getrandbits(64) for _ in range(rnd.choice([6, 30, 90]))]
        for _ in range(rnd.choice([1, 5, 25])):
            s = set(base)
            for _ in range(rnd.randint(0, len(base) // 8 + 1)):
                s.discard(rnd.choice(base))
                s.add(rnd.getrandbits(64))
            sets.append(np.array(sorted(s), dtype=np.uint64))
    want = J.UnionFind(len(sets))
    for i, j in itertools.combinations(range(len(sets)), 2):
        if J.linked(sets[i], sets[j], 85):
            want.union(i, j)
    assert (J.join_block(sets, 85).roots() == want.roots()).all()


def test_awkward_rows(spark):
    rows = [(d, t) for d, t in awkward_rows() if d != 8]  # id 8 twice: same result twice
    want, _ = components(rows + [(8, dict(awkward_rows())[8])], 4, 85)
    got = J.jaccard_components(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])


def test_survivors(spark):
    df = awkward(spark)
    out = J.near_duplicate_survivors(df)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 7 in ids and not {8, 9, 10} & set(ids) and ids.count(None) == 2 and {1, 2, 3, 4, 5, 6, 11, 12, 13} <= set(ids)


def test_empty(spark):
    assert J.jaccard_components(empty(spark)).count() == 0
    assert J.near_duplicate_survivors(empty(spark)).count() == 0


def test_second_pass_meets_every_pair_of_the_rest(spark, monkeypatch):
    """A label cut in parts with many families besides its largest component,
    by the trees alone (no neighbour orders)."""
    monkeypatch.setattr(J, "ORDERS", 0)
    rnd = random.Random(4)
    voc = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(30):
        base = [rnd.choice(voc) for _ in range(60)]
        texts += [" ".join(base[:k] + [rnd.choice(voc)] + base[k:]) for k in (0, 60)]
    main = " ".join(rnd.choice(voc) for _ in range(60))
    texts += [main + f" m{i}" for i in range(8)]
    sets = J.row_sets(__import__("pyarrow").array(texts), 4)
    for cuts, rest_cuts in ((2, 1), (4, 3)):
        rest_n = sum(map(len, sets[:60]))
        rows = [(i, 7, i // 2 % cuts if i % 2 else (i // 2 + 1) % cuts, cuts, len(sets[i]), J.digest(sets[i]), J.class_key(J.digest(sets[i])), t) for i, t in enumerate(texts)]
        held = spark.createDataFrame(rows, "doc_id long, label long, part int, cuts int, n long, digest binary, cls long, text string")
        node = [(i, J.class_key(J.digest(s))) for i, s in enumerate(sets)]
        links = spark.createDataFrame([(node[i], node[60]) for i in range(61, 68)], J._LINKS)
        got = J._second_pass(held, links, -(-rest_n // rest_cuts))
        met, found = set(), set()
        table = got.select("task", "label", "side", "comp", "doc_id", "digest", "text").toArrow()
        for task in set(table["task"].to_pylist()):
            part = table.filter(__import__("pyarrow.compute").compute.equal(table["task"], task))
            who = list(zip(part["doc_id"].to_pylist(), part["side"].to_pylist()))
            met |= {frozenset((a, b)) for (a, x), (b, y) in itertools.combinations(who, 2) if x != y}
            out = J._block_links(85, 4, True)(part)
            found |= {frozenset((a["id"], b["id"])) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist())}
        place = {r[0]: r[2] for r in rows}
        assert all(frozenset(p) in met for p in itertools.combinations(range(60), 2) if place[p[0]] != place[p[1]])
        assert {frozenset((i, i + 1)) for i in range(0, 60, 2)} <= found


def test_an_id_at_two_texts_keeps_the_unlinked_one(spark):
    a = " ".join(f"w{i}" for i in range(60))
    b = " ".join(f"v{i}" for i in range(60))
    rows = [(1, a), (5, a + " tail"), (5, b), (9, b + " end"), (9, "another text of its own entirely"), (7, a + " x"), (7, a + " y")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, digest string")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in J.jaccard_components(df, words=5, percent=80).collect()}
    assert got[5, 57] == 1 and got[5, 56] == 5 and got[9, 57] == 5 and got[9, 2] == 9 and got[7, 57] == 1
    left = {(r["doc_id"], r["text"]) for r in J.near_duplicate_survivors(df).collect()}
    assert left == {(1, a), (5, b), (9, "another text of its own entirely")}


def test_words_a_polynomial_cannot_tell_apart_do_not_link(spark):
    x, y = "a", "b"
    for _ in range(11):
        x, y = x + y, y + x
    got = J.jaccard_components(spark.createDataFrame([(1, x), (2, y), (3, x + " tail"), (4, y + " tail")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 2, 3: 3, 4: 4}


def test_copies_and_empty_texts_are_dealt_evenly(spark):
    """A third of all rows one text, a third empty: no shard of document rows holds them together."""
    rows = [(i, "one text that a third of all rows hold") for i in range(300)] + [(i, "") for i in range(300, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    per = J.scan_documents(df, "doc_id", "text", 4, 85, 8).where("shard >= 8").groupBy("shard").count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) <= 600 // 8 + 2
    got = J.jaccard_components(df).collect()
    assert {r["component_id"] for r in got if r["doc_id"] < 300} == {0} and all(r["component_id"] == r["doc_id"] for r in got if r["doc_id"] >= 300)


def test_sketches_lose_no_pair():
    """Of two sets at the very edge of linking some common signature has sketches that are near."""
    rnd = random.Random(18)
    for percent in (80, 85, 90):
        for turn in range(200):
            n = rnd.choice([4, 5, 6, 9, 12, 25, 60, 200, 700])
            a = {rnd.getrandbits(64) for _ in range(n)}
            b, c = set(a), None
            while True:  # only removals, only additions or both
                c = set(b)
                if turn % 3 == 0 and len(c) > 1 or turn % 3 == 2 and rnd.random() < .5 and len(c) > 1:
                    c.discard(next(iter(c & a)))
                else:
                    c.add(rnd.getrandbits(64))
                if 100 * len(a & c) < percent * len(a | c):
                    break
                b = c
            if a == b:
                continue
            both = np.concatenate([np.array(sorted(x), dtype=np.uint64) for x in (a, b)])
            who, sig, sketch = J.sketched_signatures(both, np.array([0, len(a), len(a) + len(b)]), percent)
            of = {(w, s): k for w, s, k in zip(who.tolist(), sig.tolist(), sketch.tolist())}
            assert any(J.near(np.array([k], np.uint64), np.array([of[1, s]], np.uint64))[0] for (w, s), k in of.items() if w == 0 and (1, s) in of)


@pytest.mark.parametrize("pairs", [J.PAIRS, 7])
def test_candidate_components_against_all_pairs(monkeypatch, pairs):
    monkeypatch.setattr(J, "PAIRS", pairs)
    rnd = random.Random(9)
    for _ in range(40):
        rows = []
        for cls in range(rnd.choice([0, 1, 5, 60])):
            size, family = rnd.choice([40, 48, 60, 90]), rnd.getrandbits(60) if rnd.random() < .5 else 0xABCDEF
            for s in rnd.sample(range(9), rnd.randint(1, 4)):
                k = family
                for _ in range(rnd.choice([0, 1, 4, 9])):
                    k ^= 1 << rnd.randrange(60)
                rows.append((s, cls - 30, size, k << 4 | rnd.choice([3, 7, 7, 15])))
        rnd.shuffle(rows)
        up = {r[1]: r[1] for r in rows}

        def root(x):
            return x if up[x] == x else root(up[x])
        for (s, c, n, k), (t, d, m, l) in itertools.combinations(rows, 2):
            if s == t and 100 * min(n, m) >= 80 * max(n, m) and k % 16 == l % 16 and ((k ^ l).bit_count() <= k % 16 or k % 16 == 15):
                x, y = sorted((root(c), root(d)))
                up[y] = x
        col = [np.array([r[i] for r in rows], t) for i, t in enumerate((np.uint64, np.int64, np.int64, np.uint64))]
        a, b = J.candidate_components(*col, 80)
        assert dict(zip(a.tolist(), b.tolist())) == {c: root(c) for c in up if root(c) != c}


def test_texts_that_share_a_line_are_no_block(spark):
    """Texts of a third common words share signatures but are no candidates; the near copies among them are."""
    rnd = random.Random(12)
    voc = [f"w{i}" for i in range(3000)]
    line = " ".join(rnd.choice(voc) for _ in range(90))
    texts = [" ".join(rnd.choice(voc) for _ in range(rnd.randint(190, 210))) + "\n" + line for _ in range(400)]
    texts += [f"{texts[i]} end" for i in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    pairs = J.chains(J.scan_documents(df, "doc_id", "text", 5, 80, 8), 80, 8).where("a is not null").select("a", "b").collect()
    assert 5 <= len({x for r in pairs for x in r}) <= 40
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(df, words=5, percent=80).collect()}
    assert got == {i: i - 400 if i >= 400 else i for i in range(405)}
