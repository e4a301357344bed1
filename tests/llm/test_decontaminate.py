import random
import re
from collections import Counter

from fixtures_llm import awkward, empty
from pyspark.sql import functions as F

from lodestone.llm import decontaminate as D


def words(t):
    return re.findall(r"[0-9a-z]+", (t or "").lower())


def shingles(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def best(doc, item):
    """Largest weighted Jaccard similarity of any item-sized window."""
    m, k, top = len(item), min(5, len(item)), 0.0
    if not m or len(doc) < k:
        return 0.0
    want = shingles(item)
    n = min(m, len(doc))
    for s in range(len(doc) - n + 1):
        w = doc[s:s + n]
        c = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        top = max(top, sum((c & want).values()) / sum((c | want).values()))
    return top


def test_against_brute_force(spark):
    rnd = random.Random(4)
    voc = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.choice([1, 3, 5, 12, 30])))) for i in range(25)]
    items += [(100, None), (101, ""), (None, "lonely words here stand for one item"), (102, items[5][1])]
    docs = []
    for i in range(60):
        w = [rnd.choice(voc) for _ in range(rnd.randrange(0, 80))]
        if i % 2:
            part = rnd.choice(items[:25])[1].split()
            if len(part) > 10 and i % 4 == 1:
                part[0] = "changed"
            w[len(w) // 2:len(w) // 2] = part
        docs.append((i, "  ".join(w).title() + "."))
    docs += [(900, None), (901, "so LONELY, words here stand: for one item!"), (901, "so LONELY, words here stand: for one item!")]
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    pairs = Counter((r["doc_id"], r["item_id"]) for r in got.collect())
    want = Counter()
    for d, t in docs:
        for i, x in items:
            if best(words(t), words(x)) >= 0.8:
                want[d, i] += 1
    assert pairs == want


def test_blocks_of_items_give_the_same(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["one two three four five six", "three four five six seven", "zz yy"])], "item_id long, text string")
    a = sorted(map(tuple, D.leaks(docs, items).collect()))
    assert a == sorted(map(tuple, D.leaks(docs, items, block_bytes=8).collect())) and len(a) == 2
    assert [r["doc_id"] for r in D.drop_leaks(docs, items, block_bytes=8).collect()] == [2]


def test_multi_index_finds_all_within_the_radius():
    import numpy as np
    rng = np.random.default_rng(1)
    index = D.Index([rng.integers(0, 2**63, 20).astype(np.uint64) for _ in range(40)], radius=9)
    prints = np.array([p ^ (rng.random(64) < f) for p in index.print for f in (0.05, 0.1, 0.15, 0.3)])
    got = {(w, i) for w, i, _ in index.near(20, prints)}
    assert got == {(w, i) for w in range(len(prints)) for i in range(40) if (prints[w] != index.print[i]).sum() <= 9}


def test_awkward_and_empty(spark):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog")], "item_id long, text string")
    df = awkward(spark)
    assert [r["doc_id"] for r in D.leaks(df, items).collect()] == [1]
    out = D.drop_leaks(df, items)
    assert out.columns == df.columns and out.count() == df.count() - 1
    assert D.leaks(empty(spark), items).count() == 0
    assert D.drop_leaks(df, items.limit(0)).count() == df.count()


def test_equal_items_are_one_text_and_blocks_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x the only text of many items stands here y")], "doc_id long, text string")
    items = spark.createDataFrame([(i, "the only text of many items stands here") for i in range(400)] + [(900 + i, f"other words number{i} of an item") for i in range(40)],
                                  "item_id long, text string")
    texts, names = D._items(items, "item_id", "text", 300)
    per = [(r["n"], r["b"]) for r in texts.groupBy("block").agg(F.count("row").alias("n"), F.sum("size").alias("b")).collect()]
    assert sum(n for n, _ in per) == 41 and all(n and b < 300 + 50 for n, b in per) and names.count() == 440
    assert sorted(r["item_id"] for r in D.leaks(docs, items, block_bytes=300).collect()) == list(range(400))
    assert len(list(D._searchers(docs, texts))) == len(per)  # no scan without items


def test_marks_beyond_ascii_are_no_word_characters(spark):
    text = "seven plain words that make an item"
    docs = [(1, f"\u201c{text}\u201d"), (2, f"\u2014{text}\u2026"), (3, text.replace(" ", "\u00a0")), (4, "é" + text), (5, "Überall: 日本語"), (6, text.replace("plain", "pl\u0131in"))]
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, text), (2, "überall 日本語")], "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 1), (2, 1), (3, 1), (5, 2)]


def test_recall_of_the_radius():
    """Of windows that differ from an item as much as similarity 0.80 to 0.85 allows,
    the share whose fingerprint is within the radius."""
    import numpy as np
    rng = np.random.default_rng(7)
    recall = {}
    for n in (40, 60, 100, 300):
        found = total = 0
        for _ in range(400):
            item = rng.integers(0, 2**63, n).astype(np.uint64)
            window = item.copy()
            for _ in range(40 + n):  # change words as long as the similarity stays at 0.8 or more
                trial = window.copy()
                trial[rng.integers(0, n)] = rng.integers(0, 2**63)
                if D.similarity(D.gram_hash(trial, 5), D.gram_hash(item, 5)) < 0.8:
                    continue
                window = trial
            sim = D.similarity(D.gram_hash(window, 5), D.gram_hash(item, 5))
            if sim > 0.85:
                continue
            total += 1
            g = D.gram_hash(window, 5)
            found += bool(D.Index([item]).near(n, D.fingerprints(g, len(g))))
        recall[n] = found / total
    assert min(recall.values()) >= 0.97, recall
    print(recall)
