"""Language identification by compression.

Per language a raw-content dictionary for zstandard is filled with labelled
texts.  Texts are reduced to lower-case letters (and the marks on them) with
single spaces between the runs (what else they hold says little about the
language) and cut into blocks of ``BLOCK`` bytes; every block is compressed with
each dictionary, and the language with the smallest sum of sizes wins: its
dictionary already holds the strings the text is made of.  Texts whose margin
to the second language is narrow are marked ``accepted = false``.

Learning uses a bounded sample: ``SAMPLES`` texts per language, those with the
smallest hash of the id in each of ``SAMPLES`` hash classes among texts with a
letter, and ``DICT_BYTES`` bytes per language.  The whole text of a sample is
reduced to letters, and where that is more than its share of the dictionary,
stretches spread evenly over the whole text stand for it.  Dictionaries and work
grow with the number of languages.  Prediction reads every whole text.

Defined results: null text, or text without a letter (categories L): ``und``,
score 0, not accepted; equal sizes: the language with more training rows, then
the smaller name; no labelled row at all: ``und`` for every text; repeated rows
are predicted each; an empty table gives an empty result; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import narrow

SAMPLES = 96
DICT_BYTES = 96 * 1024
#: Letters of one sample text that reach the driver.
SAMPLE_BYTES = 4 * DICT_BYTES // SAMPLES
STRETCH = 256
BLOCK = 4096
LEVEL = 5
MARGIN = 0.02
_ASCII_OTHER = re.compile(r"[^a-z]+")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters(text: str) -> str:
    """The letters of a text in lower case with the marks on them, other runs as
    single spaces; empty where there is no letter."""
    if text.isascii():
        return _ASCII_OTHER.sub(" ", text.lower()).strip()
    t = _OTHER.sub(" ", text.lower()).strip()
    return t if _LETTER.search(t) else ""


def stretches(t: bytes, budget: int) -> bytes:
    """``t``, or stretches spread evenly over all of it, ``budget`` bytes at most."""
    if len(t) <= budget:
        return t
    k = max(1, budget // (STRETCH + 1))
    size = min(STRETCH, budget)
    step = (len(t) - size) / max(k - 1, 1)
    return b" ".join(t[int(i * step):int(i * step) + size] for i in range(k))


def learn(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary) in falling order of training rows.  The sample is
    bounded by ``SAMPLES`` rows and ``DICT_BYTES`` bytes per language."""
    rows = narrow(docs.where(train), doc_id=doc_id, lang=F.col(f"`{lang}`").cast("string"), text=text)
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("slot", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(SAMPLES)))
    picks = rows.groupBy("lang", "slot").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("n"))
    picked = picks.collect()  # languages x SAMPLES rows of three numbers
    if not picked:
        return []
    totals: dict[str, int] = {}
    for r in picked:
        totals[r["lang"]] = totals.get(r["lang"], 0) + r["n"]
    chosen = docs.sparkSession.createDataFrame([(r["lang"], r["slot"], r["h"]) for r in picked], "lang string, slot long, h long")

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = [stretches(letters(x.as_py()).encode(), SAMPLE_BYTES) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(t, pa.binary())], names=["lang", "slot", "t"])
    # ties of the hash take the smallest
    texts = (rows.join(F.broadcast(chosen), ["lang", "slot", "h"]).select("lang", "slot", "text")
             .mapInArrow(reduced, "lang string, slot long, t binary").groupBy("lang", "slot").agg(F.min("t").alias("t")).collect())
    out = []
    for name in sorted(totals, key=lambda k: (-totals[k], k)):
        parts = sorted((bytes(r["t"]) for r in texts if r["lang"] == name), key=lambda t: (len(t), t))
        held, left = [], DICT_BYTES
        for i, t in enumerate(parts):  # what short texts leave goes to the longer ones
            held.append(stretches(t, left // (len(parts) - i) - 1))
            left -= len(held[-1]) + 1
        out.append((name, b" ".join(held)))
    return out


def predict(docs: DataFrame, dictionaries: list[tuple[str, bytes]], doc_id: str = "doc_id",
            text: str = "text", margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, margin, accepted) per row.  ``score`` is the
    weight of the winner among all languages when one byte of difference in a
    kilobyte counts as one e-fold."""
    names = [n for n, _ in dictionaries]
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast([d for _, d in dictionaries])  # languages x DICT_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = []
        for d in shared.value:
            held = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(d), source_size=BLOCK, write_content_size=False,
                write_checksum=False, write_dict_id=False)
            held.precompute_compress(compression_params=params)
            packers.append(zstandard.ZstdCompressor(dict_data=held, compression_params=params))
        for b in batches:
            pred, score, gap = [], [], []
            for t in b.column(1):
                t = letters(t.as_py() or "")
                if not t or not packers:
                    pred.append("und"), score.append(0.0), gap.append(0.0)
                    continue
                raw = t.encode()
                sizes = [0] * len(packers)
                for at in range(0, len(raw), BLOCK):
                    block = raw[at:at + BLOCK]
                    for k, p in enumerate(packers):
                        sizes[k] += len(p.compress(block))
                best = min(range(len(sizes)), key=sizes.__getitem__)
                per = [(s - sizes[best]) * 1024.0 / max(len(raw), 64) for s in sizes]
                others = [s for k, s in enumerate(sizes) if k != best]
                pred.append(names[best])
                score.append(1.0 / sum(math.exp(-min(p / 8, 700)) for p in per))
                gap.append((min(others) - sizes[best]) / max(sizes[best], 1) if others else 1.0)
            g = np.asarray(gap)
            ok = (g >= margin) & np.array([p != "und" for p in pred], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(g, pa.float64()), pa.array(ok)],
                names=["doc_id", "lang_pred", "score", "margin", "accepted"])
    return narrow(docs, doc_id=doc_id, text=text).mapInArrow(
        run, "doc_id long, lang_pred string, score double, margin double, accepted boolean")
