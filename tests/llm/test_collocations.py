"""Phrase mining against SQL and a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltide.llm import collocations as C

SCHEMA = "doc_id bigint, text string, lang string"


def mined(rows, least, share, top):
    """The same from (doc_id, text, lang) rows in plain Python."""
    total, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall("[^ \t]+", piece)
            total[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + m])) for m in range(1, 6) for i in range(len(ws) - m + 1))
    out = []
    longest = Counter()
    for (lang, ws), a in f.items():
        if len(ws) > 2 and a >= least:
            for m in range(2, len(ws)):
                for i in range(len(ws) - m + 1):
                    key = (lang, ws[i : i + m])
                    longest[key] = max(longest[key], a)
    for (lang, ws), a in f.items():
        if len(ws) < 2 or a < least or (longest[lang, ws] and 100 * longest[lang, ws] >= share * a):
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.append((lang, " ".join(ws), a, f[lang, ws[:k]], f[lang, ws[k:]], total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(best)]
    return sorted(ranked)


def plain(df):
    return sorted(tuple(r) for r in df.collect())


def texts(seed, n=300):
    rnd = random.Random(seed)
    words = ["New", "york", "CITY", "é", "straße", "a", "b\tb", "co-op", "x\x0by", "日本", "ÀB", "the  the"]
    out = []
    for i in range(n):
        parts = [rnd.choice(words) if rnd.random() < 0.6 else "New York City hall opens" for _ in range(rnd.randint(0, 30))]
        out.append((i, "".join(p + rnd.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\t"]) for p in parts), rnd.choice(["en", "de", None, "und"])))
    out += [(None, None, "en"), (1, "", None), (1, " \t\n", "en"), (2, "...", None)]
    return out


@pytest.mark.parametrize("seed, least, share, top", [(1, 20, 100, 2000), (2, 5, 60, 7), (3, 2, 100, 40)])
def test_against_plain_version(spark, monkeypatch, seed, least, share, top):
    rows = texts(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("phrase", F.lit("extra")).withColumn("count", F.lit(1))
    assert plain(C.collocations(df, least=least, share=share, top=top)) == mined(rows, least, share, top)


def test_small_steps_and_full_map(spark, monkeypatch):
    """Tiny slices and runs, and a map so full that it lets everything pass, change nothing."""
    for name, value in (("SLICE", 50), ("RUN", 30), ("SUMS", 10), ("STEP", 16)):
        monkeypatch.setattr(C, name, value)
    rows = texts(4, 60)
    assert plain(C.collocations(spark.createDataFrame(rows, SCHEMA), least=3)) == mined(rows, 3, 100, 2000)


def test_long_text_and_empty_table(spark):
    rows = [(1, "one two three " * 150_000, "en"), (2, "one two. three", "en")]
    assert plain(C.collocations(spark.createDataFrame(rows, SCHEMA))) == mined(rows, 100, 100, 2000)
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None)], SCHEMA)).count() == 0


def test_collisions_are_told_apart(monkeypatch):
    """With all hashes equal, words and phrases still come out by their text."""
    monkeypatch.setattr(C, "mix", lambda h: np.zeros(len(h), np.uint64))

    class Everything:
        value = np.full(8, 255, np.uint8)

    batch = pa.RecordBatch.from_arrays([pa.array(["a b a b", "a c"]), pa.array(["en", "de"])], names=["text", "lang"])
    got = {tuple(r[:3]): r[3] for b in C.writing(Everything)(iter([batch])) for r in zip(*[c.to_pylist() for c in b.columns])}
    assert got["en", 1, "a"] == 2 and got["en", 2, "a b"] == 2 and got["en", 2, "b a"] == 1 and got["de", 2, "a c"] == 1
    assert got["en", 0, ""] == 4 and got["de", 0, ""] == 2
