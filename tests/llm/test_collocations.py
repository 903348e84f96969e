"""Collocations against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from starmart.llm import collocations as C
from starmart.llm.collocations import mined


def brute(rows, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    pushed = {}
    for (lang, words), f in counts.items():
        if len(words) == 3 and f >= 10:
            for part in (words[:2], words[1:]):
                pushed[lang, part] = max(f, pushed.get((lang, part), 0))
    out = {}
    for (lang, words), a in counts.items():
        if len(words) < 2 or a < 10 or 100 * pushed.get((lang, words), 0) >= 50 * a:
            continue
        cuts = [(10 ** 6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        phrase = " ".join(words)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, a, counts[lang, words[:k]], counts[lang, words[k:]], score))
    return sorted((lang, rank, phrase, a, l, r, totals[lang], score) for lang, found in out.items()
                  for rank, (*_, phrase, a, l, r, score) in enumerate(sorted(found)[:top], 1))


def made_up_rows(seed, n):
    rng = random.Random(seed)
    phrases = [" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 3) for _ in range(rng.randrange(2, 5))) for _ in range(40)]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(1, 40)):
            words.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice("abcdefghijklmnopqrstuvwxyz"))
            if rng.random() < 0.2:
                words[-1] += rng.choice(".,;:!?\n\r\x0b\x0c")
        rows.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(words)))
    return rows


@pytest.mark.parametrize("top, wanted", [(2000, (4000, 32000)), (5, (6, 20)), (40, (1, 50)), (60, (3,)), (200, ())])
def test_best_phrases_against_brute_force(spark, monkeypatch, top, wanted):
    monkeypatch.setattr(C, "CHUNK_TOKENS", 700)  # many chunks share the counts
    rows = made_up_rows(top, 700)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert sorted(map(tuple, mined(docs, top, wanted).collect())) == brute(rows, top)


def test_rounds_count_less_than_everything(spark, monkeypatch):
    """The bound leaves triples out: with a high score to reach, fewer are counted than with none."""
    rows = made_up_rows(7, 600)
    docs = spark.createDataFrame(rows, "lang string, text string")
    sizes, given = [], C.written

    def counted(spark, df, name, codec="zstd"):
        out = given(spark, df, name, codec)
        if name == "collocation-found":
            sizes.append(out.where("head IS NOT NULL").count())
        return out

    monkeypatch.setattr(C, "written", counted)
    assert sorted(map(tuple, mined(docs, 5, (8,)).collect())) == brute(rows, 5)
    bounded = sizes[0]
    sizes.clear()
    mined(docs, 5, ()).collect()
    assert bounded < sizes[0] / 2


def test_rounding_and_large_numbers(spark):
    from pyspark.sql import functions as F

    rows = [(10 ** 12 + 7, 10 ** 12 + 9, 10 ** 12 + 11), (10, 30, 30), (3 * 10 ** 12, 3 * 10 ** 12, 3 * 10 ** 12)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(C.exact_score("a", "l", "r")).collect()]
    assert got == [10 ** 6 * a * a // (l * r) for a, l, r in rows]
    assert df.select(F.lit(1)).count() == 3


def test_odd_tables(spark):
    rows = [("en", None), ("en", ""), (None, "x y " * 12), ("de", ". " * 30), ("en", "é É a.b\tA!B " * 11), ("en", "long " * 5000)]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "lang string, text string, rank int, phrase string")
    assert sorted(map(tuple, mined(docs).collect())) == brute(rows, 2000)
    assert mined(docs.limit(0)).collect() == []
    assert mined(docs.where("lang = 'de'")).collect() == []
