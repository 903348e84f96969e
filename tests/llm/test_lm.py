import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import lm as L


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def fold(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 10


def brute(rows):
    """Counts, mixture weights and scores of all documents with dictionaries."""
    def model(keep):
        uni, bi = Counter(), Counter()
        for i, t in rows:
            if fold(i) and keep(fold(i)):
                w = tokens(t)
                uni.update(w)
                bi.update(zip([b"", *w], w))
        return uni, bi, sum(uni.values()), len(uni)

    def parts(m, before, now):
        uni, bi, n, v = m
        c = uni[before]
        return (math.frexp(c)[1], bi[before, now] / max(1, c), (uni[now] + 0.1) / (n + 0.1 * (v + 1)), 1 / (v + 1))

    part, every = model(lambda f: f != L.EM_FOLD), model(lambda f: True)
    cells = Counter()
    for i, t in rows:
        if fold(i) == L.EM_FOLD:
            w = tokens(t)
            for a, b in zip([b"", *w], w):
                k, p2, p1, p0 = parts(part, a, b)
                cells[k, round(L.BINS * math.log2(p2 / p0)) if p2 else -10_000, round(L.BINS * math.log2(p1 / p0))] += 1
    weights = L.weights_table(L.expectation_maximisation([(*c, n) for c, n in cells.items()]))
    out = []
    for i, t in rows:
        w = tokens(t)
        base = score = 0.0
        for a, b in zip([b"", *w], w):
            k, p2, p1, p0 = parts(every, a, b)
            base += math.log10(p1)
            score += math.log10(weights[k] @ [p2, p1, p0])
        f = fold(i)
        out.append((i, None if f is None else f == 0, len(w), sum(every[0][x] > 0 for x in w), every[2], base, score))
    return out


def compare(spark, rows, parts=4):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, chunk int, em string")
    got = sorted((tuple(r) for r in L.score_documents(df.repartition(parts)).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in sorted(got, key=lambda g: str((g[:5], g[5])))] == [w[:5] for w in sorted(want, key=lambda g: str((g[:5], g[5])))]
    for g, w in zip(sorted(got, key=lambda g: (str(g[:5]), round(g[5], 6))), sorted(want, key=lambda g: (str(g[:5]), round(g[5], 6)))):
        assert g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], abs=1e-6)


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words, at = [], 0
        for _ in range(rng.randint(0, 40)):
            at = (at + rng.choice([1, 1, 1, 2, 7])) % 60 if rng.random() < 0.8 else rng.randrange(60)
            words.append(vocabulary[at])
        rows.append((i, " ".join(words)))
    return rows


def test_against_dictionaries(spark):
    rows = texts(300, 1) + [(1000, None), (1001, ""), (1002, " \n"), (None, "w1 W2 unseen"), (7, "w1 w2"), (7, "w1 w2"),
                            (1003, "Ä ä w1\tw2\x0bw3"), (1004, "w1 " * 5000), (1005, "new words only here")]
    compare(spark, rows)


def test_many_chunks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_TOKENS", 100)  # tasks import the module anew; the driver sets the shards
    monkeypatch.setattr(L, "SHARD_TOKENS", 5)
    compare(spark, texts(120, 2), 6)


def test_no_training_rows_and_no_rows(spark):
    held_out = [i for i in range(200) if fold(i) == 0]
    compare(spark, [(i, "a b") for i in held_out[:3]], 2)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.score_documents(empty).count() == 0


def test_weights_raise_the_likelihood():
    rng = random.Random(4)
    cells = [(3, rng.choice([-10_000, 8, 20]), rng.randint(-4, 12), rng.randint(1, 50)) for _ in range(40)]

    def likelihood(w):
        return sum(n * math.log(w[0] * (0 if b == -10_000 else 2 ** (b / L.BINS)) + w[1] * 2 ** (a / L.BINS) + w[2])
                   for _, b, a, n in cells)

    best = L.expectation_maximisation(cells)[3]
    assert sum(best) == pytest.approx(1)
    for _ in range(200):
        w = np.array([rng.random() for _ in range(3)])
        assert likelihood(w / w.sum()) <= likelihood(best) + 1e-3


def test_given_table_beats_the_base(spark):
    rows = L.op10_lm_scores(spark, "/root/testdata/sf0.001").groupBy("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).collect()
    assert all(r.s > r.b for r in rows) and len(rows) == 2
