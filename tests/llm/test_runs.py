"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from starmart.llm import runs as R
from starmart.llm.runs import op13_runs, periodic_runs, runs_of


def brute(words: list) -> list[tuple[int, int, int]]:
    """All runs by comparing every lag, without those of a smaller period."""
    n, spans = len(words), {}
    for lag in range(1, n // 2 + 1):
        i = 0
        while i + lag < n:
            if words[i] != words[i + lag]:
                i += 1
                continue
            j = i
            while j + lag < n and words[j] == words[j + lag]:
                j += 1
            if j + lag - i >= max(12, 2 * lag):
                spans.setdefault((i, j + lag), lag)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in spans.items())


def kept(words: list, runs: list) -> list:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def texts() -> list[str]:
    rng = random.Random(5)
    out = ["", "a", "a " * 11, "a " * 12, "a " * 900, "ab cd " * 400 + "x " + "ab cd " * 300]
    out.append("a b " * 200 + "a " + "a b " * 200)  # squares of many periods around the break
    out.append(("a " * 70 + "b ") * 9 + "a " * 40)
    out.append((("a b c " * 40) + "d ") * 5 + ("a b c " * 30) + "e " + ("a b c " * 50))
    a, b = ["a"], ["a", "b"]  # Fibonacci and Thue-Morse words have runs at every scale
    while len(b) < 1500:
        a, b = b, b + a
    out.append(" ".join(b))
    out.append(" ".join("ab"[bin(i).count("1") % 2] for i in range(1024)))
    for size in (3, 8, 400):
        for _ in range(12):
            words = [f"w{rng.randrange(size)}" for _ in range(rng.randrange(1, 700))]
            for _ in range(rng.randrange(3)):  # nested repeats
                at = rng.randrange(len(words))
                part = words[at:at + rng.randrange(1, 160)]
                words[at:at] = part * rng.randrange(1, 5)
            out.append(" ".join(words))
    return out


def test_all_runs_are_found():
    every = texts()
    for text, (found, rest) in zip(every, runs_of([t.encode() for t in every]), strict=True):
        words = text.split()
        assert found == brute(words), text[:80]
        assert rest.decode() == " ".join(kept(words, found))


def test_random_words_over_small_alphabets():
    rng = random.Random(11)
    for _ in range(150):
        words = [rng.choice("ab") for _ in range(rng.randrange(2, 30))]
        text = (" ".join(words) + " ") * rng.randrange(1, 12) + " ".join(rng.choice("ab") for _ in range(rng.randrange(200)))
        assert runs_of([text.encode()])[0][0] == brute(text.split()), text


@pytest.mark.parametrize("period", [63, 64, 65, 127, 128, 129, 500, 1000])
def test_periods_at_the_edges_of_the_scales(period):
    rng = random.Random(period)
    cycle = [f"w{rng.randrange(40)}" for _ in range(period)]
    for length in (2 * period - 1, 2 * period, 2 * period + 1, 5 * period + 7):
        words = ["x", "y"] + [cycle[i % period] for i in range(length)] + ["z"]
        found = runs_of([" ".join(words).encode()])[0][0]
        assert ((2, length, period) in found) == (length >= 2 * period)
        assert found == brute(words)


def test_seeds_of_long_periods_come_from_minimizers(monkeypatch):
    """Without minimizers a long period is not found: the scans are for short ones only."""
    words = " ".join(f"w{i % 200}" for i in range(900)).encode()
    assert runs_of([words])[0][0] == [(0, 900, 200)]
    monkeypatch.setattr(R.Block, "scale", lambda *_: None)
    assert runs_of([words])[0][0] == []


def test_rows_without_text_and_odd_tables(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a " * 14, "x"), (3, "a " * 14, "x"), (3, "a " * 14, "x"),
            (4, " \t\n é" * 12 + " ", "x"), (5, "a\u00a0" * 30, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted([(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()], key=str)
    assert got == sorted([(1, [], ""), (2, [], ""), (None, [(0, 14, 1)], "a"), (3, [(0, 14, 1)], "a"),
                          (3, [(0, 14, 1)], "a"), (4, [(0, 12, 1)], "é"), (5, [], "a\u00a0" * 30)], key=str)
    assert periodic_runs(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in given.collect()] + [(10**6 + i, t) for i, t in enumerate(texts()[:12])] + [(77, None), (None, "b " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def expected(doc_id, text):
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        # long texts without repeats are quick to settle with numpy
        ids = np.unique(words, return_inverse=True)[1] if words else np.array([])
        runs = brute(words) if len(words) < 2500 else fast(ids)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        return (doc_id, len(runs), *(best or (None, None, None))[:2], best[2] if best else None,
                1000 * best[1] // best[2] if best else None,
                sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(kept(words, runs))))

    def fast(ids):
        spans = {}
        for lag in range(1, len(ids) // 2 + 1):
            equal = np.concatenate(([False], ids[:-lag] == ids[lag:], [False])).astype(np.int8)
            change = np.diff(equal)
            for s, e in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
                if e - s + lag >= max(12, 2 * lag):
                    spans.setdefault((s, e + lag), lag)
        return sorted((s, e - s, q) for (s, e), q in spans.items())

    result = op13_runs(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, result.collect()), key=str) == sorted([expected(*r) for r in rows], key=str)
