import math
import random

import duckdb
import numpy as np
import pytest

from starmart.llm import topk as T


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scores = sorted((-max(-T.LONG_MAX, min(T.LONG_MAX, sum(x * y for x, y in zip(a, b)))), i)
                            for i, b in good if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def got(df, **kw):
    return sorted(tuple(r) for r in T.top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect())


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<double>, rank int, dim string").repartition(parts)


def test_random_and_ties(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.1, 0.25, 0.999]) for _ in range(6)]) for i in range(700)]
    want = brute(rows)
    assert got(frame(spark, rows)) == want
    monkeypatch.setattr(T, "FAN", 2)
    assert got(frame(spark, rows, 11)) == want


def test_normal_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    assert got(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1e300, -1e300]), (100, None), (150, [nan, 1.0]), (200, [None, 1.0]), (250, [inf, 0.0]),
            (300, []), (350, []), (400, [3.0]), (None, [1.0, 1.0]), (1, [2.0, 2.0]), (1, [2.0, 2.0]), (2, [1e18, 1e18]),
            (3, [1e6, 1e6]), (450, [1e6, 1e6]), (4, [-1e300, 1e300]), (5, [0.0, -0.001]), (50, [1e300, -1e300])]
    assert got(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("size", [0, 1, 3])
def test_few_rows(spark, size):
    rows = [(50 * i, [1.0, i * 0.5]) for i in range(size)]
    assert got(frame(spark, rows)) == brute(rows)


def test_best_keeps_the_first_of_ties():
    scores = np.random.default_rng(3).integers(0, 4, (20, 400))
    top = T.best(scores, 5)
    for row, cols in zip(scores, top):
        assert cols.tolist() == sorted(range(400), key=lambda j: (-row[j], j))[:5]


def test_given_table_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = con.sql(f"SELECT query_id, rank, vec_id, score FROM ({T.ORACLE})").fetchall()
    assert sorted(tuple(r) for r in T.op6_topk(spark, sf).select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)


def test_components_up_to_the_largest_double(spark):
    big = 1.7976931348623157e308
    rows = [(0, [1e307, 1.0]), (50, [big, -big]), (1, [1e307, -1e307]), (2, [0.001, 0.5]), (3, [-big, 5e-324]), (4, [2.0 ** 45, -0.3]),
            (100, [2.0 ** 45 + 0.0078125, 0.3]), (5, [2.0 ** 44 + 0.3, 1e-3]), (150, [0.1, -0.1])]
    assert got(frame(spark, rows)) == exact(rows)


def exact(rows, k=5, every=50):
    """``brute`` in fractions: ``256 * x`` of a double may be beyond the doubles."""
    from fractions import Fraction

    good = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows]
    out = []
    for q, a in good:
        if q % every == 0:
            scores = sorted((-max(-T.LONG_MAX, min(T.LONG_MAX, sum(x * y for x, y in zip(a, b)))), i) for i, b in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_lists_are_cut_before_they_are_shuffled(spark, monkeypatch):
    """The lists of a shard's tiles are limited to k in the task of the shard, then merged as a tree."""
    monkeypatch.setattr(T, "BLOCK_ROWS", 16)
    monkeypatch.setattr(T, "SHARD_ROWS", 64)
    monkeypatch.setattr(T, "FAN", 3)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(900)]
    df = T.top_k(frame(spark, rows, 5))
    assert "WindowGroupLimit" in df._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows)
