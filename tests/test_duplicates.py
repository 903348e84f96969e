"""Skew-safe duplicates against a brute-force reference on small inputs."""

import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.operators import duplicates as DU
from starmart.operators import quality as Q


def brute_force(rows, key_idx, order_idx):
    """pandas ``duplicated`` with rows sorted by (key, order): all but the first per key."""
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: tuple((x is not None, x) for x in [r[i] for i in order_idx])):
        k = tuple(r[i] for i in key_idx)
        if k in seen:
            out.append(r)
        seen.add(k)
    return Counter(out)


def test_hot_key_and_large_copy_groups(spark):
    rng = random.Random(7)
    rows = [(0, rng.randint(0, 50), "x") for _ in range(300)]       # one key holds most rows
    rows += [(1, 5, "same")] * 120                                   # a large group of copies
    rows += [(k, rng.randint(0, 3), "y") for k in range(2, 40)]
    rows += [(None, 1, "n"), (None, 1, "n"), (None, 2, "n")]           # NULL keys are equal keys
    df = spark.createDataFrame(rows, "k int, v int, s string")
    expected = brute_force(rows, [0], [0, 1, 2])
    assert sum(expected.values()) == len(rows) - len({r[0] for r in rows})
    for parts in (1, 3, 16):
        got = Counter(tuple(r) for r in DU.duplicate_rows(df.repartition(parts), ["k"], order=["v"]).collect())
        assert got == expected, parts


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2), st.sampled_from(["a", "b"])),
                max_size=40),
       st.integers(1, 6))
def test_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, v int, s string") if rows else \
        spark.createDataFrame([], "k int, v int, s string")
    df = df.repartition(parts)
    got = Counter(tuple(r) for r in DU.duplicate_rows(df, ["k", "s"], order=["v"]).collect())
    assert got == brute_force(rows, [0, 2], [0, 2, 1])
    firsts = Counter(tuple(r) for r in DU.first_rows(df, ["k", "s"]).collect())
    assert got + firsts == Counter(rows)


def test_values_come_back_unchanged(spark):
    import math
    values = [-7.0, -0.0, 5.0, -0.0, float("nan"), 0.0, float("nan")] * 40
    df = spark.createDataFrame([(1, v) for v in values] + [(2, -0.0)], "k int, v double").repartition(5)
    got = [r.v for r in DU.duplicate_rows(df, ["k"], order=["v"]).collect()]
    assert len(got) == len(values) - 1
    assert sum(v == 0 and math.copysign(1, v) < 0 for v in got) == 80 and sum(math.isnan(v) for v in got) == 80
    assert [math.copysign(1, r.v) for r in DU.first_rows(df, ["k"]).collect() if r.k == 2] == [-1.0]


def test_the_order_is_required(spark):
    import pytest
    df = spark.createDataFrame([(1, 1)], "k int, v int")
    with pytest.raises(TypeError):
        DU.duplicate_rows(df, ["k"])
    with pytest.raises(ValueError):
        DU.duplicate_rows(df, ["k"], order=[])


def test_names_with_blanks_and_backticks(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (1, 3)], ["a key", "o`d.d"])
    assert sorted(r[1] for r in DU.duplicate_rows(df, ["a key"], order=["o`d.d"]).collect()) == [2, 3]


def _final_plan(df):
    df.write.mode("overwrite").format("noop").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_the_input_is_read_and_numbered_once(spark, scratch):
    """The final plan has one scan, two windows, no count of the input, no broadcast and no union."""
    path = scratch("dup")
    spark.range(400).selectExpr("CAST(id % 7 AS INT) AS k", "id AS v").write.parquet(path)
    out = DU.duplicate_rows(spark.read.parquet(path), ["k"], order=["v"])
    plan = _final_plan(out)
    assert len(out.collect()) == 393
    assert plan.count("FileScan parquet") == plan.count("Scan parquet") == 1
    assert plan.count("+- Window [") == 2
    for node in ("Broadcast", "Union", "WindowGroupLimit"):
        assert node not in plan


def test_a_hot_key_spreads_where_the_input_is_partitioned_by_it(spark):
    df = spark.range(6400).selectExpr("CAST(0 AS INT) AS k", "id AS v").repartition(8, "k")
    by = DU._ordered(df, ["k"], ["v"])
    groups = DU._numbered_in_groups(df, ["k"], by).groupBy("__group").count().collect()
    assert len(groups) == DU.SALT_BUCKETS and max(r["count"] for r in groups) < 6400 / 8
    same = spark.range(0, 6400, 1, 16).selectExpr("1 AS k", "2 AS v")   # equal rows: by the partitions they come from
    assert DU._numbered_in_groups(same, ["k"], by).select("__group").distinct().count() == 16
    assert DU.duplicate_rows(same, ["k"], order=["v"]).count() == 6399 and DU.first_rows(same, ["k"]).count() == 1


def test_check_unique_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    r = Q.check_unique_key(df, ["a"]).collect()[0]
    assert (r.row_count, r.distinct_keys, r.is_unique) == (4, 2, False)
    r = Q.check_unique_key(df.limit(2), ["a", "b"]).collect()[0]
    assert r.is_unique
    empty = Q.check_unique_key(df.filter("a > 9"), ["a"]).collect()[0]
    assert (empty.row_count, empty.distinct_keys, empty.is_unique) == (0, 0, True)
