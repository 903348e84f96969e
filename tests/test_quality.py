"""Profiles and checks (FIXTURES A7)."""

import pytest

from starmart.operators import aggregates as AG
from starmart.operators import profile as PR
from starmart.operators import quality as Q
from starmart.operators import windows as W


@pytest.fixture()
def messy(spark):
    rows = [(1, "a", float("nan"), None), (2, None, float("nan"), "x"), (3, "c", float("nan"), None)]
    return spark.createDataFrame(rows, "id int, `name with blank` string, only_nan double, s string")


def test_null_profile_counts_null_and_nan(messy):
    got = {r.column_name: (r.null_count, r.nan_count, r.missing_count, r.row_count)
           for r in PR.null_profile(messy).collect()}
    assert got == {"id": (0, 0, 0, 3), "name with blank": (1, 0, 1, 3), "only_nan": (0, 3, 3, 3),
                   "s": (2, 0, 2, 3)}


def test_null_profile_is_one_scan(spark, scratch):
    path = scratch("profile")
    spark.range(100).selectExpr("id", "CAST(NULL AS STRING) AS s", "id * 1.0 AS d").write.parquet(path)
    plan = PR.null_profile(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_null_percent_only_columns_with_missing(messy):
    got = {r.column_name: round(r.missing_percent, 4) for r in PR.null_percent(messy).collect()}
    assert got == {"name with blank": 33.3333, "only_nan": 100.0, "s": 66.6667}


def test_check_nulls_and_verdict(spark, messy):
    report = Q.check_nulls(messy, "messy")
    status = {r.column_name: r.status for r in report.collect()}
    assert status == {"id": "passed", "name with blank": "failed", "only_nan": "passed", "s": "failed"}
    strict = {r.column_name: r.status for r in Q.check_nulls(messy, "messy", nan_fails=True).collect()}
    assert strict["only_nan"] == "failed"
    empty = spark.createDataFrame([], "a int")
    both = report.unionByName(Q.check_nulls(empty, "empty"))
    verdict = {r.table_name: (r.failed_columns, r.status) for r in Q.check_table_verdict(both).collect()}
    assert verdict == {"messy": (2, "failed"), "empty": (0, "passed")}


def test_row_count_never_fails_by_default(spark):
    empty = spark.createDataFrame([], "a int")
    assert Q.check_row_count(empty, "e").collect()[0].status == "passed"
    assert Q.check_row_count(empty, "e", min_rows=1).collect()[0].status == "failed"


def test_key_coverage(spark):
    fact = spark.createDataFrame([("A", "X"), ("A", "X"), ("B", None), ("C", "Z"), ("D", "W")], "city string, st string")
    dim1 = spark.createDataFrame([("A", "X"), ("A", "X"), ("C", "Z"), ("B", None)], "m string, st string")
    dim2 = spark.createDataFrame([("Q", "Q")], "c string, code string")
    got = {r.dimension: (r.fact_keys, r.matched_keys, r.unmatched_keys) for r in
           Q.check_key_coverage(fact, ["city", "st"], {"d1": (dim1, ["m", "st"]), "d2": (dim2, ["c", "code"])}).collect()}
    assert got == {"d1": (3, 2, 1), "d2": (3, 0, 3)}


def test_date_order(spark):
    import datetime as dt
    d = dt.date
    df = spark.createDataFrame([(d(2016, 1, 2), d(2016, 1, 1)), (d(2016, 1, 1), d(2016, 1, 1)),
                                (None, d(2016, 1, 1))], "arr date, dep date")
    assert Q.check_date_order(df, "dep", "arr").collect()[0].violations == 2
    assert Q.date_order_violations(df, "dep", "arr").count() == 2


def test_category_percent_counts_null_rows_in_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    got = {r.t: (r["count"], r.percent) for r in AG.category_percent(df, "t").collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0)}


def test_group_avg_equals_window_then_distinct(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), ("b", 4.0), (None, 5.0)], "k string, x double")
    w = Window.partitionBy("k")
    by_window = {tuple(r) for r in df.select("k", F.avg("x").over(w).alias("m")).distinct().collect()}
    assert {tuple(r) for r in W.window_avg_distinct(df, ["k"], {"m": "x"}).collect()} == by_window
    exact = {r.k: r.m for r in AG.group_avg(df, ["k"], {"m": "x"}, digits=2, decimals=1).collect()}
    assert exact == {"a": 1.5, "b": 4.0, None: 5.0}
    attached = W.with_group_avg(df, ["k"], {"m": "x"})
    assert attached.count() == 5 and attached.filter(F.col("m").isNull()).count() == 0


def test_group_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 1)], "t string, n int")
    assert {r.t: r["count"] for r in AG.group_count(df, "t").collect()} == {"a": 2, None: 1, "b": 1}
    assert [tuple(r) for r in AG.group_count_drop_null(df, "t").collect()] == [("a", 2), ("b", 1)]
    assert AG.count_distinct_pair(df, "t", "n").collect()[0][0] == 3
    assert AG.distinct_rows_count(df, ["t"]).collect()[0][0] == 3
    assert tuple(AG.min_max(df, "n").collect()[0]) == (1, 3)


def test_null_profile_handles_awkward_names(spark):
    names = ["we`ird", "it's", "a\\b.c"]
    df = spark.createDataFrame([(None, 1, "x"), ("a", None, None)], "a string, b int, c string").toDF(*names)
    got = {r.column_name: r.null_count for r in PR.null_profile(df).collect()}
    assert got == {"we`ird": 1, "it's": 1, "a\\b.c": 1}


def test_order_by_spreads_a_hot_sort_key(spark):
    from pyspark.sql import functions as F
    from starmart.operators import projections as PJ
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep the range partitions of this tiny input apart
    try:
        rows = PJ.order_by(df, "k").withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(key, old)
    keys = [r.k for r in rows]
    assert keys == sorted(keys)
    assert len({r.part for r in rows if r.k == 0}) > 1  # the hot value is sorted by several tasks


def test_exact_means_treat_nan_as_missing(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", float("nan")), ("a", 2.5), ("b", None)], "k string, x double")
    got = {r.k: r.m for r in AG.group_avg(df, ["k"], {"m": "x"}, digits=4, decimals=2).collect()}
    assert got == {"a": 1.875, "b": None}


def test_check_all_fails_an_empty_table(spark):
    from starmart.operators.quality import check_all
    fact = spark.createDataFrame([], "city string, state string")
    dim = spark.createDataFrame([("A", "B")], "city string, state string")
    res = check_all({"fact": fact, "dim": dim}, "fact", ["city", "state"], {"dim": ["city", "state"]})
    assert {r.table_name: r.status for r in res["row_counts"].collect()} == {"fact": "failed", "dim": "passed"}
    res = check_all({"fact": fact, "dim": dim}, "fact", ["city", "state"], {"dim": ["city", "state"]}, min_rows=0)
    assert {r.status for r in res["row_counts"].collect()} == {"passed"}
