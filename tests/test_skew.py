"""Hot keys on the shuffle path: adaptive execution splits the skewed partition."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from starmart.operators import joins as J


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_lookup_spreads_a_hot_code_before_an_aggregation(spark):
    fact = spark.range(100_000).select(
        F.when(F.col("id") % 10 != 0, F.lit(7)).otherwise(F.col("id") % 500).alias("code_id"), F.col("id"))
    codes = spark.range(500).select(F.col("id").alias("code"), F.concat(F.lit("L"), F.col("id")).alias("label"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false",
                        "spark.sql.shuffle.partitions": "16"}):
        plain = J.lookup_join(fact, codes, "code_id", {"label": "label"}, broadcast=False, salt_buckets=1)
        salted = J.lookup_join(fact, codes, "code_id", {"label": "label"}, broadcast=False, salt_buckets=8)
        assert salted.columns == plain.columns
        per_label = lambda d: {r.label: r.n for r in d.groupBy("label").agg(F.count("*").alias("n")).collect()}
        assert per_label(salted) == per_label(plain)
        # rows of the hot code land in one partition without salt and in several with it
        hot_parts = lambda d: d.filter("code_id = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        assert hot_parts(plain) == 1 and hot_parts(salted) > 1
        left = J.lookup_join(fact, codes.filter("code < 100"), "code_id", {"label": "label"}, how="left",
                             broadcast=False, salt_buckets=8)
        assert left.count() == 100_000


def test_salting_changes_no_result(spark):
    from collections import Counter
    rows = [(7 if i % 10 else (i % 50 if i % 20 else None), i) for i in range(20_000)]
    fact = spark.createDataFrame(rows, "code_id long, id long").repartition(7)
    all_codes = spark.range(40).select(F.col("id").alias("code"), F.concat(F.lit("L"), F.col("id")).alias("label"))
    # the hot code 7 known, and unknown (inner drops its rows, left keeps them with NULLs)
    for codes, how in [(c, h) for c in (all_codes, all_codes.filter("code != 7")) for h in ("inner", "left")]:
        plain = J.lookup_join(fact, codes, "code_id", {"label": "label"}, how=how, broadcast=True)
        salted = J.lookup_join(fact, codes, "code_id", {"label": "label"}, how=how, broadcast=False)
        assert salted.columns == plain.columns
        assert Counter(tuple(r) for r in salted.collect()) == Counter(tuple(r) for r in plain.collect()), how


def test_other_joins_are_refused(spark):
    fact, codes = spark.range(5).withColumnRenamed("id", "k"), spark.range(3).selectExpr("id AS code", "id AS label")
    for how in ("right", "full", "left_anti"):
        with pytest.raises(ValueError):
            J.lookup_join(fact, codes, "k", {"label": "label"}, how=how, broadcast=False)


def test_chained_lookups_read_the_fact_once(spark, scratch):
    path = scratch("fact")
    spark.range(1000).selectExpr("id % 7 AS a", "id % 5 AS b", "id % 3 AS c", "id").write.parquet(path)
    out = spark.read.parquet(path)
    codes = spark.range(10).selectExpr("id AS code", "concat('L', id) AS label")
    for key in ("a", "b", "c"):
        out = J.lookup_join(out, codes, key, {"label": f"label_{key}"}, broadcast=False)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and out.count() == 1000


def test_group_means_of_a_hot_key_without_broadcast(spark, monkeypatch):
    from starmart.operators import windows as W
    df = spark.createDataFrame([(None if i % 50 == 0 else i % 3, float(i % 4)) for i in range(400)], "k long, v double").repartition(5)
    want = sorted(map(str, map(tuple, W.with_group_avg(df, ["k"], {"m": "v"}).collect())))
    monkeypatch.setattr(W, "fits_broadcast", lambda _: False)
    assert sorted(map(str, map(tuple, W.with_group_avg(df, ["k"], {"m": "v"}).collect()))) == want and len(want) == 400
