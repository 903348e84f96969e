"""Writers, appends and the increment stream."""

import pytest

from starmart.operators import joins as J
from starmart.sources import readers as R
from starmart.sources import schemas as SC
from starmart.sources import sinks as SK
from starmart.streaming import increments as ST


def test_write_parquet_refuses_existing_path(spark, scratch):
    path = scratch("w")
    df = spark.range(3)
    SK.write_parquet(df, path)
    with pytest.raises(Exception):
        SK.write_parquet(df, path)
    assert spark.read.parquet(path).count() == 3


def test_append_skips_stored_keys(spark, scratch):
    path = scratch("a")
    SK.write_parquet(spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string"), path)
    inc = spark.createDataFrame([(1, "changed"), (2, "b"), (None, "n2")], "k int, v string")
    SK.append_parquet(spark, inc, path, keys=["k"])
    SK.append_parquet(spark, inc, path, keys=["k"])
    got = sorted((r.k if r.k is not None else -1, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(-1, "n"), (1, "a"), (2, "b")]


def test_append_creates_missing_table(spark, scratch):
    path = scratch("new")
    df = spark.range(4).selectExpr("id", "id % 2 AS month")
    SK.append_parquet(spark, df, path, keys=["id"], partition_by=["month"])
    SK.append_parquet(spark, df, path, keys=["id"], partition_by=["month"])
    assert spark.read.parquet(path).count() == 4


def test_code_csv_round_trip(spark, scratch):
    path = scratch("codes")
    codes = spark.createDataFrame([(101, "ALBION, NORTH"), (103, "INVALID: NOWHERE")], SC.COUNTRY_CODES)
    SK.write_code_csv(codes, path)
    back = R.scan_csv(spark, path, SC.COUNTRY_CODES)
    assert sorted(tuple(r) for r in back.collect()) == [(101, "ALBION, NORTH"), (103, "INVALID: NOWHERE")]


def test_semicolon_csv_and_na_stays_text(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text("City;Continent;Pop\nAustin;NA;10\nBoston;;x\n")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("City", T.StringType()), T.StructField("Continent", T.StringType()),
                           T.StructField("Pop", T.IntegerType())])
    got = [tuple(r) for r in R.scan_csv_delimited(spark, str(p), schema).orderBy("City").collect()]
    assert got == [("Austin", "NA", 10), ("Boston", None, None)]


def test_typed_frame_by_position(spark):
    raw = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("ident", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    assert [tuple(r) for r in R.typed_frame(raw, schema).collect()] == [(1, "x", 2.5)]
    with pytest.raises(ValueError):
        R.typed_frame(raw.select("a"), schema)


def test_stream_increments_are_idempotent(spark, scratch):
    base = scratch("stream")
    schema = "k int, v string"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(f"{base}/in")
    spark.createDataFrame([(2, "b"), (3, "c")], schema).write.mode("append").parquet(f"{base}/in")
    df_schema = spark.createDataFrame([], schema).schema
    ST.append_increments(spark, f"{base}/in", df_schema, f"{base}/t", keys=["k"], checkpoint=f"{base}/ck")
    assert sorted(r.k for r in spark.read.parquet(f"{base}/t").collect()) == [1, 2, 3]
    # a new month arrives; the restarted stream only picks up the new file
    spark.createDataFrame([(3, "c"), (4, "d")], schema).write.mode("append").parquet(f"{base}/in")
    ST.append_increments(spark, f"{base}/in", df_schema, f"{base}/t", keys=["k"], checkpoint=f"{base}/ck")
    assert sorted(r.k for r in spark.read.parquet(f"{base}/t").collect()) == [1, 2, 3, 4]


def test_bounded_broadcast_checks_size(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    big = J.bounded_broadcast(spark.range(1000), max_rows=10)
    plan = fact.join(big, fact.k == big.id)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()
    small = J.bounded_broadcast(spark.range(10), max_rows=10)
    plan = fact.join(small, fact.k == small.id)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()


def test_size_checks_in_one_job(spark):
    assert J.fits_broadcast_all([spark.range(5), spark.range(50), spark.range(0)], max_rows=10) == [True, False, True]
    assert J.fits_broadcast_all([spark.range(5)], max_rows=0) == [False]


def test_apply_conf_sets_runtime_settings(spark):
    from starmart.session import apply_conf
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key, None)
    try:
        changed = apply_conf(spark, {key: "128m"})
        assert changed == {key: "128m"} and spark.conf.get(key) == "128m"
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def test_append_compares_keys_only_in_touched_partitions(spark, scratch):
    path = scratch("monthly")
    base = spark.range(300).selectExpr("id", "CAST(id % 30 AS INT) AS day", "id * 2 AS v")
    SK.write_parquet(base, path, partition_by=["day"])
    inc = spark.range(280, 320).selectExpr("id", "CAST(id % 30 AS INT) AS day", "id * 2 AS v")
    new = SK.new_rows(spark, inc, path, keys=["id"], within_partitions=["day"])
    assert sorted(r.id for r in new.collect()) == list(range(300, 320))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    SK.append_parquet(spark, inc, path, keys=["id"], partition_by=["day"], keys_within_partitions=True)
    SK.append_parquet(spark, inc, path, keys=["id"], partition_by=["day"], keys_within_partitions=True)
    assert spark.read.parquet(path).count() == 320


def test_size_checks_count_rows_and_bytes(spark):
    assert J.fits_broadcast(spark.range(5), 10**12)
    assert J.fits_broadcast_all([spark.range(5)], 10**12) == [True]
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS t", "array(id, id) AS a", "struct(id) AS s")
    assert J.fits_broadcast(wide, 10) and not J.fits_broadcast(wide, 9)
    assert J.fits_broadcast(wide, 10, 20_000) and not J.fits_broadcast(wide, 10, 9_000)


def test_append_touching_many_partitions(spark, scratch):
    path = scratch("daily")
    base = spark.range(2000).selectExpr("id", "CAST(id % 1000 AS INT) AS day", "id * 2 AS v")
    SK.write_parquet(base, path, partition_by=["day"])
    inc = spark.range(1500, 2500).selectExpr("id", "CAST(id % 1000 AS INT) AS day", "id * 2 AS v")
    for _ in range(2):
        SK.append_parquet(spark, inc, path, keys=["id"], partition_by=["day"], keys_within_partitions=True)
    got = spark.read.parquet(path)
    assert got.count() == 2500 and got.select("id").distinct().count() == 2500


def test_partitioned_write_makes_few_files(spark, scratch):
    import glob
    path = scratch("files")
    df = spark.range(20_000).selectExpr("id", "CAST(id % 50 AS INT) AS day").repartition(40)
    SK.write_parquet(df, path, partition_by=["day"])
    assert len(glob.glob(path.removeprefix("file:") + "/day=*/*.parquet")) <= 100


def test_repeated_and_conflicting_keys_in_an_increment(spark, scratch):
    path = scratch("conflict")
    inc = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, None), (2, "z"), (None, "q"), (None, "p")],
                                "k int, v string").repartition(4)
    for _ in range(2):
        SK.append_parquet(spark, inc, path, keys=["k"])
    assert sorted(map(str, map(tuple, spark.read.parquet(path).collect()))) == ["(1, 'a')", "(2, None)", "(None, 'p')"]


def test_stream_keeps_the_first_row_of_a_key(spark, scratch):
    base = scratch("stream-conflict")
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z")], "k int, v string").repartition(3)
    df.write.parquet(f"{base}/in")
    ST.append_increments(spark, f"{base}/in", df.schema, f"{base}/t", keys=["k"], checkpoint=f"{base}/ck")
    assert sorted(map(tuple, spark.read.parquet(f"{base}/t").collect())) == [(1, "a"), (2, "z")]


def test_stream_stops_and_raises_on_timeout(spark, scratch):
    base = scratch("stream-late")
    df = spark.createDataFrame([(i, "x") for i in range(50)], "k int, v string")
    for _ in range(6):
        df.write.mode("append").parquet(f"{base}/in")
    with pytest.raises(TimeoutError):
        ST.append_increments(spark, f"{base}/in", df.schema, f"{base}/t", keys=["k"], checkpoint=f"{base}/ck",
                             max_files_per_trigger=1, timeout_seconds=0.05)
    assert not spark.streams.active
    ST.append_increments(spark, f"{base}/in", df.schema, f"{base}/t", keys=["k"], checkpoint=f"{base}/ck")
    assert spark.read.parquet(f"{base}/t").count() == 50


AWKWARD = [(1, "  pad  "), (2, ""), (3, None), (4, 'He said "hi", there'), (5, "two\nlines; a\r\nthird"), (6, '"'), (7, ";,\t")]


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_gives_back_what_was_written(spark, scratch, sep):
    path = scratch("awkward")
    SK.write_code_csv(spark.createDataFrame(AWKWARD, SC.COUNTRY_CODES), path, sep=sep)
    back = R.scan_csv(spark, path, SC.COUNTRY_CODES, sep=sep, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == AWKWARD


def test_csv_as_other_programs_write_it(spark, tmp_path):
    import pandas as pd
    p = tmp_path / "p.csv"
    pd.DataFrame([r for r in AWKWARD if r[1] and "\r" not in r[1]], columns=["code", "country_name"]).to_csv(p, index=False)
    back = R.scan_csv(spark, str(p), SC.COUNTRY_CODES, multi_line=True)
    assert sorted(map(tuple, back.collect())) == [r for r in AWKWARD if r[1] and "\r" not in r[1]]


def test_malformed_rows_are_countable(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("code,country_name\n1,a\nx,b\n3,c,d\n")
    rows = R.scan_csv(spark, str(p), SC.COUNTRY_CODES, corrupt_column="bad").cache().collect()
    assert [(r.code, r.bad) for r in rows] == [(1, None), (None, "x,b"), (3, "3,c,d")]


def test_typed_frame_with_backticks(spark):
    raw = spark.createDataFrame([("1", "x")], ["a`b", "c.d"])
    assert [tuple(r) for r in R.typed_frame(raw, SC.COUNTRY_CODES).collect()] == [(1, "x")]


def test_scratch_is_cleaned(spark):
    from starmart import session as SE
    path = SE.scratch_path(spark, "gone")
    spark.range(1).write.parquet(path)
    files, cls = SE.file_system(spark, path)
    assert files.exists(cls(path)) and str(spark.sparkContext.applicationId) in path


def test_apply_conf_keeps_cluster_settings(spark):
    from starmart.session import apply_conf
    before = spark.conf.get("spark.sql.shuffle.partitions")  # set when the session was built
    assert apply_conf(spark, {"spark.sql.shuffle.partitions": "999"}) == {}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
