"""Statistics per data file: bounded appends, profiles and key reports that read new files only."""

import pytest

from starmart.operators import profile as PR
from starmart.operators import quality as Q
from starmart.sources import file_stats as FS
from starmart.sources import sinks as SK


@pytest.fixture()
def files_read(monkeypatch):
    """The data files that each call of ``read_files`` was asked for."""
    calls, real = [], FS.read_files
    monkeypatch.setattr(FS, "read_files", lambda spark, path, files: calls.append(list(files)) or real(spark, path, files))
    return calls


def day(spark, n, size=200):
    """Keys in order of arrival, no date in them; every tenth v is NULL, every seventh w NaN."""
    return spark.range(n * size, (n + 1) * size).selectExpr(
        "id AS k", "CASE WHEN id % 10 <> 0 THEN id END AS v", "CASE WHEN id % 7 = 0 THEN double('NaN') ELSE id / 2 END AS w")


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_an_append_reads_a_bounded_share_of_the_files(spark, scratch, files_read):
    path = scratch("days")
    for n in range(6):
        SK.append_parquet(spark, day(spark, n), path, keys=["k"])
    present = FS.data_files(spark, path)
    assert len(present) >= 6
    FS.key_ranges(spark, path, ["k"])
    files_read.clear()
    SK.append_parquet(spark, day(spark, 6), path, keys=["k"])
    assert files_read == [[]]                                       # new keys: no stored file is read
    FS.key_ranges(spark, path, ["k"])
    files_read.clear()
    SK.append_parquet(spark, day(spark, 2).unionByName(day(spark, 7)), path, keys=["k"])
    assert len(files_read) == 1 and 1 <= len(files_read[0]) <= 2    # of day 2, and a gap up to day 7
    rows = spark.read.parquet(path)
    assert rows.count() == rows.select("k").distinct().count() == 8 * 200


def test_ranges_with_nulls_nans_and_several_keys(spark, scratch):
    path = scratch("odd")
    schema = "a double, b string, v int"
    first = [(None, None, 1), (float("nan"), "x", 2), (1.5, "é", 3), (-0.0, "", 4)]
    SK.write_parquet(spark.createDataFrame(first, schema).coalesce(1), path)
    again = [(None, None, 9), (float("nan"), "x", 9), (1.5, "é", 9), (0.0, "", 9), (None, "", 5), (2.0, None, 6)]
    SK.append_parquet(spark, spark.createDataFrame(again, schema), path, keys=["a", "b"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5, 6]
    assert FS.stored_unique_key(spark, path, ["a", "b"]).first().is_unique
    # another key type than the stored one: every file is compared
    other = spark.createDataFrame([(1, "é", 7)], "a int, b string, v int").selectExpr("CAST(a + 0.5 AS FLOAT) AS a", "b", "v")
    assert FS.files_with_keys(spark, path, other, ["a", "b"]) == FS.data_files(spark, path)


def test_partition_values_that_need_escapes(spark, scratch):
    path = scratch("esc") + "/a table %1"
    rows = [(1, "a b/c%:é[*]", 1), (2, "x=y", 2), (3, None, 3)]
    df = spark.createDataFrame(rows, "k int, p string, v int")
    SK.append_parquet(spark, df, path, keys=["k"], partition_by=["p"])
    SK.append_parquet(spark, df, path, keys=["k"], partition_by=["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == [(1, 1), (2, 2), (3, 3)]


def test_merged_profiles_equal_the_full_ones(spark, scratch, files_read):
    path = scratch("months")
    for n in range(3):
        SK.write_parquet(day(spark, n), path, mode="append")
        files_read.clear()
        got = FS.stored_profile(spark, path)
        assert sorted_rows(got) == sorted_rows(PR.null_profile(spark.read.parquet(path)))
        read = [f for call in files_read for f in call]
        assert 0 < len(read) < len(FS.data_files(spark, path)) or n == 0   # the new month alone
    files_read.clear()
    FS.stored_profile(spark, path)
    assert files_read == []
    assert got.schema == PR.null_profile(spark.read.parquet(path)).schema
    report = Q.check_nulls(None, "months", profile=got).collect()
    assert {r.column_name: r.status for r in report} == {"k": "passed", "v": "failed", "w": "passed"}


def test_profiles_of_an_empty_table_and_of_gone_files(spark, scratch):
    path = scratch("empty")
    SK.write_parquet(day(spark, 0).limit(0), path)
    assert sorted_rows(FS.stored_profile(spark, path)) == sorted_rows(PR.null_profile(spark.read.parquet(path)))
    assert tuple(FS.stored_unique_key(spark, path, ["k"]).first()) == (0, 0, True)
    SK.write_parquet(day(spark, 1), path, mode="append")
    FS.stored_profile(spark, path)
    FS.stored_unique_key(spark, path, ["k"])
    SK.write_parquet(day(spark, 2).limit(50), path, mode="overwrite")      # takes the statistics away, too
    assert sorted_rows(FS.stored_profile(spark, path)) == sorted_rows(PR.null_profile(spark.read.parquet(path)))
    assert tuple(FS.stored_unique_key(spark, path, ["k"]).first()) == (50, 50, True)


def test_key_reports_equal_the_full_ones(spark, scratch, files_read):
    path = scratch("keys")
    parts = [day(spark, 0), day(spark, 1), day(spark, 0).limit(30), day(spark, 2).unionByName(day(spark, 2).limit(5))]
    for n, part in enumerate(parts):
        SK.write_parquet(part.coalesce(2), path, mode="append")
        FS.key_ranges(spark, path, ["k"])
        files_read.clear()
        got = FS.stored_unique_key(spark, path, ["k"]).first()
        assert tuple(got) == tuple(Q.check_unique_key(spark.read.parquet(path), ["k"]).first())
        old = [f for call in files_read[1:] for f in call]
        assert bool(old) == (n == 2)                                # only the repeated day meets older files
    files_read.clear()
    assert tuple(FS.stored_unique_key(spark, path, ["k"]).first()) == tuple(got) and files_read == []


def test_a_file_that_went_is_counted_no_more(spark, scratch):
    from starmart.session import file_system
    path = scratch("gone")
    for n in range(3):
        SK.write_parquet(day(spark, n).coalesce(1), path, mode="append")
        FS.stored_unique_key(spark, path, ["k"])
        FS.stored_profile(spark, path)
    files, cls = file_system(spark, path)
    assert files.delete(cls(f"{path}/{FS.data_files(spark, path)[0]}"), False)
    spark.catalog.refreshByPath(path)
    assert tuple(FS.stored_unique_key(spark, path, ["k"]).first()) == (400, 400, True)
    assert {r.row_count for r in FS.stored_profile(spark, path).collect()} == {400}
