import datetime as dt

from pyspark.sql import functions as F

from starmart.functions import columns as C
from starmart.functions import constants as K
from starmart.functions import predicates as P


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_decode_labels_and_default(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (9.0,), (7.0,), (None,)], "m double")
    out = [r[0] for r in df.select(C.decode("m", K.MODE_LABELS)).collect()]
    assert out == ["Air", "Sea", "Land", "Not reported", "N/A", "N/A"]


def test_cast_int_truncates(spark):
    df = spark.createDataFrame([(20545.9,), (-1.7,), (None,)], "d double")
    assert [r[0] for r in df.select(C.cast_int("d")).collect()] == [20545, -1, None]


def test_numbers_outside_the_range_cast_as_without_ansi(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan,), (inf,), (-inf,), (1e300,), (-0.9,), (None,)], "d double")
    assert [r[0] for r in df.select(C.cast_int("d")).collect()] == [0, 2**31 - 1, -2**31, 2**31 - 1, 0, None]
    one = spark.createDataFrame([(nan,), (None,)], "d double")
    assert [r[0] for r in one.select(C.epoch_day_to_date("d")).collect()] == [dt.date(1960, 1, 1), None]
    assert [r[0] for r in one.select(C.epoch_day_to_date_or_marker("d")).collect()] == ["N/A", None]
    assert [r[0] for r in one.select(C.epoch_day_to_date_or_marker("d", marker=None)).collect()] == [None, None]


def test_epoch_day_to_date(spark):
    df = spark.createDataFrame([(20545.0,), (0.0,)], "d double")
    got = [r[0] for r in df.select(C.epoch_day_to_date("d")).collect()]
    assert got == [dt.date(1960, 1, 1) + dt.timedelta(days=20545), dt.date(1960, 1, 1)]


def test_epoch_day_to_date_or_marker(spark):
    df = spark.createDataFrame([(20550.0,), (None,), (0.0,), (-3.0,), (1.0,)], "d double")
    with_marker = [r[0] for r in df.select(C.epoch_day_to_date_or_marker("d")).collect()]
    assert with_marker == [str(dt.date(1960, 1, 1) + dt.timedelta(days=20550)), None, "N/A", "N/A", "1960-01-02"]
    as_date = df.select(C.epoch_day_to_date_or_marker("d", marker=None).alias("x"))
    assert dict(as_date.dtypes)["x"] == "date"
    assert [r[0] for r in as_date.collect()] == [dt.date(2016, 4, 6), None, None, None, dt.date(1960, 1, 2)]


def test_trim_versus_strip(spark):
    df = spark.createDataFrame([(" \tarlington \n",), ("  a b  ",), (None,)], "s string")
    got = rows(df.select(C.upper_trim("s"), C.strip_upper("s")))
    assert got == [("\tARLINGTON \n", "ARLINGTON"), ("A B", "A B"), (None, None)]


def test_split_after_first(spark):
    df = spark.createDataFrame([("US-OR",), ("US-U-A",), ("XX",), (" US-CA ",), (None,)], "s string")
    assert [r[0] for r in df.select(C.split_after_first("s")).collect()] == ["OR", "U-A", None, "CA", None]


def test_split_coordinates(spark):
    df = spark.createDataFrame([("-122.5, 45.25",), ("bad",), (None,), ("1.5, x",)], "s string")
    lon, lat = C.split_coordinates("s")
    assert rows(df.select(lon, lat)) == [(-122.5, 45.25), (None, None), (None, None), (1.5, None)]


def test_parse_date_and_timestamp(spark):
    df = spark.createDataFrame([("1950-02-01",), ("nonsense",)], "s string")
    assert [r[0] for r in df.select(C.parse_date("s")).collect()] == [dt.date(1950, 2, 1), None]
    ts = df.select(C.parse_date("s", as_timestamp=True).alias("t"))
    assert dict(ts.dtypes)["t"] == "timestamp"


def test_fill_missing_and_age(spark):
    df = spark.createDataFrame([(None, 1980.0), ("x", None)], "s string, b double")
    assert rows(df.select(C.fill_missing("s"), C.age_at_year("b", 2016))) == [("", 36.0), ("x", None)]


def test_predicates_null_behaviour(spark):
    df = spark.createDataFrame([(" closed ",), ("small",), (None,)], "t string")
    kept = [r[0] for r in df.filter(P.not_in_keep_null("t", ["closed"])).collect()]
    assert kept == ["small", None]
    # SQL NOT IN: no stripping, and a NULL is dropped
    assert [r[0] for r in df.filter(P.not_in("t", ["closed"])).collect()] == [" closed ", "small"]
    c = spark.createDataFrame([("us",), ("CA",), (None,), ("USA",)], "c string")
    assert [r[0] for r in c.filter(P.contains_upper("c", "US")).collect()] == ["us", "USA"]


def test_date_after_is_strict(spark):
    df = spark.createDataFrame([(dt.date(1950, 1, 1),), (dt.date(1950, 2, 1),)], "d date")
    assert [r[0] for r in df.filter(P.date_after("d", "1950-01-01")).collect()] == [dt.date(1950, 2, 1)]


def test_is_missing_counts_nan_only_when_asked(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert df.filter(P.is_missing("x")).count() == 1
    assert df.filter(P.is_missing("x", numeric_nan=True)).count() == 2
    assert df.filter(F.col("x").isNull()).count() == 1


def test_insert_coordinates_at_positions(spark):
    from starmart.operators.projections import insert_columns
    cols = [f"c{i}" for i in range(12)] + ["coordinates"]
    df = spark.createDataFrame([tuple(["x"] * 12 + ["-122.5, 45.25"])], ", ".join(f"{c} string" for c in cols))
    lon, lat = C.split_coordinates("coordinates")
    out = insert_columns(df, 12, {"longitude": lon, "latitude": lat})
    assert out.columns[12:] == ["longitude", "latitude", "coordinates"]
    assert tuple(out.collect()[0])[12:14] == (-122.5, 45.25)
