"""End-to-end star builds on hand-written inputs (FIXTURES A1, A2, A4-A6)."""

import datetime as dt

import pytest

from starmart.plans import star
from starmart.sources import schemas as SC

EPOCH = dt.date(1960, 1, 1)


def day(n):
    return EPOCH + dt.timedelta(days=n)


#        cicid cit  res  port   arr      mode  addr  dep     bir   visa biryear gender visatype
IMMIGRATION_ROWS = [
    (1.0, 101.0, 102.0, "AAA", 20545.0, 1.0, "CA", 20550.0, 36.0, 2.0, 1980.0, "F", "B2"),
    (2.0, 101.0, 101.0, "AAA", 20545.0, 1.0, "CA", None, 26.0, 1.0, 1990.0, "M", "B1"),
    (3.0, 101.0, 101.0, "BBB", 20546.0, 1.0, "CA", 0.0, 15.0, 3.0, 2000.0, "F", "F1"),
    (4.0, 101.0, 101.0, "AAA", 20545.0, 1.0, "CA", 20545.0, 46.0, 7.0, 1970.0, "M", "XX"),
    (5.0, 101.0, 101.0, "AAA", 20545.0, 1.0, "CA", 20540.0, 46.0, 2.0, 1970.0, "M", "B2"),
    (6.0, 101.0, 101.0, "AAA", 20545.0, 2.0, "CA", 20550.0, 46.0, 2.0, 1970.0, "M", "B2"),
    (7.0, 101.0, 101.0, "AAA", 20545.0, None, "CA", 20550.0, 46.0, 2.0, 1970.0, "M", "B2"),
    (8.0, 101.0, 101.0, "AAA", 20545.0, 1.0, "CA", 20550.0, 46.0, 2.0, 1970.0, "U", "B2"),
    (9.0, 101.0, 101.0, "AAA", 20545.0, 1.0, "CA", 20550.0, 46.0, 2.0, 1970.0, None, "B2"),
    (10.0, 999.0, 101.0, "AAA", 20545.0, 1.0, "CA", 20550.0, 46.0, 2.0, 1970.0, "F", "B2"),
    (11.0, 101.0, 999.0, "AAA", 20545.0, 1.0, "CA", 20550.0, 46.0, 2.0, 1970.0, "F", "B2"),
    (12.0, 101.0, 101.0, "ZZZ", 20545.0, 1.0, "CA", 20550.0, 46.0, 2.0, 1970.0, "F", "B2"),
    (13.0, 103.0, 101.0, "AAA", 20545.9, 1.0, "CA", 20550.0, None, 2.0, None, "F", "B2"),
]


@pytest.fixture()
def sources(spark):
    cols = ["cicid", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr", "depdate", "i94bir",
            "i94visa", "biryear", "gender", "visatype"]
    im = spark.createDataFrame(IMMIGRATION_ROWS, SC.IMMIGRATION).select(*cols)
    countries = spark.createDataFrame([(101, "ALBION"), (102, "BOREA"), (103, "INVALID: NOWHERE")], SC.COUNTRY_CODES)
    ports = spark.createDataFrame([("AAA", "SPRINGVILLE", "OR"), ("BBB", "LAKESIDE", "VA #ARPT"),
                                   ("EEE", "TORONTO", "CANADA"), ("FFF", "NOWHERE", None)], SC.PORT_CODES)
    return im, star.build_country_codes(countries), star.build_port_codes(ports)


def test_fact_rows_and_values(sources):
    fact = star.build_fact(*sources)
    assert fact.columns == star.FACT_COLUMNS
    got = {r.cicid: r for r in fact.collect()}
    assert sorted(got) == [1.0, 2.0, 3.0, 4.0, 5.0, 13.0]
    r1 = got[1.0]
    assert (r1.citizenship_country, r1.residence_country, r1.arrival_date, r1.departure_date, r1.visa_type, r1.age,
            r1.city, r1.state, r1.detailed_visa_type) == \
        ("ALBION", "BOREA", day(20545), str(day(20550)), "Pleasure", 36.0, "SPRINGVILLE", "OR", "B2")
    assert got[2.0].departure_date is None and got[2.0].visa_type == "Business"
    assert got[3.0].departure_date == "N/A" and got[3.0].visa_type == "Student" and got[3.0].age == 16.0
    assert got[3.0].state == "VA #ARPT"
    assert got[4.0].visa_type == "N/A" and got[4.0].departure_date == str(day(20545))
    assert got[13.0].citizenship_country == "INVALID: NOWHERE" and got[13.0].age is None
    assert got[13.0].arrival_date == day(20545)  # cast truncates 20545.9


def test_fact_marker_none_gives_dates(sources):
    fact = star.build_fact(*sources, marker=None)
    assert dict(fact.dtypes)["departure_date"] == "date"
    got = {r.cicid: r.departure_date for r in fact.collect()}
    assert got[3.0] is None and got[1.0] == day(20550)


def test_fact_require_valid_stay(sources):
    fact = star.build_fact(*sources, require_valid_stay=True)
    assert sorted(r.cicid for r in fact.collect()) == [1.0, 4.0, 13.0]


def test_fact_plan_broadcasts_code_tables_and_has_no_python(sources):
    fact = star.build_fact(*sources)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_dim_temperature(spark):
    rows = [
        ("1950-01-01", 1.0, 0.1, "Arlington", "United States"),   # the day itself is dropped
        ("1950-02-01", 2.0, 0.2, " arlington ", "United States"),
        ("1950-02-01", 4.0, None, "Arlington", "United States"),   # same city and day after cleaning
        ("1950-02-01", 9.0, 0.9, "Arlington", "Canada"),          # other country
        ("1950-03-01", None, None, "Boston", "United States"),     # only missing readings
    ]
    t = spark.createDataFrame(rows, SC.TEMPERATURE)
    got = {(r.date, r.city): (r.average_temperature, r.average_temperature_uncertainty)
           for r in star.build_dim_temperature(t).collect()}
    assert got == {(dt.date(1950, 2, 1), "ARLINGTON"): (3.0, 0.2), (dt.date(1950, 3, 1), "BOSTON"): (None, None)}
    ts = star.build_dim_temperature(t, as_timestamp=True)
    assert dict(ts.dtypes)["date"] == "timestamp"


def test_dim_airports(spark):
    def ap(ident, typ, country, region, city, coords="-122.5, 45.25"):
        return (ident, typ, "n", 10.0, "NA", country, region, city, None, None, None, coords)
    rows = [
        ap("1", "small_airport", "US", "US-OR", "portland"),
        ap("2", "heliport", "US", "US-OR", "portland"),      # excluded type
        ap("3", " closed ", "US", "US-OR", "portland"),      # excluded after strip
        ap("4", None, "us", "US-CA", "fresno"),              # missing type stays
        ap("5", "small_airport", None, "US-CA", "fresno"),   # no country
        ap("6", "small_airport", "CA", "CA-ON", "toronto"),  # other country
        ap("7", "small_airport", "US", "US-OR", None),       # no city
        ap("8", "small_airport", "US", "US-U-A", "x"),       # region of length 6
    ]
    a = star.build_dim_airports(spark.createDataFrame(rows, SC.AIRPORTS))
    got = sorted((r.ident, r.municipality, r.len, r.state, r.continent) for r in a.collect())
    assert got == [("1", "PORTLAND", 5, "OR", "NA"), ("4", "FRESNO", 5, "CA", "NA")]


def test_dim_demographics(spark):
    rows = [(" arlington ", "Texas", 32.5, 1.0, 2.0, 100, "5", "10", 2.5, " tx", "white ", "7"),
            ("Arlington", "Texas", 32.5, 1.0, 2.0, 100, "5", "10", 2.5, "TX", "Asian", "3"),
            ("Arlington", "Virginia", 34.0, None, None, None, None, None, None, "VA", "white", None)]
    d = star.build_dim_demographics(spark.createDataFrame(rows, SC.DEMOGRAPHICS))
    assert "number_of_veterans" not in d.columns and len(d.columns) == 11
    got = sorted((r.city, r.state_code, r.race) for r in d.collect())
    assert got == [("ARLINGTON", "TX", "ASIAN"), ("ARLINGTON", "TX", "WHITE"), ("ARLINGTON", "VA", "WHITE")]


def test_run_etl_writes_and_checks(spark, scratch, sources):
    im, countries, ports = sources
    t = spark.createDataFrame([("1950-02-01", 2.0, 0.2, "Springville", "United States")], SC.TEMPERATURE)
    a = spark.createDataFrame([("1", "small_airport", "n", 1.0, "NA", "US", "US-OR", "springville", None, None,
                                None, "1, 2")], SC.AIRPORTS)
    d = spark.createDataFrame([("Springville", "Oregon", 30.0, 1.0, 1.0, 10, "1", "1", 2.0, "OR", "White", "1")],
                              SC.DEMOGRAPHICS)
    src = {"immigration": im, "country_codes": countries, "port_codes": ports, "temperature": t,
           "airports": a, "demographics": d}
    out = scratch("etl")
    stats = star.run_etl(spark, src, out)
    counts = {r.table_name: r.row_count for r in stats.select("table_name", "row_count").distinct().collect()}
    assert counts == {"fact_immigration": 6, "dim_temperature": 1, "dim_airports": 1, "dim_demographics": 1}
    with pytest.raises(Exception):
        star.run_etl(spark, src, out)  # default mode refuses to overwrite
    from starmart.operators.quality import check_all
    res = check_all(star.read_star(spark, out), "fact_immigration", star.FACT_KEYS, star.DIMENSION_KEYS)
    cov = {r.dimension: (r.fact_keys, r.matched_keys) for r in res["coverage"].collect()}
    assert cov == {"dim_airports": (2, 1), "dim_demographics": (2, 1)}
    verdict = {r.table_name: r.status for r in res["verdicts"].collect()}
    assert verdict["fact_immigration"] == "failed"  # NULL departure and age
    assert verdict["dim_temperature"] == "passed"


def test_run_etl_partitions_the_fact(spark, scratch, sources):
    im, countries, ports = sources
    empty_t = spark.createDataFrame([], SC.TEMPERATURE)
    empty_a = spark.createDataFrame([], SC.AIRPORTS)
    empty_d = spark.createDataFrame([], SC.DEMOGRAPHICS)
    src = {"immigration": im, "country_codes": countries, "port_codes": ports, "temperature": empty_t,
           "airports": empty_a, "demographics": empty_d}
    out = scratch("etl-part")
    star.run_etl(spark, src, out, partition_fact_by=["arrival_date"])
    fact = spark.read.parquet(f"{out}/fact_immigration")
    assert fact.count() == 6
    pruned = fact.filter(fact.arrival_date == day(20546))
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(arrival_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_fact_with_shuffled_salted_lookups_is_unchanged(sources):
    expected = sorted(tuple(r) for r in star.build_fact(*sources).collect())
    salted = star.build_fact(*sources, broadcast_max_rows=1, salt_buckets=4)  # code tables "too large"
    assert sorted(tuple(r) for r in salted.collect()) == expected


def _small_sources(spark, sources, **other):
    im, countries, ports = sources
    src = {"immigration": im, "country_codes": countries, "port_codes": ports,
           "temperature": spark.createDataFrame([("1950-02-01", 2.0, 0.2, "Springville", "United States")], SC.TEMPERATURE),
           "airports": spark.createDataFrame([], SC.AIRPORTS), "demographics": spark.createDataFrame([], SC.DEMOGRAPHICS)}
    return {**src, **other}


def test_a_failed_build_leaves_nothing_and_can_be_repeated(spark, scratch, sources):
    out = scratch("etl-fail")
    bad = spark.createDataFrame([("no day", 2.0, 0.2, "Springville", "United States")], SC.TEMPERATURE)
    with pytest.raises(Exception, match="not a date: no day"):
        star.run_etl(spark, _small_sources(spark, sources, temperature=bad), out)
    from starmart.session import file_system
    files, path = file_system(spark, out)
    left = [f.getPath().getName() for f in files.globStatus(path(out + "*")) or []]
    assert left == []
    star.run_etl(spark, _small_sources(spark, sources), out)
    assert star.read_star(spark, out)["fact_immigration"].count() == 6
    star.run_etl(spark, _small_sources(spark, sources), out, mode="overwrite")
    assert star.read_star(spark, out)["fact_immigration"].count() == 6
    with pytest.raises(ValueError, match="update_star"):
        star.run_etl(spark, _small_sources(spark, sources), out, mode="append")


def test_update_star_in_months(spark, scratch, sources):
    im = sources[0]
    whole, parts = scratch("whole"), scratch("parts")
    star.run_etl(spark, _small_sources(spark, sources), whole)
    april = im.filter(im.arrdate < 20546)
    for rows in (april, im, im):
        star.update_star(spark, _small_sources(spark, (rows, *sources[1:])), parts, partition_fact_by=["arrival_date"])
    got, want = star.read_star(spark, parts), star.read_star(spark, whole)
    for name in star.STAR_TABLES:
        columns = want[name].columns
        assert sorted(map(str, got[name].select(columns).collect())) == sorted(map(str, want[name].collect())), name


def test_unparsable_dates_can_be_dropped(spark):
    rows = [("no day", 2.0, 0.2, "Springville", "United States"), ("1950-02-01", 2.0, 0.2, "Springville", "United States")]
    assert star.build_dim_temperature(spark.createDataFrame(rows, SC.TEMPERATURE), strict_dates=False).count() == 1
