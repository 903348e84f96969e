"""The stated-purpose queries on a hand-written star."""

import datetime as dt

import pytest

from starmart.plans import insights as I


@pytest.fixture()
def fact(spark):
    d = dt.date
    rows = [(1.0, d(2016, 4, 1), "SPRINGVILLE", "OR"), (2.0, d(2016, 4, 2), "SPRINGVILLE", "OR"),
            (3.0, d(2016, 5, 1), "SPRINGVILLE", "OR"), (4.0, d(2016, 4, 9), "LAKESIDE", "VA"),
            (5.0, d(2016, 4, 9), "NOWHERE", None)]
    return spark.createDataFrame(rows, "cicid double, arrival_date date, city string, state string")


def test_by_month_and_port(fact):
    assert sorted(tuple(r) for r in I.arrivals_by_month(fact).collect()) == [(2016, 4, 4), (2016, 5, 1)]
    got = {(r.city, r.state): r.visitors for r in I.arrivals_by_port(fact).collect()}
    assert got == {("SPRINGVILLE", "OR"): 3, ("LAKESIDE", "VA"): 1, ("NOWHERE", None): 1}


def test_by_demographics_uses_one_row_per_city(spark, fact):
    demo = spark.createDataFrame(
        [("SPRINGVILLE", "OR", 1000, "250", "WHITE"), ("SPRINGVILLE", "OR", 1000, "250", "ASIAN"),
         ("LAKESIDE", "VA", 400, None, "WHITE"), ("NOWHERE", "ZZ", 0, "3", "WHITE")],
        "city string, state_code string, total_population int, foreign_born string, race string")
    got = {r.city: (r.visitors, r.total_population, r.foreign_born_percent)
           for r in I.arrivals_by_demographics(fact, demo).collect()}
    assert got == {"SPRINGVILLE": (3, 1000, 25.0), "LAKESIDE": (1, 400, None)}


def test_by_temperature_meets_on_month_of_year(spark, fact):
    d = dt.date
    temp = spark.createDataFrame([(d(2012, 4, 1), "SPRINGVILLE", 10.0), (d(2013, 4, 1), "SPRINGVILLE", 12.0),
                                  (d(2013, 5, 1), "SPRINGVILLE", 15.0), (d(2013, 4, 1), "LAKESIDE", None)],
                                 "date date, city string, average_temperature double")
    got = {(r.city, r.month): (r.visitors, r.mean_temperature)
           for r in I.arrivals_by_temperature(fact, temp).collect()}
    assert got == {("SPRINGVILLE", 4): (2, 11.0), ("SPRINGVILLE", 5): (1, 15.0), ("LAKESIDE", 4): (1, None)}


def test_airports_per_city_keeps_cities_without_airports(spark, fact):
    airports = spark.createDataFrame([("SPRINGVILLE", "OR"), ("SPRINGVILLE", "OR"), ("ELSEWHERE", "OR")],
                                     "municipality string, state string")
    got = {(r.city, r.state): (r.visitors, r.airports) for r in I.airports_per_city(fact, airports).collect()}
    assert got == {("SPRINGVILLE", "OR"): (3, 2), ("LAKESIDE", "VA"): (1, 0), ("NOWHERE", None): (1, 0)}


def test_a_population_of_zero_has_no_share(spark, fact):
    demo = spark.createDataFrame([("LAKESIDE", "VA", 0, "5", "WHITE")],
                                 "city string, state_code string, total_population int, foreign_born string, race string")
    got = I.arrivals_by_demographics(fact, demo).collect()
    assert [(r.city, r.total_population, r.foreign_born_percent) for r in got] == [("LAKESIDE", 0, None)]
