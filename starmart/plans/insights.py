"""Queries on the star for the stated purpose: how temperature, season, entry
port and city demographics relate to the number of visitors.

Every query aggregates the fact table first (one row per key after a
partially aggregated shuffle) and only then joins a dimension that was
aggregated to the same key, so no join sees a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _visitors(fact: DataFrame, *keys) -> DataFrame:
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("visitors"))


def arrivals_by_month(fact: DataFrame) -> DataFrame:
    """Visitors per year and month of arrival (season of travel)."""
    return _visitors(fact, F.year("arrival_date").alias("arrival_year"),
                     F.month("arrival_date").alias("arrival_month"))


def arrivals_by_port(fact: DataFrame) -> DataFrame:
    """Visitors per entry port city and state."""
    return _visitors(fact, "city", "state")


def arrivals_by_demographics(fact: DataFrame, demographics: DataFrame) -> DataFrame:
    """Visitors per city with its population and foreign-born share (NULL for a population of 0).

    The dimension has one row per (city, state, race); the city figures repeat
    on each, so they are reduced to one row per city and state first.
    """
    cities = demographics.groupBy("city", "state_code").agg(
        F.max("total_population").alias("total_population"),
        F.max(F.col("foreign_born").try_cast("double")).alias("foreign_born"))
    v = _visitors(fact, "city", "state")
    return (v.join(cities, (v.city == cities.city) & (v.state == cities.state_code), "inner")
            .select(v.city, v.state, "visitors", "total_population",
                    F.round(F.try_divide(F.col("foreign_born") * 100.0, F.col("total_population")), 4)
                    .alias("foreign_born_percent")))


def arrivals_by_temperature(fact: DataFrame, temperature: DataFrame, digits: int = 4) -> DataFrame:
    """Visitors per city and month of the year with that month's mean temperature.

    Temperatures and arrivals come from different years, so they meet on the
    month of the year.
    """
    v = _visitors(fact, "city", F.month("arrival_date").alias("month"))
    t = temperature.groupBy("city", F.month("date").alias("month")).agg(
        F.round(F.avg("average_temperature"), digits).alias("mean_temperature"))
    return v.join(t, ["city", "month"], "inner").select("city", "month", "visitors", "mean_temperature")


def airports_per_city(fact: DataFrame, airports: DataFrame) -> DataFrame:
    """Visitors per (city, state) next to the number of airports there."""
    v = _visitors(fact, "city", "state")
    a = airports.groupBy(F.col("municipality").alias("city"), "state").agg(
        F.count(F.lit(1)).alias("airports"))
    return (v.join(a, ["city", "state"], "left")
            .select("city", "state", "visitors", F.coalesce("airports", F.lit(0).cast("long")).alias("airports")))
