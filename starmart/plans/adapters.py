"""Adapters from the TPC-H-like test tables to the raw source schemas.

Each adapter is one projection (plus the joins that bring the needed columns
together), so the real builders run unchanged on the test tables and the
whole query can be restated in SQL for the oracle:

* immigration = lineitem ⋈ orders ⋈ customer ⋈ supplier ⋈ part:
  ``cicid = l_orderkey``, citizenship = customer nation, residence = supplier
  nation, port = part brand, arrival = order date, departure = ship date
  (NULL when ``l_suppkey % 7 = 2``, 0 when ``= 3``, NaN when ``= 4``; the
  arrival is NaN when ``l_suppkey % 11 = 5``), mode = ``l_linenumber``, visa =
  ``l_partkey % 5``, gender from the return flag (R→F, A→M, N→U),
  birth year ``1950 + p_size``, age ``66 - p_size``, visa type = line status;
* country codes = nations with an even key;
* port codes = the part brands: city = brand, state = brand number, no state
  for brand 1, brands 2 and 3 in non-US states;
* airports = parts (PROMO has no type, SMALL and LARGE become excluded
  types, municipality = brand); temperatures = events, a fifth of them moved
  to days around the first day kept; demographics = supplier ⋈ nation, without
  population where ``s_nationkey % 5 = 1``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, registered once per session as a temporary view.

    Later calls are catalog lookups: the view keeps the file index, so the
    files are not listed and their footers not read again for every query.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    view = f"starmart_{name}_{hashlib.sha1(path.encode()).hexdigest()[:10]}"
    if not spark.catalog.tableExists(view):
        spark.read.parquet(path).createOrReplaceTempView(view)
    return spark.table(view)


# moves January 2024 to the days around 1950-01-01
DAYS_BACK = 27042


def _days_since_1960(c) -> F.Column:
    return F.datediff(F.to_date(c), F.lit("1960-01-01").cast("date")).cast("double")


def _brand_number() -> F.Column:
    return F.substring_index(F.col("p_brand"), "#", -1)


def immigration(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    p = table(spark, sf_dir, "part")
    j = (l.join(o, l.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(s, l.l_suppkey == s.s_suppkey)
         .join(p, l.l_partkey == p.p_partkey))
    dep = (F.when(F.col("l_suppkey") % 7 == 2, F.lit(None).cast("double"))
           .when(F.col("l_suppkey") % 7 == 3, F.lit(0.0))
           .when(F.col("l_suppkey") % 7 == 4, F.lit(float("nan")))
           .otherwise(_days_since_1960("l_shipdate")))
    gender = (F.when(F.col("l_returnflag") == "R", "F").when(F.col("l_returnflag") == "A", "M")
              .when(F.col("l_returnflag") == "N", "U"))
    return j.select(
        F.col("l_orderkey").cast("double").alias("cicid"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.col("s_nationkey").cast("double").alias("i94res"),
        F.col("p_brand").alias("i94port"),
        F.when(F.col("l_suppkey") % 11 == 5, F.lit(float("nan"))).otherwise(_days_since_1960("o_orderdate"))
         .alias("arrdate"),
        F.col("l_linenumber").cast("double").alias("i94mode"),
        F.col("c_mktsegment").alias("i94addr"),
        dep.alias("depdate"),
        (F.lit(66) - F.col("p_size")).cast("double").alias("i94bir"),
        (F.col("l_partkey") % 5).cast("double").alias("i94visa"),
        (F.lit(1950) + F.col("p_size")).cast("double").alias("biryear"),
        gender.alias("gender"),
        F.col("l_linestatus").alias("visatype"),
    )


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") % 2 == 0).select(
        F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("country_name"))


def port_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    num = _brand_number()
    state = (F.when(num == "1", F.lit(None).cast("string")).when(num == "2", F.lit("CANADA"))
             .when(num == "3", F.lit("MX")).otherwise(F.concat(F.lit(" "), num)))
    return brands.select(F.col("p_brand").alias("code"),
                         F.concat(F.lower("p_brand"), F.lit("  ")).alias("port"),
                         state.alias("state_code"))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("ident"),
        F.when(F.col("p_type") == "PROMO", F.lit(None).cast("string"))
         .when(F.col("p_type") == "SMALL", F.lit(" heliport"))
         .when(F.col("p_type") == "LARGE", F.lit("closed "))
         .otherwise(F.lower("p_type")).alias("type"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(F.col("p_size") % 2 == 0, F.lit("us")).otherwise(F.lit("ca")).alias("iso_country"),
        F.concat(F.lit("US-"), _brand_number()).alias("iso_region"),
        F.when(F.col("p_name") == "red plate", F.lit(None).cast("string"))
         .otherwise(F.lower("p_brand")).alias("municipality"),
        F.col("p_type").alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        F.col("p_size").cast("string").alias("local_code"),
        F.concat(F.col("p_size").cast("string"), F.lit(", "), F.col("p_partkey").cast("string")).alias("coordinates"),
    )


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    city = F.concat(F.lit(" brand#"), (F.col("user_id") % 25 + 1).cast("string"), F.lit(" "))
    return e.select(
        F.date_format(F.when(F.col("user_id") % 5 == 0, F.date_sub(F.to_date("ts"), DAYS_BACK))
                      .otherwise(F.to_date("ts")), "yyyy-MM-dd").alias("dt"),
        F.col("value").alias("AverageTemperature"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
         .otherwise(F.col("value") / 10).alias("AverageTemperatureUncertainty"),
        city.alias("City"),
        F.when(F.col("user_id") % 10 == 3, F.lit("Canada")).otherwise(F.lit("United States")).alias("Country"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    num = (F.col("s_nationkey") + 1).cast("string")
    return j.select(
        F.concat(F.lit("  brand#"), num, F.lit(" ")).alias("City"),
        F.col("n_name").alias("State"),
        (F.col("s_suppkey") % 50 + 20).cast("double").alias("Median Age"),
        F.col("s_acctbal").alias("Male Population"),
        (F.col("s_acctbal") * 2).alias("Female Population"),
        F.when(F.col("s_nationkey") % 5 == 1, F.lit(0))
         .otherwise((F.col("s_suppkey") * 1000 + 65000).cast("int")).alias("Total Population"),
        (F.col("s_suppkey") % 100).cast("string").alias("Number of Veterans"),
        (F.col("s_suppkey") * 37 % 1000).cast("string").alias("Foreign-born"),
        (F.col("s_suppkey") % 30 / 10 + 1).alias("Average Household Size"),
        F.concat(F.lit(" "), num, F.lit(" ")).alias("State Code"),
        F.concat(F.lit(" race "), F.col("n_regionkey").cast("string")).alias("Race"),
        F.col("s_suppkey").cast("string").alias("Count"),
    )


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "immigration": immigration(spark, sf_dir),
        "country_codes": country_codes(spark, sf_dir),
        "port_codes": port_codes(spark, sf_dir),
        "temperature": temperature(spark, sf_dir),
        "airports": airports(spark, sf_dir),
        "demographics": demographics(spark, sf_dir),
    }


def _section(df: DataFrame, number: int, tag: str, line: F.Column) -> DataFrame:
    """A section of the label file, from a small table (one row per code)."""
    lines = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    return df.agg(F.concat(F.lit(f"/* {tag} - codes */\n  value list\n"), lines, F.lit("\n;\n")).alias("text")).select(
        F.lit(number).alias("number"), "text")


def write_label_file(spark: SparkSession, sf_dir: str, path: str) -> str:
    """A label file with the five sections: even nations as countries, part brands as ports (brand 1 without a state),
    regions as modes and visas, nations as states."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    num = _brand_number()
    state = (F.when(num == "1", F.lit("")).when(num == "2", F.lit(", CANADA")).when(num == "3", F.lit(", MX"))
             .otherwise(F.concat(F.lit(", "), num)))

    def pair(code, value):
        return F.concat(F.lit("   "), code, F.lit("\t=\t'"), value, F.lit("  '"))

    quoted = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    parts = [
        _section(n.filter(F.col("n_nationkey") % 2 == 0), 1, "I94CIT & I94RES",
                 pair(F.col("n_nationkey").cast("string"), F.col("n_name"))),
        _section(brands, 2, "I94PORT", pair(quoted(F.col("p_brand")), F.concat(F.lower("p_brand"), F.lit("  "), state))),
        _section(r, 3, "I94MODE", pair(F.col("r_regionkey").cast("string"), F.col("r_name"))),
        _section(n, 4, "I94ADDR", pair(quoted(F.concat(F.lit("S"), F.col("n_nationkey").cast("string"))), F.col("n_name"))),
        _section(r, 5, "I94BIR", pair(F.col("r_regionkey").cast("string"), F.lower("r_name"))),
    ]
    sections = parts[0]
    for p in parts[1:]:
        sections = sections.unionByName(p)
    text = sections.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "text"))),
                                                 lambda s: s["text"]), "").alias("value"))  # five rows
    text.coalesce(1).write.text(path)
    return path
