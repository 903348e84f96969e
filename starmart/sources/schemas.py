"""Declared schemas of the raw sources and the code tables.

Applied by position, like a CSV header that is replaced; the names are the
corrected spellings (``ident``, not the original's ``indent``).
"""

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STR, DBL, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()

IMMIGRATION = _s(("cicid", DBL), ("i94cit", DBL), ("i94res", DBL), ("i94port", STR), ("arrdate", DBL),
                 ("i94mode", DBL), ("i94addr", STR), ("depdate", DBL), ("i94bir", DBL), ("i94visa", DBL),
                 ("biryear", DBL), ("gender", STR), ("visatype", STR))

TEMPERATURE = _s(("dt", STR), ("AverageTemperature", DBL), ("AverageTemperatureUncertainty", DBL),
                 ("City", STR), ("Country", STR))

AIRPORTS = _s(("ident", STR), ("type", STR), ("name", STR), ("elevation_ft", DBL), ("continent", STR),
              ("iso_country", STR), ("iso_region", STR), ("municipality", STR), ("gps_code", STR),
              ("iata_code", STR), ("local_code", STR), ("coordinates", STR))

DEMOGRAPHICS = _s(("City", STR), ("State", STR), ("Median Age", DBL), ("Male Population", DBL),
                  ("Female Population", DBL), ("Total Population", INT), ("Number of Veterans", STR),
                  ("Foreign-born", STR), ("Average Household Size", DBL), ("State Code", STR),
                  ("Race", STR), ("Count", STR))

COUNTRY_CODES = _s(("code", LONG), ("country_name", STR))
PORT_CODES = _s(("code", STR), ("port", STR), ("state_code", STR))

# Test-table schemas used by the CSV round trips.
CUSTOMER = _s(("c_custkey", LONG), ("c_name", STR), ("c_nationkey", INT), ("c_acctbal", DBL), ("c_mktsegment", STR))
CUSTOMER_RENAMED = _s(("customer_key", LONG), ("customer_name", STR), ("nation_key", INT), ("balance", DBL),
                      ("segment", STR))
SUPPLIER = _s(("s_suppkey", LONG), ("s_name", STR), ("s_nationkey", INT), ("s_acctbal", DBL))
