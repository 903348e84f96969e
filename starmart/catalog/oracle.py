"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

Written independently of the Spark code: the adapters and star builds are
restated as plain SQL. Dates are compared as DATE, integer widths are cast to
match Spark's, Spark's truncating double → int cast is written as ``trunc``,
and means are rounded to 4 digits on both sides.
"""

from __future__ import annotations


class K:
    """Fixed values, stated a second time so that a wrong one in the package shows."""

    SAS_EPOCH = "1960-01-01"
    REFERENCE_YEAR = 2016
    VISA_LABELS = {1: "Business", 2: "Pleasure", 3: "Student"}
    MODE_LABELS = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
    UNKNOWN_LABEL = "N/A"
    KEPT_GENDERS = ["F", "M"]
    AIR_MODE = 1
    # of the fixed non-US states, those that the test ports have
    NON_US_STATES = ["CANADA", "MX"]
    EXCLUDED_AIRPORT_TYPES = ["closed", "heliport", "seaplane_base", "balloonport"]
    TEMPERATURE_COUNTRY = "United States"
    TEMPERATURE_AFTER = "1950-01-01"
    REGION_CODE_LENGTH = 5
    AIRPORT_COUNTRY_TEXT = "US"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in_list(values) -> str:
    return ", ".join(_q(v) for v in values)


def strip(x: str) -> str:
    """All whitespace off both ends (pandas ``str.strip``)."""
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def trim_code(x: str) -> str:
    return f"trim(trim({strip(x)}, ''''), '\"')"


def trim_value(x: str) -> str:
    return strip(trim_code(x))


def after_first(x: str, sep: str) -> str:
    s = strip(x)
    return f"CASE WHEN strpos({s}, {_q(sep)}) > 0 THEN substr({s}, strpos({s}, {_q(sep)}) + 1) END"


def decode_sql(x: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {x} = {k} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {_q(K.UNKNOWN_LABEL)} END"


def exact_mean(x: str, decimals: int, digits: int) -> str:
    """Mean of ``x`` summed as DECIMAL, rounded half-up in decimal arithmetic
    (DuckDB's ``round`` on a DOUBLE misses ties such as 0.07125)."""
    return (f"CAST(round(CAST(avg(CAST({x} AS DECIMAL(30,{decimals}))) AS DECIMAL(38,10)), {digits}) AS DOUBLE)")


def epoch_date(days_int: str) -> str:
    return f"(DATE '{K.SAS_EPOCH}' + CAST({days_int} AS INTEGER))"


def date_or_marker(days_int: str) -> str:
    return (f"CASE WHEN {days_int} >= 1 THEN CAST({epoch_date(days_int)} AS VARCHAR) "
            f"WHEN {days_int} IS NULL THEN NULL ELSE {_q(K.UNKNOWN_LABEL)} END")


BRAND_NUMBER = "string_split(p_brand, '#')[-1]"

EVENTS_N = """SELECT event_id, CAST(ts AS DATE) AS day, nullif(user_id, 3) AS user_id,
  nullif(event_type, 'error') AS event_type, value, props FROM events"""
EVENTS_N_COLS = [("event_id", False), ("day", False), ("user_id", False), ("event_type", False),
                 ("value", True), ("props", False)]
ORDERS_COLS = [("o_orderkey", False), ("o_custkey", False), ("o_orderstatus", False), ("o_totalprice", True),
               ("o_orderdate", False), ("o_orderpriority", False)]

ORDERS_STORED = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders"""

PAIR_KEYS = "SELECT l_partkey, nullif(l_suppkey, 5) AS l_suppkey, l_returnflag, l_linestatus FROM lineitem"

MARKER_DAYS = """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber IN (3, 4) THEN 0 ELSE l_partkey END AS days FROM lineitem"""

SHIP_VS_ORDER = """SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS l_shipdate,
  CAST(o.o_orderdate AS DATE) AS o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

# ---------------------------------------------------------------- adapters as SQL

IMMIGRATION = f"""SELECT CAST(l.l_orderkey AS DOUBLE) AS cicid, CAST(c.c_nationkey AS DOUBLE) AS i94cit,
  CAST(s.s_nationkey AS DOUBLE) AS i94res, p.p_brand AS i94port,
  CASE WHEN l.l_suppkey % 11 = 5 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(date_diff('day', DATE '{K.SAS_EPOCH}', CAST(o.o_orderdate AS DATE)) AS DOUBLE) END AS arrdate,
  CAST(l.l_linenumber AS DOUBLE) AS i94mode, c.c_mktsegment AS i94addr,
  CASE WHEN l.l_suppkey % 7 = 2 THEN NULL WHEN l.l_suppkey % 7 = 3 THEN 0.0
       WHEN l.l_suppkey % 7 = 4 THEN CAST('NaN' AS DOUBLE)
       ELSE CAST(date_diff('day', DATE '{K.SAS_EPOCH}', CAST(l.l_shipdate AS DATE)) AS DOUBLE) END AS depdate,
  CAST(66 - p.p_size AS DOUBLE) AS i94bir, CAST(l.l_partkey % 5 AS DOUBLE) AS i94visa,
  CAST(1950 + p.p_size AS DOUBLE) AS biryear,
  CASE l.l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'M' WHEN 'N' THEN 'U' END AS gender,
  l.l_linestatus AS visatype
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey"""

COUNTRY = "SELECT CAST(n_nationkey AS BIGINT) AS code, n_name AS country_name FROM nation WHERE n_nationkey % 2 = 0"

PORT_RAW = f"""SELECT p_brand AS code, lower(p_brand) || '  ' AS port,
  CASE WHEN {BRAND_NUMBER} = '1' THEN NULL WHEN {BRAND_NUMBER} = '2' THEN 'CANADA'
       WHEN {BRAND_NUMBER} = '3' THEN 'MX' ELSE ' ' || {BRAND_NUMBER} END AS state_code
FROM (SELECT DISTINCT p_brand FROM part)"""

PORTS = f"""SELECT code, port, state_code FROM ({PORT_RAW})
WHERE state_code IS NOT NULL AND state_code NOT IN ({_in_list(K.NON_US_STATES)})"""

def as_int(x: str) -> str:
    return f"CASE WHEN isnan({x}) THEN 0 ELSE CAST(trunc({x}) AS INTEGER) END"


CLEAN_IMMIGRATION = f"""SELECT *, {as_int('arrdate')} AS arr_i, {as_int('depdate')} AS dep_i
FROM ({IMMIGRATION}) WHERE i94mode = {K.AIR_MODE} AND gender IN ({_in_list(K.KEPT_GENDERS)})"""

FACT = f"""WITH cl AS ({CLEAN_IMMIGRATION}), cc AS ({COUNTRY}), pc AS ({PORTS})
SELECT cl.cicid, c1.country_name AS citizenship_country, c2.country_name AS residence_country,
  {epoch_date('cl.arr_i')} AS arrival_date, {date_or_marker('cl.dep_i')} AS departure_date,
  {K.REFERENCE_YEAR} - cl.biryear AS age, cl.gender, trim(upper(pc.port)) AS city,
  trim(upper(pc.state_code)) AS state, {decode_sql('cl.i94visa', K.VISA_LABELS)} AS visa_type,
  cl.visatype AS detailed_visa_type
FROM cl JOIN cc c1 ON cl.i94cit = c1.code JOIN cc c2 ON cl.i94res = c2.code JOIN pc ON cl.i94port = pc.code"""

EXPLORE = f"""SELECT cicid, {epoch_date('arr_i')} AS arrival_date, {date_or_marker('dep_i')} AS departure_date,
  {decode_sql('i94visa', K.VISA_LABELS)} AS visa_type, {decode_sql('i94mode', K.MODE_LABELS)} AS arrival_modes
FROM ({CLEAN_IMMIGRATION}) WHERE dep_i >= 1 AND {epoch_date('dep_i')} >= {epoch_date('arr_i')}"""

TEMPERATURE_RAW = """SELECT strftime(CASE WHEN user_id % 5 = 0 THEN CAST(ts AS DATE) - 27042 ELSE CAST(ts AS DATE) END,
    '%Y-%m-%d') AS dt, value AS AverageTemperature,
  CASE WHEN event_type = 'error' THEN NULL ELSE value / 10 END AS AverageTemperatureUncertainty,
  ' brand#' || CAST(user_id % 25 + 1 AS VARCHAR) || ' ' AS City,
  CASE WHEN user_id % 10 = 3 THEN 'Canada' ELSE 'United States' END AS Country FROM events"""


def dim_temperature(digits: int | None) -> str:
    if digits is None:
        r = lambda e: f"avg({e})"
    else:  # exact decimal means, as the Spark side with ``decimals=3``
        r = lambda e: exact_mean(e, 3, digits)
    return f"""SELECT CAST(dt AS DATE) AS date, upper({strip('City')}) AS city,
  {r('AverageTemperature')} AS average_temperature,
  {r('AverageTemperatureUncertainty')} AS average_temperature_uncertainty
FROM ({TEMPERATURE_RAW}) WHERE Country = {_q(K.TEMPERATURE_COUNTRY)}
  AND CAST(dt AS DATE) > DATE '{K.TEMPERATURE_AFTER}' GROUP BY 1, 2"""


AIRPORTS_RAW = f"""SELECT CAST(p_partkey AS VARCHAR) AS ident,
  CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN ' heliport' WHEN p_type = 'LARGE' THEN 'closed '
       ELSE lower(p_type) END AS type,
  p_name AS name, p_retailprice AS elevation_ft, 'NA' AS continent,
  CASE WHEN p_size % 2 = 0 THEN 'us' ELSE 'ca' END AS iso_country,
  'US-' || {BRAND_NUMBER} AS iso_region,
  CASE WHEN p_name = 'red plate' THEN NULL ELSE lower(p_brand) END AS municipality,
  p_type AS gps_code, CAST(NULL AS VARCHAR) AS iata_code, CAST(p_size AS VARCHAR) AS local_code,
  CAST(p_size AS VARCHAR) || ', ' || CAST(p_partkey AS VARCHAR) AS coordinates FROM part"""

DIM_AIRPORTS = f"""SELECT ident, type, name, elevation_ft, continent, iso_country, iso_region,
  upper(municipality) AS municipality, gps_code, iata_code, local_code, coordinates,
  CAST(length(iso_region) AS INTEGER) AS len, {after_first('iso_region', '-')} AS state
FROM ({AIRPORTS_RAW})
WHERE contains(upper(coalesce(iso_country, '')), {_q(K.AIRPORT_COUNTRY_TEXT)})
  AND NOT coalesce({strip('type')} IN ({_in_list(K.EXCLUDED_AIRPORT_TYPES)}), false)
  AND municipality IS NOT NULL AND length(iso_region) = {K.REGION_CODE_LENGTH}"""

DEMOGRAPHICS_RAW = """SELECT '  brand#' || CAST(s_nationkey + 1 AS VARCHAR) || ' ' AS City, n_name AS State,
  CAST(s_suppkey % 50 + 20 AS DOUBLE) AS "Median Age", s_acctbal AS "Male Population",
  s_acctbal * 2 AS "Female Population", CASE WHEN s_nationkey % 5 = 1 THEN 0 ELSE CAST(s_suppkey * 1000 + 65000 AS INTEGER) END AS "Total Population",
  CAST(s_suppkey % 100 AS VARCHAR) AS "Number of Veterans", CAST(s_suppkey * 37 % 1000 AS VARCHAR) AS "Foreign-born",
  s_suppkey % 30 / 10 + 1 AS "Average Household Size",
  ' ' || CAST(s_nationkey + 1 AS VARCHAR) || ' ' AS "State Code",
  ' race ' || CAST(n_regionkey AS VARCHAR) AS Race, CAST(s_suppkey AS VARCHAR) AS Count
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

DIM_DEMOGRAPHICS = f"""SELECT upper({strip('City')}) AS city, State AS state, "Median Age" AS median_age,
  "Male Population" AS male_population, "Female Population" AS female_population,
  "Total Population" AS total_population, "Foreign-born" AS foreign_born,
  "Average Household Size" AS average_household_size, upper({strip('"State Code"')}) AS state_code,
  upper({strip('Race')}) AS race, Count AS count FROM ({DEMOGRAPHICS_RAW})"""

STAR_SCHEMAS = {
    "dim_demographics": [("city", "string"), ("state", "string"), ("median_age", "double"),
                         ("male_population", "double"), ("female_population", "double"),
                         ("total_population", "int"), ("foreign_born", "string"),
                         ("average_household_size", "double"), ("state_code", "string"), ("race", "string"),
                         ("count", "string")],
    "dim_temperature": [("date", "date"), ("city", "string"), ("average_temperature", "double"),
                        ("average_temperature_uncertainty", "double")],
    "dim_airports": [("ident", "string"), ("type", "string"), ("name", "string"), ("elevation_ft", "double"),
                     ("continent", "string"), ("iso_country", "string"), ("iso_region", "string"),
                     ("municipality", "string"), ("gps_code", "string"), ("iata_code", "string"),
                     ("local_code", "string"), ("coordinates", "string"), ("len", "int"), ("state", "string")],
    "fact_immigration": [("cicid", "double"), ("citizenship_country", "string"), ("residence_country", "string"),
                         ("arrival_date", "date"), ("departure_date", "string"), ("age", "double"),
                         ("gender", "string"), ("city", "string"), ("state", "string"), ("visa_type", "string"),
                         ("detailed_visa_type", "string")],
}
STAR_SQL = {"dim_demographics": DIM_DEMOGRAPHICS, "dim_temperature": dim_temperature(None),
            "dim_airports": DIM_AIRPORTS, "fact_immigration": FACT}


def star_with() -> str:
    return ", ".join(f"{name} AS ({sql})" for name, sql in STAR_SQL.items())


def visitors(keys: str) -> str:
    return f"SELECT {keys}, count(*) AS visitors FROM fact_immigration GROUP BY ALL"


# ---------------------------------------------------------------- generated profiles

def null_profile_sql(source: str, cols: list[tuple[str, bool]]) -> str:
    parts = []
    for i, (c, is_float) in enumerate(cols, start=1):
        nan = f"count(*) FILTER (WHERE isnan({c}))" if is_float else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS position, {_q(c)} AS column_name, "
                     f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, {nan} AS nan_count, "
                     f"count(*) FILTER (WHERE {c} IS NULL) + {nan} AS missing_count, count(*) AS row_count "
                     f"FROM ({source})")
    return "\nUNION ALL\n".join(parts)


def failed_columns_sql(source: str, cols) -> str:
    terms = " + ".join(f"CAST(count(*) FILTER (WHERE \"{c}\" IS NULL) > 0 AS BIGINT)" for c, *_ in cols)
    return f"SELECT {terms} AS failed_columns FROM ({source})"


def _status(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'passed' ELSE 'failed' END"


def _coverage_sql(fact: str, fact_keys: list[str], dims: dict[str, tuple[str, list[str]]]) -> str:
    fk = ", ".join(fact_keys)
    complete = " AND ".join(f"{k} IS NOT NULL" for k in fact_keys)
    parts = []
    for name, (dim, dim_keys) in dims.items():
        on = " AND ".join(f"f.{a} = d.{b}" for a, b in zip(fact_keys, dim_keys))
        parts.append(f"""SELECT {_q(name)} AS dimension,
  (SELECT count(*) FROM (SELECT DISTINCT {fk} FROM ({fact})) WHERE {complete}) AS fact_keys,
  (SELECT count(*) FROM (SELECT DISTINCT {fk} FROM ({fact})) f
     JOIN (SELECT DISTINCT {', '.join(dim_keys)} FROM ({dim})) d ON {on}) AS matched_keys""")
    return " UNION ALL ".join(parts)


def _schema_rows_sql(table: str) -> str:
    """Spark's type names for the parquet columns, from DuckDB's catalog."""
    spark_type = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
      WHEN 'FLOAT' THEN 'float' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date'
      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"""
    return f"""SELECT CAST(ordinal_position AS INTEGER) AS position, column_name, {spark_type} AS data_type,
  is_nullable = 'YES' AS nullable FROM information_schema.columns WHERE table_name = {_q(table)}"""


# ---------------------------------------------------------------- the twins

def awkward(key: str, name: str) -> str:
    return (f"CASE {key} % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || {name} || ' ' "
            f"WHEN 3 THEN 'He said \"' || {name} || '\", there' WHEN 4 THEN {name} || chr(10) || 'next; line' "
            f"WHEN 5 THEN 'a,b;' || {name} WHEN 6 THEN '\"' ELSE {name} END")


def sample_sql(table: str, cols: list[str]) -> str:
    """Schema rows, row count and the smallest row of a table."""
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    values = " UNION ALL ".join(f"SELECT {_q(c)} AS column_name, CAST({c} AS VARCHAR) AS sample_value FROM one" for c in cols)
    return f"""SELECT {_q(table)} AS table_name, s.*, (SELECT count(*) FROM {table}) AS row_count, v.sample_value
FROM ({_schema_rows_sql(table)}) s JOIN (WITH one AS (SELECT * FROM {table} ORDER BY {order} LIMIT 1) {values}) v
ON s.column_name = v.column_name"""


LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

ORACLE: dict[str, str] = {}

ORACLE.update({
    "scan_parquet": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "scan_csv": f"""SELECT c_custkey, {awkward('c_custkey', 'c_name')} AS c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "scan_csv_delimited": f"""SELECT s_suppkey, {awkward('s_suppkey', 's_name')} AS s_name, s_nationkey, s_acctbal
FROM supplier""",
    "typed_frame": """SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation_key,
  c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
    "write_code_csv": f"SELECT c_custkey AS code, {awkward('c_custkey', 'c_name')} AS country_name FROM customer",
    "write_parquet": ORDERS_STORED,
    "append_parquet": ORDERS_STORED,
    "append_increments_stream": ORDERS_STORED,
    "label_dictionary": "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS value FROM customer",
    "code_tables": f"""SELECT 'i94_country' AS table_name, CAST(n_nationkey AS VARCHAR) AS code, n_name AS value1,
  CAST(NULL AS VARCHAR) AS value2 FROM nation WHERE n_nationkey % 2 = 0
UNION ALL SELECT 'i94_port', p_brand, lower(p_brand), CASE {BRAND_NUMBER} WHEN '2' THEN 'CANADA' WHEN '3' THEN 'MX'
  ELSE {BRAND_NUMBER} END FROM (SELECT DISTINCT p_brand FROM part) WHERE {BRAND_NUMBER} <> '1'
UNION ALL SELECT 'i94_model', CAST(r_regionkey AS VARCHAR), r_name, NULL FROM region
UNION ALL SELECT 'i94_state_addrl', 'S' || CAST(n_nationkey AS VARCHAR), n_name, NULL FROM nation
UNION ALL SELECT 'i94_visa', CAST(r_regionkey AS VARCHAR), lower(r_name), NULL FROM region""",
    "parse_pairs": f"""WITH q AS (SELECT page_id, CASE WHEN strpos(url, '?') > 0 THEN substr(url, strpos(url, '?') + 1) END AS qs FROM pages),
items AS (SELECT page_id, unnest(string_split(qs, '&')) AS item FROM q WHERE qs IS NOT NULL),
kv AS (SELECT page_id, string_split(item, '=') AS parts FROM items)
SELECT page_id, {trim_code('parts[1]')} AS code, {trim_value('parts[2]')} AS value FROM kv WHERE len(parts) = 2""",
    "label_dictionary_pair": """SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS value1, c_mktsegment AS value2
FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "table_stats": " UNION ALL ".join([sample_sql("orders", [c for c, _ in ORDERS_COLS]),
                                       sample_sql("lineitem", LINEITEM_COLS)]),
    "register_view": "SELECT o_orderpriority, count(*) AS order_count FROM orders GROUP BY o_orderpriority",
    "preview": """SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
ORDER BY o_orderkey LIMIT 10""",
    "limit_rows": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_quantity LIMIT 20""",
})

ORACLE.update({
    "project_rename": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS priority FROM orders""",
    "add_column": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
  CAST(year(o_orderdate) AS BIGINT) AS order_year FROM orders""",
    "qualified_star": """SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS o_orderdate,
  c.c_name AS customer_name, c.c_mktsegment AS segment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "cast_int": """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 0 ELSE CAST(trunc(o_totalprice) AS INTEGER) END
  AS total_int FROM orders""",
    "age_at_year": f"SELECT o_orderkey, CAST({K.REFERENCE_YEAR} - year(o_orderdate) AS BIGINT) AS age FROM orders",
    "difference": f"""SELECT o_orderkey, CAST(({K.REFERENCE_YEAR} - year(o_orderdate)) - o_custkey % 10 AS BIGINT) AS difference
FROM orders""",
    "epoch_day_to_date": f"""SELECT l_orderkey, l_linenumber, l_partkey,
  {epoch_date('CASE WHEN l_linenumber = 4 THEN 0 ELSE l_partkey END')} AS day FROM lineitem""",
    "epoch_day_to_date_or_marker": f"""SELECT l_orderkey, l_linenumber, l_partkey, {date_or_marker('days')} AS day
FROM ({MARKER_DAYS})""",
    "count_marker": f"""SELECT count(*) FILTER (WHERE day = {_q(K.UNKNOWN_LABEL)}) AS marker_count
FROM (SELECT {date_or_marker('days')} AS day FROM ({MARKER_DAYS}))""",
    "decode_mode": f"SELECT l_orderkey, l_linenumber, {decode_sql('l_linenumber', K.MODE_LABELS)} AS arrival_mode FROM lineitem",
    "decode_visa": f"SELECT l_orderkey, l_linenumber, {decode_sql('l_linenumber', K.VISA_LABELS)} AS visa_type FROM lineitem",
    "upper_trim": "SELECT p_partkey, trim(upper('  ' || p_name || ' ')) AS name FROM part",
    "upper": "SELECT p_partkey, upper(p_name) AS name FROM part",
    "text_length": "SELECT o_orderkey, CAST(length(o_orderpriority) AS BIGINT) AS len FROM orders",
    "filter_length_eq": "SELECT o_orderkey, o_orderpriority FROM orders WHERE length(o_orderpriority) = 5",
    "distinct_expression": "SELECT DISTINCT CAST(length(o_orderpriority) AS BIGINT) AS len FROM orders",
    "split_after_first": f"SELECT o_orderkey, {after_first('o_orderpriority', '-')} AS priority_name FROM orders",
    "split_coordinates": """WITH c AS (SELECT p_partkey, CASE WHEN p_size > 45 THEN 'bad'
    ELSE CAST(p_size AS VARCHAR) || ', ' || CAST(p_partkey AS VARCHAR) END AS txt FROM part)
SELECT p_partkey, TRY_CAST(string_split(txt, ', ')[1] AS DOUBLE) AS lon,
  TRY_CAST(string_split(txt, ', ')[2] AS DOUBLE) AS lat FROM c""",
    "parse_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders",
    "filter_date_after": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1998-01-01'""",
    "filter_range_ge": "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.05",
    "fill_missing": f"""SELECT coalesce(event_type, '') AS event_type, count(*) AS count FROM ({EVENTS_N})
GROUP BY 1""",
})

ORACLE.update({
    "filter_is_null": f"SELECT event_id, user_id, event_type FROM ({EVENTS_N}) WHERE event_type IS NULL",
    "filter_not_null": f"SELECT event_id, user_id FROM ({EVENTS_N}) WHERE user_id IS NOT NULL",
    "filter_not_in_keep_null": f"""SELECT event_type, count(*) AS count FROM ({EVENTS_N})
WHERE NOT coalesce({strip('event_type')} IN ('click', 'view'), false) GROUP BY 1""",
    "count_where": f"SELECT count(*) FILTER (WHERE user_id IS NULL) AS row_count FROM ({EVENTS_N})",
    "filter_number_eq": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber = 1",
    "filter_text_eq": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_in": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')",
    "filter_not_in": "SELECT p_partkey, p_brand FROM part WHERE p_brand NOT IN ('Brand#1', 'Brand#2')",
    "filter_contains": """SELECT p_partkey, nullif(p_type, 'PROMO') AS p_type FROM part
WHERE contains(upper(coalesce(nullif(p_type, 'PROMO'), '')), 'AR')""",
    "filter_and": """SELECT c_custkey, c_nationkey, c_mktsegment FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3""",
    "filter_column_compare": f"SELECT * FROM ({SHIP_VS_ORDER}) WHERE l_shipdate <= o_orderdate",
    "check_date_order": f"""SELECT violations, {_status('violations = 0')} AS status FROM
(SELECT count(*) FILTER (WHERE l_shipdate <= o_orderdate) AS violations FROM ({SHIP_VS_ORDER}))""",
})

ORACLE.update({
    "lookup_join": f"""SELECT c.c_custkey, c.c_nationkey, cc.country_name AS nation_name
FROM customer c JOIN ({COUNTRY}) cc ON c.c_nationkey = cc.code""",
    "lookup_join_second_role": f"""WITH im AS ({IMMIGRATION}), cc AS ({COUNTRY})
SELECT im.cicid, im.i94mode, c1.country_name AS citizenship_country, c2.country_name AS residence_country
FROM im JOIN cc c1 ON im.i94cit = c1.code JOIN cc c2 ON im.i94res = c2.code""",
    "distinct_pair_join": f"""WITH k AS ({PAIR_KEYS}),
a AS (SELECT DISTINCT l_partkey, l_suppkey FROM k WHERE l_returnflag = 'R'),
b AS (SELECT DISTINCT l_partkey, l_suppkey FROM k WHERE l_returnflag <> 'R')
SELECT a.l_partkey, a.l_suppkey FROM a JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""",
    "in_subquery": """SELECT count(*) AS common_dates FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
WHERE d IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
})

ORACLE.update({
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "check_row_count": f"""SELECT 'orders' AS table_name, count(*) AS row_count, {_status('count(*) >= 0')} AS status FROM orders
UNION ALL SELECT 'lineitem', count(*), {_status('count(*) >= 1')} FROM lineitem""",
    "count_distinct": "SELECT count(DISTINCT o_custkey) AS distinct_count FROM orders",
    "count_distinct_pair": f"""SELECT count(DISTINCT (l_partkey, l_suppkey))
  FILTER (WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL) AS distinct_pairs FROM ({PAIR_KEYS})""",
    "distinct_rows_count": f"SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT l_partkey, l_suppkey FROM ({PAIR_KEYS}))",
    "min_max": "SELECT min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice FROM orders",
    "select_distinct": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "group_count": "SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY 1",
    "group_count_drop_null": f"""SELECT event_type, count(*) AS count FROM ({EVENTS_N})
WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "group_count_where": "SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_totalprice > 200000 GROUP BY 1",
    "group_count_ordered": "SELECT p_size, count(*) AS count FROM part WHERE p_size IS NOT NULL GROUP BY 1 ORDER BY 1",
    "group_count_multi": """SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders
GROUP BY 1, 2 ORDER BY 1, 2""",
    "group_by_expression": f"""SELECT CAST({K.REFERENCE_YEAR} - year(o_orderdate) AS BIGINT) AS age, count(*) AS count
FROM orders GROUP BY 1""",
    "category_percent": f"""WITH g AS (SELECT event_type, count(*) AS count FROM ({EVENTS_N}) GROUP BY 1)
SELECT event_type, count, round(CAST(count AS DOUBLE) * 100.0 / (SELECT sum(count) FROM g), 4) AS percent
FROM g WHERE event_type IS NOT NULL""",
    "order_by": "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority, o_orderkey",
    "group_avg": f"""SELECT CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag,
  {exact_mean('l_quantity', 2, 4)} AS avg_quantity, {exact_mean('l_discount', 2, 4)} AS avg_discount
FROM lineitem GROUP BY 1, 2""",
    "window_avg_distinct": """SELECT DISTINCT CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag,
  CAST(round(CAST(avg(CAST(l_quantity AS DECIMAL(30,2))) OVER w AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_quantity,
  CAST(round(CAST(avg(CAST(l_discount AS DECIMAL(30,2))) OVER w AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_discount
FROM lineitem WINDOW w AS (PARTITION BY CAST(l_shipdate AS DATE), l_returnflag)""",
    "duplicate_rows": """WITH l AS (SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  l_shipdate NULLS FIRST) AS rn FROM l) WHERE rn > 1""",
    "check_unique_key": """SELECT row_count, distinct_keys, row_count = distinct_keys AS is_unique FROM
(SELECT count(*) AS row_count,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys FROM lineitem)""",
    "check_age_consistency": f"""SELECT CAST({K.REFERENCE_YEAR} - year(o_orderdate) AS BIGINT) - nullif(o_custkey % 20, 0) AS difference,
  count(*) AS count FROM orders WHERE nullif(o_custkey % 20, 0) IS NOT NULL GROUP BY 1""",
})

ORACLE.update({
    "null_profile": null_profile_sql(EVENTS_N, EVENTS_N_COLS),
    "null_percent": f"""SELECT position, column_name, missing_count,
  round(CAST(missing_count AS DOUBLE) * 100.0 / row_count, 4) AS missing_percent
FROM ({null_profile_sql(EVENTS_N, EVENTS_N_COLS)}) WHERE missing_count > 0""",
    "check_nulls": f"""SELECT 'events' AS table_name, position, column_name, null_count, nan_count,
  {_status('null_count = 0')} AS status FROM ({null_profile_sql(EVENTS_N, EVENTS_N_COLS)})""",
    "check_table_verdict": f"""SELECT 'events' AS table_name, failed_columns, {_status('failed_columns = 0')} AS status
FROM ({failed_columns_sql(EVENTS_N, EVENTS_N_COLS)})
UNION ALL SELECT 'orders', failed_columns, {_status('failed_columns = 0')}
FROM ({failed_columns_sql('SELECT * FROM orders', ORDERS_COLS)})""",
    "check_key_coverage": f"""SELECT dimension, fact_keys, matched_keys, fact_keys - matched_keys AS unmatched_keys FROM (
{_coverage_sql(f"SELECT * FROM ({PAIR_KEYS}) WHERE l_returnflag = 'R'", ['l_partkey', 'l_suppkey'], {
        'other_lines': (f"SELECT * FROM ({PAIR_KEYS}) WHERE l_returnflag <> 'R'", ['l_partkey', 'l_suppkey']),
        'open_lines': (f"SELECT * FROM ({PAIR_KEYS}) WHERE l_linestatus = 'O'", ['l_partkey', 'l_suppkey']),
    })})""",
})

ORACLE.update({
    "build_country_codes": "SELECT c_custkey AS code, c_name AS country_name FROM customer",
    "build_port_codes": PORTS,
    "build_fact": FACT,
    "explore_fact": EXPLORE,
    "build_dim_temperature": dim_temperature(4),
    "build_dim_airports": DIM_AIRPORTS,
    "build_dim_demographics": DIM_DEMOGRAPHICS,
})


def _update_star_sql() -> str:
    """All four tables; of a key that occurs again the first row by the other columns."""
    keys = {"dim_demographics": ["city", "state_code", "race"], "dim_airports": ["ident"], "fact_immigration": ["cicid"]}
    parts = [f"SELECT 'dim_temperature' AS table_name, * FROM ({dim_temperature(4)})"]
    for table, key in keys.items():
        rest = ", ".join(f"{c} ASC NULLS FIRST" for c, _ in STAR_SCHEMAS[table] if c not in key)
        parts.append(f"""SELECT {_q(table)} AS table_name, * FROM {table}
  QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {rest}) = 1""")
    return f"WITH {star_with()} " + " UNION ALL BY NAME ".join(f"SELECT * FROM ({p})" for p in parts)


def _run_etl_sql() -> str:
    rows = []
    for table, cols in STAR_SCHEMAS.items():
        for i, (c, t) in enumerate(cols, start=1):
            rows.append(f"({_q(table)}, {i}, {_q(c)}, {_q(t)})")
    counts = " UNION ALL ".join(f"SELECT {_q(t)} AS table_name, count(*) AS row_count FROM {t}" for t in STAR_SQL)
    return f"""WITH {star_with()},
schema_rows(table_name, position, column_name, data_type) AS (VALUES {', '.join(rows)}),
counts AS ({counts})
SELECT s.table_name, CAST(s.position AS INTEGER) AS position, s.column_name, s.data_type, c.row_count
FROM schema_rows s JOIN counts c ON s.table_name = c.table_name"""


def _check_all_sql() -> str:
    nulls = " UNION ALL ".join(
        f"SELECT 'nulls' AS check_name, {_q(t)} AS subject, failed_columns AS value, "
        f"{_status('failed_columns = 0')} AS status FROM ({failed_columns_sql(f'SELECT * FROM {t}', STAR_SCHEMAS[t])})"
        for t in STAR_SQL)
    counts = " UNION ALL ".join(
        f"SELECT 'row_count', {_q(t)}, count(*), {_status('count(*) >= 1')} FROM {t}" for t in STAR_SQL)
    columns = " UNION ALL ".join(
        f"SELECT 'null_column', {_q(f'{t}.{c}')}, count(*) FILTER (WHERE {t}.{c} IS NULL), "
        f"{_status(f'count(*) FILTER (WHERE {t}.{c} IS NULL) = 0')} FROM {t}" for t in STAR_SQL for c, _ in STAR_SCHEMAS[t])
    coverage = _coverage_sql("SELECT * FROM fact_immigration", ["city", "state"], {
        "dim_airports": ("SELECT * FROM dim_airports", ["municipality", "state"]),
        "dim_demographics": ("SELECT * FROM dim_demographics", ["city", "state_code"]),
    })
    return f"""WITH {star_with()}
{nulls} UNION ALL {columns} UNION ALL {counts} UNION ALL
SELECT 'coverage', dimension, matched_keys, {_status('fact_keys = matched_keys')} FROM ({coverage})"""


ORACLE.update({
    "run_etl": _run_etl_sql(),
    "run_etl_from_files": _run_etl_sql(),
    "update_star": _update_star_sql(),
    "check_all": _check_all_sql(),
    "arrivals_by_month": f"""WITH {star_with()}
SELECT CAST(year(arrival_date) AS INTEGER) AS arrival_year, CAST(month(arrival_date) AS INTEGER) AS arrival_month,
  count(*) AS visitors FROM fact_immigration GROUP BY 1, 2""",
    "arrivals_by_port": f"WITH {star_with()} {visitors('city, state')}",
    "arrivals_by_demographics": f"""WITH {star_with()}, v AS ({visitors('city, state')}),
c AS (SELECT city, state_code, max(total_population) AS total_population,
        max(TRY_CAST(foreign_born AS DOUBLE)) AS foreign_born FROM dim_demographics GROUP BY 1, 2)
SELECT v.city, v.state, v.visitors, c.total_population,
  round(c.foreign_born * 100.0 / nullif(c.total_population, 0), 4) AS foreign_born_percent
FROM v JOIN c ON v.city = c.city AND v.state = c.state_code""",
    "arrivals_by_temperature": f"""WITH {star_with()},
v AS (SELECT city, CAST(month(arrival_date) AS INTEGER) AS month, count(*) AS visitors FROM fact_immigration GROUP BY 1, 2),
t AS (SELECT city, CAST(month(date) AS INTEGER) AS month, round(avg(average_temperature), 4) AS mean_temperature
      FROM dim_temperature GROUP BY 1, 2)
SELECT v.city, v.month, v.visitors, t.mean_temperature FROM v JOIN t ON v.city = t.city AND v.month = t.month""",
    "airports_per_city": f"""WITH {star_with()}, v AS ({visitors('city, state')}),
a AS (SELECT municipality AS city, state, count(*) AS airports FROM dim_airports GROUP BY 1, 2)
SELECT v.city, v.state, v.visitors, coalesce(a.airports, 0) AS airports
FROM v LEFT JOIN a ON v.city = a.city AND v.state = a.state""",
})

# the same results by another way of getting them: from footers, and from statistics kept beside a stored table
ORACLE.update({
    "row_count_from_footers": ORACLE["row_count"],
    "min_max_from_footers": ORACLE["min_max"],
    "stored_profile": ORACLE["null_profile"],
    "stored_unique_key": ORACLE["check_unique_key"],
})
