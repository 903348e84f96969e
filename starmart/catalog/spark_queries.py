"""Registered queries: every operator of the inventory bound to the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. The SQL twin of each is in ``starmart.catalog.oracle``; column names
and types are aligned with it (dates as DATE, counts as BIGINT, means rounded
to 4 digits).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from functools import reduce
from pyspark.sql import functions as F

from starmart.functions import columns as C
from starmart.functions import constants as K
from starmart.operators import aggregates as AG
from starmart.operators import duplicates as DU
from starmart.operators import filters as FI
from starmart.operators import joins as J
from starmart.operators import profile as PR
from starmart.operators import projections as PJ
from starmart.operators import quality as Q
from starmart.operators import windows as W
from starmart.plans import adapters as A
from starmart.plans import codes as CO
from starmart.plans import insights as I
from starmart.plans import star as S
from starmart.session import scratch_path
from starmart.sources import file_stats as FS
from starmart.sources import labels as L
from starmart.sources import readers as R
from starmart.sources import schemas as SC
from starmart.sources import sinks as SK
from starmart.streaming import increments as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return A.table(spark, sf, name)


def orders_d(spark, sf) -> DataFrame:
    """``orders`` with the order date as DATE."""
    return t(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def lineitem_d(spark, sf) -> DataFrame:
    return t(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))


def events_n(spark, sf) -> DataFrame:
    """``events`` with NULLs made: no type for errors, no user for user 3."""
    e = t(spark, sf, "events")
    return e.select("event_id", F.to_date("ts").alias("day"), F.nullif("user_id", F.lit(3)).alias("user_id"),
                    F.nullif("event_type", F.lit("error")).alias("event_type"), "value", "props")


def pair_keys(spark, sf) -> DataFrame:
    """Line keys ``(l_partkey, l_suppkey)`` with supplier 5 made NULL, and the flags."""
    l = t(spark, sf, "lineitem")
    return l.select("l_partkey", F.nullif("l_suppkey", F.lit(5)).alias("l_suppkey"), "l_returnflag", "l_linestatus")


# ---------------------------------------------------------------- sources / sinks

@query("scan_parquet")
def q_scan_parquet(spark, sf):
    df = R.scan_parquet(spark, f"{sf}/orders.parquet",
                        columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    return df.withColumn("o_orderdate", F.to_date("o_orderdate"))


def _awkward(key: str, name: str) -> F.Column:
    """NULL, empty, padded, quoted, broken over lines, with separators, a lone quote, or as it is."""
    k, n = F.col(key) % 8, F.col(name)
    return (F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lit("")).when(k == 2, F.concat(F.lit("  "), n, F.lit(" ")))
            .when(k == 3, F.concat(F.lit('He said "'), n, F.lit('", there'))).when(k == 4, F.concat(n, F.lit("\nnext; line")))
            .when(k == 5, F.concat(F.lit("a,b;"), n)).when(k == 6, F.lit('"')).otherwise(n))


@query("scan_csv")
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "customer-csv")
    SK.write_code_csv(t(spark, sf, "customer").withColumn("c_name", _awkward("c_custkey", "c_name")), path)
    return R.scan_csv(spark, path, SC.CUSTOMER, multi_line=True)


@query("scan_csv_delimited")
def q_scan_csv_delimited(spark, sf):
    path = scratch_path(spark, "supplier-csv")
    SK.write_code_csv(t(spark, sf, "supplier").withColumn("s_name", _awkward("s_suppkey", "s_name")), path, sep=";")
    return R.scan_csv_delimited(spark, path, SC.SUPPLIER, multi_line=True)


@query("typed_frame")
def q_typed_frame(spark, sf):
    path = scratch_path(spark, "customer-text")
    SK.write_code_csv(t(spark, sf, "customer"), path)
    raw = spark.read.option("header", True).csv(path)  # every column is text
    return R.typed_frame(raw, SC.CUSTOMER_RENAMED)


@query("write_code_csv")
def q_write_code_csv(spark, sf):
    path = scratch_path(spark, "customer-codes")
    codes = t(spark, sf, "customer").select(F.col("c_custkey").alias("code"),
                                            _awkward("c_custkey", "c_name").alias("country_name"))
    SK.write_code_csv(codes, path)
    return R.scan_csv(spark, path, SC.COUNTRY_CODES, multi_line=True)


def _orders_for_storage(spark, sf) -> DataFrame:
    return orders_d(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query("write_parquet")
def q_write_parquet(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    SK.write_parquet(_orders_for_storage(spark, sf), path)
    return spark.read.parquet(path)


@query("append_parquet")
def q_append_parquet(spark, sf):
    path = scratch_path(spark, "orders-append")
    orders = _orders_for_storage(spark, sf)
    SK.write_parquet(orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("date")), path)
    # the increment repeats every tenth key with another price, and every key as it is; the lower price comes first
    repeated = orders.filter(F.col("o_orderkey") % 10 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    increment = orders.unionByName(orders).unionByName(repeated)
    SK.append_parquet(spark, increment, path, keys=["o_orderkey"])
    SK.append_parquet(spark, increment, path, keys=["o_orderkey"])  # a replay adds nothing
    return spark.read.parquet(path)


@query("append_increments_stream")
def q_append_increments_stream(spark, sf):
    base = scratch_path(spark, "orders-stream")
    orders = _orders_for_storage(spark, sf)
    # the orders arrive as one increment per year of the data's range; 1997 arrives twice
    for year in range(1995, 2002):
        part = orders.filter(F.year("o_orderdate") == year)
        part.write.mode("append").parquet(f"{base}/incoming")
        if year == 1997:
            part.write.mode("append").parquet(f"{base}/incoming")
    # orders outside that range (or without a date) arrive together as a last increment
    outside = F.coalesce(~F.year("o_orderdate").between(1995, 2001), F.lit(True))
    orders.filter(outside).write.mode("append").parquet(f"{base}/incoming")
    ST.append_increments(spark, f"{base}/incoming", orders.schema, f"{base}/table", keys=["o_orderkey"],
                         checkpoint=f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table")


@query("label_dictionary")
def q_label_dictionary(spark, sf):
    # customers as label files of 500 codes each, read back as whole texts
    c = t(spark, sf, "customer")
    line = F.concat(F.lit("   '"), F.col("c_custkey").cast("string"), F.lit("'\t=\t\""), F.col("c_name"), F.lit("   \""))
    body = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    files = c.groupBy(F.floor(F.col("c_custkey") / 500).alias("file")).agg(F.concat(
        F.lit("/* OTHER */ 1 = 'x' ;\n/* CUSTOMERS - codes */\n  value cust\n"), body,
        F.lit("\n no pair here\n a = b = c\n;\n 9 = 'after the end' ;")).alias("value"))
    path = scratch_path(spark, "labels")
    files.write.partitionBy("file").text(path)  # one text, so one file, for each value
    return L.label_dictionary(L.read_texts(spark, path), "CUSTOMERS").select("code", "value")


@query("parse_pairs")
def q_parse_pairs(spark, sf):
    pages = t(spark, sf, "pages")
    qs = F.when(F.instr("url", "?") > 0, F.substr(F.col("url"), F.instr("url", "?") + 1, F.length("url")))
    items = L.parse_pairs(pages.select("page_id", qs.alias("qs")), "qs", keep=["page_id"], item_sep="&")
    return items.select("page_id", "code", "value")


@query("code_tables")
def q_code_tables(spark, sf):
    path = A.write_label_file(spark, sf, scratch_path(spark, "label-file"))
    out = None
    for name, df in CO.code_tables(L.read_texts(spark, path)).items():
        code, *values = df.columns
        rows = df.select(F.lit(name).alias("table_name"), F.col(code).cast("string").alias("code"),
                         F.col(values[0]).alias("value1"),
                         (F.col(values[1]) if len(values) > 1 else F.lit(None).cast("string")).alias("value2"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("label_dictionary_pair")
def q_label_dictionary_pair(spark, sf):
    c = t(spark, sf, "customer")
    # customers rendered as label sections; building-segment lines lack the comma and are dropped
    sep = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(" ")).otherwise(F.lit(", "))
    text = F.concat(F.lit("/* CUSTOMERS - name and segment */\n  value cust\n   '"),
                    F.col("c_custkey").cast("string"), F.lit("'\t=\t'"), F.col("c_name"), sep,
                    F.col("c_mktsegment"), F.lit("   '\n;\n/* OTHER */ 1 = 'x, y' ;"))
    texts = c.select(F.col("c_custkey").alias("row_id"), text.alias("text"))
    return L.label_dictionary_pair(texts, "CUSTOMERS", keep=["row_id"]).select("code", "value1", "value2")


@query("register_view")
def q_register_view(spark, sf):
    SK.register_view(orders_d(spark, sf), "orders_view")
    return spark.sql("SELECT o_orderpriority, COUNT(*) AS order_count FROM orders_view GROUP BY o_orderpriority")


@query("table_stats")
def q_table_stats(spark, sf):
    return PR.table_stats(spark, {"orders": t(spark, sf, "orders"), "lineitem": t(spark, sf, "lineitem")}, sample=True)


@query("preview")
def q_preview(spark, sf):
    return PJ.preview(orders_d(spark, sf).select("o_orderkey", "o_orderstatus", "o_orderdate"), 10,
                      order=["o_orderkey"])


@query("limit_rows")
def q_limit_rows(spark, sf):
    return PJ.limit_rows(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), 20,
                         order=["l_orderkey", "l_linenumber", "l_quantity"])


# ---------------------------------------------------------------- projections / scalar

@query("project_rename")
def q_project_rename(spark, sf):
    return PJ.project_rename(orders_d(spark, sf), {
        "order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus",
        "order_date": "o_orderdate", "priority": "o_orderpriority"})


@query("add_column")
def q_add_column(spark, sf):
    o = orders_d(spark, sf).select("o_orderkey", "o_orderdate")
    return PJ.add_column(o, "order_year", F.year("o_orderdate").cast("bigint"))


@query("qualified_star")
def q_qualified_star(spark, sf):
    o = orders_d(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = t(spark, sf, "customer")
    return PJ.qualified_star(o, c, F.col("l.o_custkey") == F.col("r.c_custkey"),
                             {"c_name": "customer_name", "c_mktsegment": "segment"})


@query("cast_int")
def q_cast_int(spark, sf):
    price = F.when(F.col("o_orderkey") % 10 == 3, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return t(spark, sf, "orders").select("o_orderkey", C.cast_int(price).alias("total_int"))


@query("age_at_year")
def q_age_at_year(spark, sf):
    o = orders_d(spark, sf)
    return o.select("o_orderkey", C.age_at_year(F.year("o_orderdate"), K.REFERENCE_YEAR).cast("bigint").alias("age"))


@query("difference")
def q_difference(spark, sf):
    o = orders_d(spark, sf)
    age = C.age_at_year(F.year("o_orderdate"), K.REFERENCE_YEAR)
    return o.select("o_orderkey", (age - F.col("o_custkey") % 10).cast("bigint").alias("difference"))


def _marker_days(spark, sf) -> DataFrame:
    l = t(spark, sf, "lineitem")
    days = (F.when(F.col("l_linenumber") == 2, F.lit(None).cast("double"))
            .when(F.col("l_linenumber") == 3, F.lit(0.0)).when(F.col("l_linenumber") == 4, F.lit(float("nan")))
            .otherwise(F.col("l_partkey").cast("double")))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days"))


@query("epoch_day_to_date")
def q_epoch_day_to_date(spark, sf):
    l = t(spark, sf, "lineitem")
    days = F.when(F.col("l_linenumber") == 4, F.lit(float("nan"))).otherwise(F.col("l_partkey") + 0.75)
    return l.select("l_orderkey", "l_linenumber", "l_partkey", C.epoch_day_to_date(days).alias("day"))


@query("epoch_day_to_date_or_marker")
def q_epoch_day_to_date_or_marker(spark, sf):
    d = _marker_days(spark, sf)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", C.epoch_day_to_date_or_marker("days").alias("day"))


@query("count_marker")
def q_count_marker(spark, sf):
    d = _marker_days(spark, sf).select(C.epoch_day_to_date_or_marker("days").alias("day"))
    return FI.count_marker(d, "day", K.UNKNOWN_LABEL)


@query("decode_mode")
def q_decode_mode(spark, sf):
    l = t(spark, sf, "lineitem")
    return l.select("l_orderkey", "l_linenumber", C.decode("l_linenumber", K.MODE_LABELS).alias("arrival_mode"))


@query("decode_visa")
def q_decode_visa(spark, sf):
    l = t(spark, sf, "lineitem")
    return l.select("l_orderkey", "l_linenumber", C.decode("l_linenumber", K.VISA_LABELS).alias("visa_type"))


def _padded_names(spark, sf) -> DataFrame:
    p = t(spark, sf, "part")
    return p.select("p_partkey", F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("name"))


@query("upper_trim")
def q_upper_trim(spark, sf):
    return _padded_names(spark, sf).select("p_partkey", C.upper_trim("name").alias("name"))


@query("upper")
def q_upper(spark, sf):
    return t(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("name"))


@query("text_length")
def q_text_length(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", C.text_length("o_orderpriority").cast("bigint").alias("len"))


@query("filter_length_eq")
def q_filter_length_eq(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FI.filter_length_eq(o, "o_orderpriority", 5)


@query("distinct_expression")
def q_distinct_expression(spark, sf):
    return AG.distinct_expression(t(spark, sf, "orders"), C.text_length("o_orderpriority").cast("bigint"), "len")


@query("split_after_first")
def q_split_after_first(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", C.split_after_first("o_orderpriority", "-").alias("priority_name"))


@query("split_coordinates")
def q_split_coordinates(spark, sf):
    p = t(spark, sf, "part")
    text = F.when(F.col("p_size") > 45, F.lit("bad")).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(", "), F.col("p_partkey").cast("string")))
    lon, lat = C.split_coordinates(text)
    return p.select("p_partkey", lon.alias("lon"), lat.alias("lat"))


@query("parse_date")
def q_parse_date(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"))
    return o.select("o_orderkey", C.parse_date("dt").alias("order_day"))


@query("filter_date_after")
def q_filter_date_after(spark, sf):
    return FI.filter_date_after(orders_d(spark, sf).select("o_orderkey", "o_orderdate"), "o_orderdate", "1998-01-01")


@query("filter_range_ge")
def q_filter_range_ge(spark, sf):
    l = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return FI.filter_range_ge(l, "l_discount", 0.05)


@query("fill_missing")
def q_fill_missing(spark, sf):
    e = events_n(spark, sf)
    return AG.group_count(e.select(C.fill_missing("event_type", "").alias("event_type")), "event_type")


# ---------------------------------------------------------------- filters

@query("filter_is_null")
def q_filter_is_null(spark, sf):
    return FI.filter_is_null(events_n(spark, sf).select("event_id", "user_id", "event_type"), "event_type")


@query("filter_not_null")
def q_filter_not_null(spark, sf):
    return FI.filter_not_null(events_n(spark, sf).select("event_id", "user_id"), "user_id")


@query("filter_not_in_keep_null")
def q_filter_not_in_keep_null(spark, sf):
    e = FI.filter_not_in_keep_null(events_n(spark, sf), "event_type", ["click", "view"])
    return AG.group_count(e, "event_type")


@query("count_where")
def q_count_where(spark, sf):
    return AG.count_where(events_n(spark, sf), F.col("user_id").isNull())


@query("filter_number_eq")
def q_filter_number_eq(spark, sf):
    l = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return FI.filter_number_eq(l, "l_linenumber", 1)


@query("filter_text_eq")
def q_filter_text_eq(spark, sf):
    return FI.filter_text_eq(t(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "BUILDING")


@query("filter_in")
def q_filter_in(spark, sf):
    l = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return FI.filter_in(l, "l_returnflag", ["R", "A"])


@query("filter_not_in")
def q_filter_not_in(spark, sf):
    return FI.filter_not_in(t(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", ["Brand#1", "Brand#2"])


@query("filter_contains")
def q_filter_contains(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return FI.filter_contains(p, "p_type", "AR")


@query("filter_and")
def q_filter_and(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return FI.filter_and(c, F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") == 3)


def _ship_vs_order(spark, sf) -> DataFrame:
    l = lineitem_d(spark, sf).select("l_orderkey", "l_linenumber", "l_shipdate")
    o = orders_d(spark, sf).select("o_orderkey", "o_orderdate")
    return l.join(o, l.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


@query("filter_column_compare")
def q_filter_column_compare(spark, sf):
    return FI.filter_column_compare(_ship_vs_order(spark, sf), "l_shipdate", "<=", "o_orderdate")


@query("check_date_order")
def q_check_date_order(spark, sf):
    return Q.check_date_order(_ship_vs_order(spark, sf), "l_shipdate", "o_orderdate")


# ---------------------------------------------------------------- joins

@query("lookup_join")
def q_lookup_join(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return J.lookup_join(c, A.country_codes(spark, sf), "c_nationkey", {"country_name": "nation_name"})


@query("lookup_join_second_role")
def q_lookup_join_second_role(spark, sf):
    im = A.immigration(spark, sf).select("cicid", "i94mode", "i94cit", "i94res")
    codes = A.country_codes(spark, sf)
    small = J.fits_broadcast(codes)  # one size check for both roles
    im = J.lookup_join(im, codes, "i94cit", {"country_name": "citizenship_country"}, broadcast=small)
    im = J.lookup_join(im, codes, "i94res", {"country_name": "residence_country"}, broadcast=small)
    return im.select("cicid", "i94mode", "citizenship_country", "residence_country")


@query("distinct_pair_join")
def q_distinct_pair_join(spark, sf):
    k = pair_keys(spark, sf)
    returned = k.filter(F.col("l_returnflag") == "R")
    other = k.filter(F.col("l_returnflag") != "R")
    return J.distinct_pair_join(returned, ["l_partkey", "l_suppkey"], other, ["l_partkey", "l_suppkey"])


@query("in_subquery")
def q_in_subquery(spark, sf):
    ship = lineitem_d(spark, sf).select("l_shipdate").distinct()
    common = J.in_subquery(ship, "l_shipdate", orders_d(spark, sf), "o_orderdate")
    return AG.row_count(common, "common_dates")


# ---------------------------------------------------------------- aggregates

@query("row_count")
def q_row_count(spark, sf):
    return AG.row_count(t(spark, sf, "lineitem"))


@query("check_row_count")
def q_check_row_count(spark, sf):
    return Q.check_row_count(t(spark, sf, "orders"), "orders").unionByName(
        Q.check_row_count(t(spark, sf, "lineitem"), "lineitem", min_rows=1))


@query("row_count_from_footers")
def q_row_count_from_footers(spark, sf):
    return AG.row_count(R.scan_parquet_footers(spark, f"{sf}/lineitem.parquet"))


@query("min_max_from_footers")
def q_min_max_from_footers(spark, sf):
    return AG.min_max(R.scan_parquet_footers(spark, f"{sf}/orders.parquet"), "o_totalprice")


@query("count_distinct")
def q_count_distinct(spark, sf):
    return AG.count_distinct(t(spark, sf, "orders"), "o_custkey")


@query("count_distinct_pair")
def q_count_distinct_pair(spark, sf):
    return AG.count_distinct_pair(pair_keys(spark, sf), "l_partkey", "l_suppkey")


@query("distinct_rows_count")
def q_distinct_rows_count(spark, sf):
    return AG.distinct_rows_count(pair_keys(spark, sf), ["l_partkey", "l_suppkey"])


@query("min_max")
def q_min_max(spark, sf):
    return AG.min_max(t(spark, sf, "orders"), "o_totalprice")


@query("select_distinct")
def q_select_distinct(spark, sf):
    return AG.select_distinct(t(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("group_count")
def q_group_count(spark, sf):
    return AG.group_count(t(spark, sf, "orders"), "o_orderstatus")


@query("group_count_drop_null")
def q_group_count_drop_null(spark, sf):
    return AG.group_count_drop_null(events_n(spark, sf), "event_type")


@query("group_count_where")
def q_group_count_where(spark, sf):
    return AG.group_count_where(t(spark, sf, "orders"), F.col("o_totalprice") > 200000, "o_orderpriority")


@query("group_count_ordered")
def q_group_count_ordered(spark, sf):
    return AG.group_count_ordered(t(spark, sf, "part"), "p_size")


@query("group_count_multi")
def q_group_count_multi(spark, sf):
    return AG.group_count_multi(t(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("group_by_expression")
def q_group_by_expression(spark, sf):
    age = C.age_at_year(F.year(F.to_date("o_orderdate")), K.REFERENCE_YEAR).cast("bigint")
    return AG.group_by_expression(t(spark, sf, "orders"), age, "age")


@query("category_percent")
def q_category_percent(spark, sf):
    out = AG.category_percent(events_n(spark, sf), "event_type")
    return out.withColumn("percent", F.round("percent", 4))


@query("order_by")
def q_order_by(spark, sf):
    return PJ.order_by(t(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey")


@query("group_avg")
def q_group_avg(spark, sf):
    return AG.group_avg(lineitem_d(spark, sf), ["l_shipdate", "l_returnflag"],
                        {"avg_quantity": "l_quantity", "avg_discount": "l_discount"}, digits=4, decimals=2)


@query("window_avg_distinct")
def q_window_avg_distinct(spark, sf):
    return W.window_avg_distinct(lineitem_d(spark, sf), ["l_shipdate", "l_returnflag"],
                                 {"avg_quantity": "l_quantity", "avg_discount": "l_discount"}, digits=4, decimals=2)


@query("duplicate_rows")
def q_duplicate_rows(spark, sf):
    return DU.duplicate_rows(lineitem_d(spark, sf), ["l_orderkey", "l_linenumber"], order=["l_partkey", "l_suppkey"])


@query("check_unique_key")
def q_check_unique_key(spark, sf):
    return Q.check_unique_key(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_age_consistency")
def q_check_age_consistency(spark, sf):
    o = orders_d(spark, sf)
    computed = C.age_at_year(F.year("o_orderdate"), K.REFERENCE_YEAR).cast("bigint")
    given = F.nullif(F.col("o_custkey") % 20, F.lit(0))
    return Q.check_age_consistency(o, computed, given)


# ---------------------------------------------------------------- profile / quality

@query("null_profile")
def q_null_profile(spark, sf):
    return PR.null_profile(events_n(spark, sf))


@query("null_percent")
def q_null_percent(spark, sf):
    return PR.null_percent(events_n(spark, sf)).withColumn("missing_percent", F.round("missing_percent", 4))


@query("check_nulls")
def q_check_nulls(spark, sf):
    return Q.check_nulls(events_n(spark, sf), "events")


def _third(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.filter(F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(3)) == n)


@query("stored_profile")
def q_stored_profile(spark, sf):
    # three increments, a check after each; the last one adds up the profiles of all files
    path, events = scratch_path(spark, "events-profile"), events_n(spark, sf)
    for n in range(3):
        SK.write_parquet(_third(events, "event_id", n), path, mode="append")
        profile = FS.stored_profile(spark, path)
    return profile


@query("stored_unique_key")
def q_stored_unique_key(spark, sf):
    path = scratch_path(spark, "lines-unique")
    lines = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    for n in range(3):
        SK.write_parquet(_third(lines, "l_linenumber", n), path, mode="append", sort_by=["l_orderkey", "l_linenumber"])
        report = FS.stored_unique_key(spark, path, ["l_orderkey", "l_linenumber"])
    return report


@query("check_table_verdict")
def q_check_table_verdict(spark, sf):
    report = Q.check_nulls(events_n(spark, sf), "events").unionByName(Q.check_nulls(t(spark, sf, "orders"), "orders"))
    return Q.check_table_verdict(report)


@query("check_key_coverage")
def q_check_key_coverage(spark, sf):
    k = pair_keys(spark, sf)
    keys = ["l_partkey", "l_suppkey"]
    return Q.check_key_coverage(k.filter(F.col("l_returnflag") == "R"), keys, {
        "other_lines": (k.filter(F.col("l_returnflag") != "R"), keys),
        "open_lines": (k.filter(F.col("l_linestatus") == "O"), keys),
    })


# ---------------------------------------------------------------- star

@query("build_country_codes")
def q_build_country_codes(spark, sf):
    # a code table that grows with the data: customers as codes, their names as labels
    codes = t(spark, sf, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("country_name"))
    return S.build_country_codes(codes)


@query("build_port_codes")
def q_build_port_codes(spark, sf):
    return S.build_port_codes(A.port_codes(spark, sf))


@query("build_fact")
def q_build_fact(spark, sf):
    return _fact(spark, sf)


@query("explore_fact")
def q_explore_fact(spark, sf):
    return S.explore_fact(A.immigration(spark, sf)).select(
        "cicid", "arrival_date", "departure_date", "visa_type", "arrival_modes")


@query("build_dim_temperature")
def q_build_dim_temperature(spark, sf):
    return S.build_dim_temperature(A.temperature(spark, sf), digits=4, decimals=3)


@query("build_dim_airports")
def q_build_dim_airports(spark, sf):
    return S.build_dim_airports(A.airports(spark, sf))


@query("build_dim_demographics")
def q_build_dim_demographics(spark, sf):
    return S.build_dim_demographics(A.demographics(spark, sf))


def _written_star(spark, sf) -> dict[str, DataFrame]:
    out = scratch_path(spark, "star")
    S.run_etl(spark, A.sources(spark, sf), out)
    return S.read_star(spark, out)


@query("run_etl")
def q_run_etl(spark, sf):
    out = scratch_path(spark, "star")
    return S.run_etl(spark, A.sources(spark, sf), out).select(
        "table_name", "position", "column_name", "data_type", "row_count")


@query("run_etl_from_files")
def q_run_etl_from_files(spark, sf):
    base = scratch_path(spark, "raw")
    paths = {name: f"{base}/{name}" for name in ("labels", "immigration", "temperature", "airports", "demographics")}
    A.write_label_file(spark, sf, paths["labels"])
    A.immigration(spark, sf).write.parquet(paths["immigration"])
    SK.write_code_csv(A.temperature(spark, sf), paths["temperature"])
    SK.write_code_csv(A.airports(spark, sf), paths["airports"])
    SK.write_code_csv(A.demographics(spark, sf), paths["demographics"], sep=";")
    return S.run_etl_from_files(spark, paths, f"{base}/star").select(
        "table_name", "position", "column_name", "data_type", "row_count")


@query("update_star")
def q_update_star(spark, sf):
    out, whole = scratch_path(spark, "star"), A.sources(spark, sf)
    first = {**whole, "immigration": whole["immigration"].filter(F.col("cicid") % 2 == 0),
             "temperature": whole["temperature"].filter(F.length("City") % 2 == 0),  # dates and cities overlap
             "airports": whole["airports"].filter(F.col("ident").cast("long") % 2 == 0)}
    options = {"digits": 4, "decimals": 3}
    S.update_star(spark, first, out, temperature_options=options)
    S.update_star(spark, whole, out, temperature_options=options)  # the second month, delivered with the first again
    S.update_star(spark, whole, out, temperature_options=options)  # a replay
    star = S.read_star(spark, out)
    rows = [star[name].select(F.lit(name).alias("table_name"), "*") for name in S.STAR_TABLES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


@query("check_all")
def q_check_all(spark, sf):
    tables = _written_star(spark, sf)
    res = Q.check_all(tables, "fact_immigration", S.FACT_KEYS, S.DIMENSION_KEYS)
    verdicts = res["verdicts"].select(F.lit("nulls").alias("check_name"), F.col("table_name").alias("subject"),
                                      F.col("failed_columns").alias("value"), "status")
    counts = res["row_counts"].select(F.lit("row_count").alias("check_name"), F.col("table_name").alias("subject"),
                                      F.col("row_count").alias("value"), "status")
    coverage = res["coverage"].select(F.lit("coverage").alias("check_name"), F.col("dimension").alias("subject"),
                                      F.col("matched_keys").alias("value"),
                                      F.when(F.col("unmatched_keys") == 0, "passed").otherwise("failed").alias("status"))
    columns = res["nulls"].select(F.lit("null_column").alias("check_name"),
                                  F.concat_ws(".", "table_name", "column_name").alias("subject"),
                                  F.col("null_count").alias("value"), "status")
    return verdicts.unionByName(columns).unionByName(counts).unionByName(coverage)


def _fact(spark, sf) -> DataFrame:
    return S.build_fact(A.immigration(spark, sf), S.build_country_codes(A.country_codes(spark, sf)),
                        S.build_port_codes(A.port_codes(spark, sf)))


@query("arrivals_by_month")
def q_arrivals_by_month(spark, sf):
    return I.arrivals_by_month(_fact(spark, sf))


@query("arrivals_by_port")
def q_arrivals_by_port(spark, sf):
    return I.arrivals_by_port(_fact(spark, sf))


@query("arrivals_by_demographics")
def q_arrivals_by_demographics(spark, sf):
    return I.arrivals_by_demographics(_fact(spark, sf), S.build_dim_demographics(A.demographics(spark, sf)))


@query("arrivals_by_temperature")
def q_arrivals_by_temperature(spark, sf):
    return I.arrivals_by_temperature(_fact(spark, sf), S.build_dim_temperature(A.temperature(spark, sf)))


@query("airports_per_city")
def q_airports_per_city(spark, sf):
    return I.airports_per_city(_fact(spark, sf), S.build_dim_airports(A.airports(spark, sf)))
