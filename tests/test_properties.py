"""Properties: filters partition the rows, lookups never multiply
rows when codes are unique, profiles agree with a direct count."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.operators import aggregates as AG
from starmart.operators import filters as FI
from starmart.operators import joins as J
from starmart.operators import profile as PR
from starmart.operators import quality as Q

CODES = st.one_of(st.none(), st.integers(0, 6))
SETTINGS = settings(max_examples=8, deadline=None)


@SETTINGS
@given(st.lists(CODES, max_size=30), st.sets(st.integers(0, 6), max_size=4))
def test_in_not_in_and_null_partition_the_rows(spark, values, chosen):
    df = spark.createDataFrame([(v,) for v in values], "c int")
    chosen = sorted(chosen) or [99]
    n_in = FI.filter_in(df, "c", chosen).count()
    n_out = FI.filter_not_in(df, "c", chosen).count()
    n_null = FI.filter_is_null(df, "c").count()
    assert n_in + n_out + n_null == len(values)
    assert FI.filter_not_in_keep_null(df, "c", chosen, strip=False).count() == n_out + n_null


@SETTINGS
@given(st.lists(CODES, max_size=30), st.sets(st.integers(0, 6), max_size=7), st.booleans())
def test_lookup_never_multiplies_rows(spark, values, known, broadcast):
    fact = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_id int, c int")
    codes = spark.createDataFrame([(k, f"L{k}") for k in sorted(known)], "code int, label string")
    inner = J.lookup_join(fact, codes, "c", {"label": "label"}, broadcast=broadcast)
    left = J.lookup_join(fact, codes, "c", {"label": "label"}, how="left", broadcast=broadcast)
    assert inner.count() == sum(v in known for v in values)
    assert left.count() == len(values)
    assert all(r.label == f"L{r.c}" for r in inner.collect())


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", " c"])),
                          st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32))),
                max_size=25))
def test_null_profile_matches_a_direct_count(spark, rows):
    df = spark.createDataFrame(rows, "s string, x double")
    prof = {r.column_name: r for r in PR.null_profile(df).collect()}
    assert prof["s"].null_count == sum(s is None for s, _ in rows)
    assert prof["x"].null_count == sum(x is None for _, x in rows)
    assert prof["x"].nan_count == sum(x is not None and math.isnan(x) for _, x in rows)
    assert all(p.row_count == len(rows) for p in prof.values())


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 2)), max_size=25))
def test_unique_key_agrees_with_pandas(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    r = Q.check_unique_key(df, ["a", "b"]).collect()[0]
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    assert r.row_count == len(rows)
    assert r.distinct_keys == len(pdf.drop_duplicates())
    assert r.is_unique == (not pdf.duplicated().any())


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["x", "y", "z"])), min_size=1, max_size=30))
def test_category_shares_add_up(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    total = sum(r.percent for r in AG.category_percent(df, "t").collect())
    assert abs(total - 100.0 * sum(v is not None for v in values) / len(values)) < 1e-9
