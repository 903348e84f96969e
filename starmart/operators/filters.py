"""Row filters with the NULL behaviour of the original step each one replaces.

Each is one ``filter`` on a built-in predicate, so Catalyst can push it into
the parquet scan (``PushedFilters``) when it refers to a source column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import predicates as P
from starmart.functions.columns import ColumnLike, col_of


def filter_number_eq(df: DataFrame, c: ColumnLike, value: float) -> DataFrame:
    return df.filter(col_of(c) == F.lit(value))


def filter_text_eq(df: DataFrame, c: ColumnLike, value: str) -> DataFrame:
    return df.filter(col_of(c) == F.lit(value))


def filter_in(df: DataFrame, c: ColumnLike, values: Iterable[object]) -> DataFrame:
    """``c IN (...)``; rows with a NULL ``c`` are dropped."""
    return df.filter(P.is_in(c, values))


def filter_not_in(df: DataFrame, c: ColumnLike, values: Iterable[object]) -> DataFrame:
    """``c NOT IN (...)``; rows with a NULL ``c`` are dropped."""
    return df.filter(P.not_in(c, values))


def filter_not_in_keep_null(df: DataFrame, c: ColumnLike, values: Iterable[object],
                            strip: bool = True) -> DataFrame:
    """Not in the list after stripping; a missing value stays (pandas ``~isin``)."""
    return df.filter(P.not_in_keep_null(c, values, strip=strip))


def filter_not_null(df: DataFrame, c: ColumnLike) -> DataFrame:
    return df.filter(col_of(c).isNotNull())


def filter_is_null(df: DataFrame, c: ColumnLike, numeric_nan: bool = False) -> DataFrame:
    return df.filter(P.is_missing(c, numeric_nan))


def filter_date_after(df: DataFrame, c: ColumnLike, day: str) -> DataFrame:
    """Strictly after ``day``."""
    return df.filter(P.date_after(c, day))


def filter_range_ge(df: DataFrame, c: ColumnLike, bound: float) -> DataFrame:
    return df.filter(col_of(c) >= F.lit(bound))


def filter_column_compare(df: DataFrame, left: ColumnLike, op: str, right: ColumnLike) -> DataFrame:
    """``left op right`` for ``op`` in ``< <= = >= > !=``; NULL on either side drops the row."""
    a, b = col_of(left), col_of(right)
    ops = {"<": a < b, "<=": a <= b, "=": a == b, "==": a == b, ">=": a >= b, ">": a > b, "!=": a != b}
    return df.filter(ops[op])


def filter_contains(df: DataFrame, c: ColumnLike, text: str) -> DataFrame:
    """Upper-cased text contains ``text``; a missing value is no match."""
    return df.filter(P.contains_upper(c, text))


def filter_length_eq(df: DataFrame, c: ColumnLike, n: int) -> DataFrame:
    return df.filter(P.length_eq(c, n))


def filter_and(df: DataFrame, *conditions) -> DataFrame:
    cond = conditions[0]
    for other in conditions[1:]:
        cond = cond & other
    return df.filter(cond)


def count_marker(df: DataFrame, c: ColumnLike, marker: str = "N/A") -> DataFrame:
    """Rows whose text form equals the marker, as a one-row count."""
    return df.agg(F.count_if(col_of(c).cast("string") == F.lit(marker)).alias("marker_count"))
