"""Predicates with a stated NULL behaviour.

SQL drops a row whose predicate is NULL; pandas masks treat a missing value as
``False`` for ``isin`` but keep it under ``~isin``. Each function says which it is.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.functions.columns import ColumnLike, col_of, strip_whitespace


def is_in(c: ColumnLike, values: Iterable[object]) -> Column:
    """``c IN (...)``; NULL is dropped."""
    return col_of(c).isin(list(values))


def not_in(c: ColumnLike, values: Iterable[object]) -> Column:
    """``c NOT IN (...)``; NULL is dropped (SQL semantics)."""
    return ~col_of(c).isin(list(values))


def not_in_keep_null(c: ColumnLike, values: Iterable[object], strip: bool = True) -> Column:
    """Not one of ``values`` (white space at the edges ignored); a missing value stays."""
    c = strip_whitespace(c) if strip else col_of(c)
    return ~F.coalesce(c.isin(list(values)), F.lit(False))


def contains_upper(c: ColumnLike, text: str) -> Column:
    """The upper-cased value holds ``text``; a missing value does not."""
    return F.upper(F.coalesce(col_of(c), F.lit(""))).contains(text)


def length_eq(c: ColumnLike, n: int) -> Column:
    return F.length(col_of(c)) == n


def date_after(c: ColumnLike, day: str) -> Column:
    """Strictly after ``day``; the day itself is dropped."""
    return col_of(c) > F.lit(day).cast("date")


def is_missing(c: ColumnLike, numeric_nan: bool = False) -> Column:
    """NULL, and NaN too when the column is floating point."""
    c = col_of(c)
    return (c.isNull() | F.isnan(c)) if numeric_nan else c.isNull()
