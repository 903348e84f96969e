"""Counts, frequency tables, distincts and averages.

All of them are hash aggregations that Spark runs in two phases (partial
aggregate in every map task, final aggregate after the shuffle), so a key
holding a large share of the rows costs one row per map task in the shuffle.
Results are DataFrames; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import ColumnLike, col_of

COUNT = "count"


def _n() -> Column:
    return F.count(F.lit(1))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """``SELECT COUNT(*)`` as a one-row DataFrame."""
    return df.agg(_n().alias(name))


def count_where(df: DataFrame, predicate: Column, name: str = "row_count") -> DataFrame:
    """``COUNT(*)`` of the rows where ``predicate`` is true (NULL counts as false)."""
    return df.agg(F.count_if(F.coalesce(predicate, F.lit(False))).alias(name))


def count_distinct(df: DataFrame, c: ColumnLike, name: str = "distinct_count") -> DataFrame:
    """Distinct non-NULL values."""
    return df.agg(F.count_distinct(col_of(c)).alias(name))


def count_distinct_pair(df: DataFrame, a: ColumnLike, b: ColumnLike, name: str = "distinct_pairs") -> DataFrame:
    """``COUNT(DISTINCT a, b)``: pairs with any NULL are not counted."""
    return df.agg(F.count_distinct(col_of(a), col_of(b)).alias(name))


def select_distinct(df: DataFrame, *cols: ColumnLike) -> DataFrame:
    return (df.select(*[col_of(c) for c in cols]) if cols else df).distinct()


def distinct_rows_count(df: DataFrame, cols: Sequence[ColumnLike], name: str = "distinct_rows") -> DataFrame:
    """Distinct rows of a column set where NULLs are equal (``drop_duplicates``)."""
    return select_distinct(df, *cols).agg(_n().alias(name))


def group_count(df: DataFrame, *keys: ColumnLike, name: str = COUNT) -> DataFrame:
    """Frequency table; NULL is a group of its own."""
    return df.groupBy(*[col_of(k) for k in keys]).agg(_n().alias(name))


def group_count_drop_null(df: DataFrame, key: str, name: str = COUNT) -> DataFrame:
    """pandas ``groupby(key)[key].count()``: NULL keys dropped, ordered by key."""
    return group_count(df.filter(F.col(key).isNotNull()), key, name=name).orderBy(key)


def group_count_where(df: DataFrame, predicate: Column, *keys: ColumnLike, name: str = COUNT) -> DataFrame:
    return group_count(df.filter(predicate), *keys, name=name)


def group_count_ordered(df: DataFrame, key: str, name: str = COUNT) -> DataFrame:
    """Frequency per key ordered by the key, NULL keys dropped."""
    return group_count(df.filter(F.col(key).isNotNull()), key, name=name).orderBy(F.col(key).asc())


def group_count_multi(df: DataFrame, keys: Sequence[str], name: str = COUNT) -> DataFrame:
    """Frequency over several keys, ordered by all of them."""
    return group_count(df, *keys, name=name).orderBy(*keys)


def group_by_expression(df: DataFrame, expr: Column, alias: str, name: str = COUNT) -> DataFrame:
    """``SELECT expr AS alias, COUNT(*) ... GROUP BY alias``."""
    return df.groupBy(expr.alias(alias)).agg(_n().alias(name))


def distinct_expression(df: DataFrame, expr: Column, alias: str) -> DataFrame:
    """Distinct values of an expression (``GROUP BY`` without aggregate)."""
    return df.select(expr.alias(alias)).distinct()


def min_max(df: DataFrame, c: ColumnLike, prefix: str | None = None) -> DataFrame:
    name = prefix or (c if isinstance(c, str) else "value")
    c = col_of(c)
    return df.agg(F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"))


def group_avg(df: DataFrame, keys: Sequence[ColumnLike], measures: dict[str, ColumnLike],
              digits: int | None = None, decimals: int | None = None) -> DataFrame:
    """Mean of each measure per key (NULL readings are ignored).

    ``measures`` maps output names to columns. ``digits`` rounds the means.
    ``decimals`` declares how many decimals the measures carry: they are then
    summed as DECIMAL, so the mean is exact and the same for any partitioning
    or summation order (a double sum is not), and returned as DOUBLE. A NaN
    reading counts as missing there (a value too large for DECIMAL(30, n)
    still fails loudly).
    """
    aggs = []
    for out, m in measures.items():
        m = col_of(m)
        if decimals is not None:
            m = F.when(F.isnan(m), F.lit(None)).otherwise(m).cast(f"decimal(30,{decimals})")
        a = F.avg(m)
        a = F.round(a, digits) if digits is not None else a
        aggs.append((a.cast("double") if decimals is not None else a).alias(out))
    return df.groupBy(*[col_of(k) for k in keys]).agg(*aggs)


def category_percent(df: DataFrame, key: str, name: str = COUNT, percent: str = "percent") -> DataFrame:
    """Share of each non-NULL category in % of all rows (NULL rows included in the total).

    The total is a scalar subquery (``COUNT(*)``, which reads no column), so
    there is no window over the whole table and no cross join.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    return (group_count(df.filter(F.col(key).isNotNull()), key, name=name)
            .withColumn(percent, F.col(name) * F.lit(100.0) / total))
