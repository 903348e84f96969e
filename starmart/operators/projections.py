"""Projections, renames, previews and ordering (``DataFrame → DataFrame``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import ColumnLike, col_of
from starmart.operators.profile import sql_ident


def add_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``SELECT *, expr AS name``."""
    return df.withColumn(name, expr)


def add_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Several computed columns in one projection."""
    return df.withColumns(dict(exprs))


def insert_columns(df: DataFrame, position: int, exprs: Mapping[str, Column]) -> DataFrame:
    """All columns with ``exprs`` inserted at a 0-based ``position`` (pandas ``insert``),
    e.g. longitude and latitude split from the coordinates at positions 12 and 13."""
    cols = [F.col(sql_ident(c)) for c in df.columns]
    new = [e.alias(n) for n, e in exprs.items()]
    return df.select(*cols[:position], *new, *cols[position:])


def project_rename(df: DataFrame, columns: Mapping[str, ColumnLike] | Sequence[tuple[str, ColumnLike]]) -> DataFrame:
    """Column subset with new names in a fixed order: ``{new_name: source}``.

    Sources may be names with blanks (``"Median Age"``): they are looked up as
    columns, never spliced into SQL text.
    """
    pairs = columns.items() if isinstance(columns, Mapping) else columns
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in pairs])


def qualified_star(left: DataFrame, right: DataFrame, on: Column, take: Mapping[str, str],
                   how: str = "inner") -> DataFrame:
    """All columns of ``left`` plus ``take`` (``{right_col: new_name}``) of ``right``."""
    l, r = left.alias("l"), right.alias("r")
    return l.join(r, on(l, r) if callable(on) else on, how).select(
        "l.*", *[F.col(f"r.{sql_ident(src)}").alias(dst) for src, dst in take.items()])


def order_by(df: DataFrame, *keys: ColumnLike, spread_ties: bool = True) -> DataFrame:
    """Ascending order on one or more keys (range-partitioned global sort).

    A range partitioner cannot split rows with equal sort keys, so one value
    holding a third of the table would be sorted by one task. ``spread_ties``
    adds a hash of the whole row as the last sort key: the requested order is
    unchanged, ties get a deterministic order and are spread over ranges
    (identical copies of a row still share one).
    """
    order = [col_of(k).asc() for k in keys]
    if spread_ties:
        order.append(F.xxhash64(*[F.col(sql_ident(c)) for c in df.columns]).asc())
    return df.orderBy(*order)


def limit_rows(df: DataFrame, n: int, order: Sequence[ColumnLike] | None = None) -> DataFrame:
    """First ``n`` rows; give ``order`` for a repeatable result (top-n by order)."""
    return (df.orderBy(*[col_of(k) for k in order]) if order else df).limit(n)


preview = limit_rows
