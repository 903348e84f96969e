"""Duplicate keys, without putting a hot key's rows into one task.

``duplicate_rows`` returns every row of a key set except the first by a given
order (pandas ``df[df[keys].duplicated()]``). One window per key would hold a
key's rows in one task, and one key may hold a third of the table. So the
first row is found in two levels:

* rows are numbered per key, input partition and a salt from their values. All
  but the first of such a group are duplicates, whatever other groups hold;
* the firsts (one per key and group) are numbered per key.

Both levels are windows of one chain: in the second one the firsts of a key
share a group and every other row stays in the group it has. So the input is
read and numbered once, a key spreads even where the input is already
partitioned by it, and rows that are equal in every column spread over the
partitions they come from. No row is counted, copied or changed on the way, and
the plan does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.profile import sql_ident


def _ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """``order``, then all other non-key columns as tie breakers; ascending, NULLs first."""
    if not order:
        raise ValueError("name the order that decides which row of a key is the first")
    names = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    return [F.col(sql_ident(c)).asc_nulls_first() for c in names]


# Groups that a key's rows of one input partition are split into.
SALT_BUCKETS = 32


def _numbered_in_groups(df: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """``__rn``: the place of a row among the rows of its key and group; ``__group`` is never 0."""
    own = [F.col(sql_ident(k)) for k in keys]
    values = [F.col(sql_ident(c)) for c in df.columns]
    salt = F.pmod(F.xxhash64(*values), F.lit(SALT_BUCKETS))
    grouped = df.withColumn("__group", F.spark_partition_id().cast("long") * SALT_BUCKETS + salt + 1)
    return grouped.withColumn("__rn", F.row_number().over(Window.partitionBy(*own, "__group").orderBy(*by)))


def duplicate_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows whose key occurred before, by ``order`` (ascending, NULLs first).

    The order is required, since Spark has no file order; columns missing from
    it are appended as tie breakers. NULL keys are equal to each other.
    """
    by = _ordered(df, keys, order)
    own = [F.col(sql_ident(k)) for k in keys]
    numbered = (_numbered_in_groups(df, keys, by)
                .withColumn("__group", F.when(F.col("__rn") == 1, F.lit(0).cast("long")).otherwise(F.col("__group"))))
    place = F.row_number().over(Window.partitionBy(*own, "__group").orderBy(*by))
    return (numbered.withColumn("__place", place).filter((F.col("__group") != 0) | (F.col("__place") > 1))
            .drop("__group", "__rn", "__place"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """The first row of every key by ``order`` (default: all non-key columns), ascending, NULLs first.

    This is the one rule for repeated keys of an increment (``append_parquet``
    and the stream): the same rows give the same first row on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    if not order and not rest:
        return df.dropDuplicates(list(keys))
    by = _ordered(df, keys, order or rest)
    own = [F.col(sql_ident(k)) for k in keys]
    firsts = _numbered_in_groups(df, keys, by).filter(F.col("__rn") == 1)
    return (firsts.withColumn("__rn", F.row_number().over(Window.partitionBy(*own).orderBy(*by)))
            .filter(F.col("__rn") == 1).drop("__group", "__rn"))


def duplicate_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))
