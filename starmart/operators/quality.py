"""Data-quality checks that return report DataFrames instead of printing.

Each check is one aggregate job per table (not one query per column), and all
reports have a ``status`` column with ``passed`` / ``failed``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.profile import null_profile

PASSED, FAILED = "passed", "failed"


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED))


def check_nulls(df: DataFrame, table_name: str, nan_fails: bool = False,
                profile: DataFrame | None = None) -> DataFrame:
    """Per column: NULL count (and NaN count for floats); failed when NULLs exist.

    The original fails a column on ``IS NULL`` only; ``nan_fails=True`` also
    fails it on NaN. ``profile`` reuses a ``null_profile`` of ``df``.
    """
    p = null_profile(df) if profile is None else profile
    bad = F.col("missing_count") if nan_fails else F.col("null_count")
    return p.select(F.lit(table_name).alias("table_name"), "position", "column_name",
                    "null_count", "nan_count", _status(bad == 0).alias("status"))


def check_table_verdict(report: DataFrame) -> DataFrame:
    """A table fails when any of its columns failed."""
    return (report.groupBy("table_name")
            .agg(F.count_if(F.col("status") == FAILED).alias("failed_columns"))
            .withColumn("status", _status(F.col("failed_columns") == 0)))


def check_row_count(df: DataFrame, table_name: str, min_rows: int = 0) -> DataFrame:
    """Row count of a table; fails below ``min_rows`` (0 never fails, as the original)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table_name).alias("table_name"), "row_count",
        _status(F.col("row_count") >= min_rows).alias("status"))


def check_key_coverage(fact: DataFrame, fact_keys: Sequence[str],
                       dimensions: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Distinct fact key tuples, and how many of them occur in each dimension.

    ``fact_keys`` counts tuples without NULLs (``COUNT(DISTINCT a, b)``);
    ``matched_keys`` is the inner join of the two DISTINCT key sets. The distinct
    fact keys are joined once per dimension with a left join, so both numbers
    come out of one plan per dimension; each key set is distinct before it
    is shuffled.
    """
    names = [f"k{i}" for i in range(len(fact_keys))]
    fk = fact.select(*[F.col(k).alias(n) for k, n in zip(fact_keys, names)]).distinct()
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(n).isNotNull()
    parts = []
    for dim_name, (dim, dim_keys) in dimensions.items():
        dk = (dim.select(*[F.col(k).alias(n) for k, n in zip(dim_keys, names)]).distinct()
              .withColumn("__hit", F.lit(True)))
        parts.append(fk.join(dk, names, "left").agg(
            F.count_if(complete).alias("fact_keys"),
            F.count_if(F.col("__hit").isNotNull()).alias("matched_keys"),
        ).select(F.lit(dim_name).alias("dimension"), "fact_keys", "matched_keys",
                 (F.col("fact_keys") - F.col("matched_keys")).alias("unmatched_keys")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Is the key set a primary key? ``(row_count, distinct_keys, is_unique)``.

    NULLs count as equal keys (as ``drop_duplicates``). One grouped count with
    partial aggregation, then a global sum of one row per key group.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.sum("__n").cast("long").alias("row_count"),
                       F.count(F.lit(1)).alias("distinct_keys")).select(
        F.coalesce(F.col("row_count"), F.lit(0).cast("long")).alias("row_count"), "distinct_keys",
        (F.coalesce(F.col("row_count"), F.lit(0)) == F.col("distinct_keys")).alias("is_unique"))


def check_age_consistency(df: DataFrame, computed_age: Column, given_age: Column) -> DataFrame:
    """Histogram of computed minus given age (rows with a given age only)."""
    return (df.filter(given_age.isNotNull())
            .groupBy((computed_age - given_age).alias("difference"))
            .agg(F.count(F.lit(1)).alias("count")))


def date_order_violations(df: DataFrame, departure: str, arrival: str) -> DataFrame:
    """Rows that depart on or before they arrive (NULL dates drop out)."""
    return df.filter(F.col(departure) <= F.col(arrival))


def check_date_order(df: DataFrame, departure: str, arrival: str) -> DataFrame:
    """Count of rows departing on or before arrival; fails when there are any."""
    return df.agg(F.count_if(F.col(departure) <= F.col(arrival)).alias("violations")).withColumn(
        "status", _status(F.col("violations") == 0))


def check_all(tables: Mapping[str, DataFrame], fact_name: str, fact_keys: Sequence[str],
              dimensions: Mapping[str, Sequence[str]], min_rows: int = 1,
              profiles: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """NULL and row-count checks on every table, then fact-to-dimension coverage.

    ``dimensions`` names the dimension tables and their key columns matching
    ``fact_keys``. A table with fewer than ``min_rows`` rows fails. Returns
    ``{"nulls", "verdicts", "row_counts", "coverage"}``; ``nulls`` has a row per
    column. ``profiles`` gives profiles by table name that are known already (e.g. ``file_stats.stored_profile``); those
    tables are not scanned for them.
    """
    nulls = None
    counts = None
    for name, df in tables.items():
        # One scan per table: the profile carries the row count as well.
        profile = profiles[name] if profiles and name in profiles else null_profile(df)
        n = check_nulls(df, name, profile=profile)
        c = (profile.agg(F.max("row_count").alias("row_count"))
             .select(F.lit(name).alias("table_name"), F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"),
                     _status(F.coalesce("row_count", F.lit(0)) >= min_rows).alias("status")))
        nulls = n if nulls is None else nulls.unionByName(n)
        counts = c if counts is None else counts.unionByName(c)
    coverage = check_key_coverage(tables[fact_name], fact_keys,
                                  {d: (tables[d], keys) for d, keys in dimensions.items()})
    return {"nulls": nulls, "verdicts": check_table_verdict(nulls), "row_counts": counts,
            "coverage": coverage}
