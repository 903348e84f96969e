"""Sinks: parquet (new or appended), CSV code tables, temporary views.

Writes go through Spark's commit protocol: a failed task is retried and only
committed files appear, so a lost executor does not leave partial output.
A failed write raises; nothing is swallowed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.duplicates import first_rows
from starmart.operators.profile import sql_ident
from starmart.session import file_system
from starmart.sources import file_stats


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] | None = None, sort_by: Sequence[str] | None = None) -> str:
    """Save as parquet; by default fails if ``path`` exists.

    ``sort_by`` names key columns: files then hold ranges of keys (within a partition value, sorted runs) and Bloom filters
    of them, so reads of some keys skip files and row groups.

    With ``partition_by`` the rows are first rebalanced on those columns, so a
    partition value is written by one task, or by as many as its size asks for,
    and not by every task that has a row of it.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(sql_ident(c)) for c in partition_by])
    if sort_by:
        by = [F.col(sql_ident(c)) for c in sort_by]
        if not partition_by:
            df = df.repartitionByRange(*by)
        df = df.sortWithinPartitions(*[F.col(sql_ident(c)) for c in partition_by or ()], *by)
    writer = df.write.mode(mode)
    if sort_by:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        for c in sort_by:
            if c not in (partition_by or ()):
                writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a stored table (a folder with a file that is not hidden, nor in a hidden folder) at ``path``?"""
    files, cls = file_system(spark, path)
    if not files.exists(cls(path)):
        return False
    root = files.makeQualified(cls(path)).toString().rstrip("/")
    listing = files.listFiles(cls(path), True)
    while listing.hasNext():
        parts = listing.next().getPath().toString()[len(root) + 1:].split("/")
        if not any(p.startswith(".") or (p.startswith("_") and "=" not in p) for p in parts):
            return True
    return False


def publish(spark: SparkSession, staged: str, target: str, overwrite: bool = False) -> str:
    """Rename a finished folder to ``target`` in one step. An existing ``target`` is an error, or with ``overwrite``
    is moved away first and deleted afterwards."""
    files, cls = file_system(spark, target)
    old = None
    if files.exists(cls(target)):
        if not overwrite:
            raise FileExistsError(target)
        old = f"{target}__old-{uuid.uuid4().hex[:12]}"
        if not files.rename(cls(target), cls(old)):
            raise OSError(f"cannot move {target} away")
    parent = cls(target).getParent()
    if parent is not None:
        files.mkdirs(parent)
    if not files.rename(cls(staged), cls(target)):
        if old and not files.rename(cls(old), cls(target)):
            raise OSError(f"cannot publish {staged} as {target}; what was there is in {old}")
        raise OSError(f"cannot publish {staged} as {target}")
    if old:
        files.delete(cls(old), True)
    return target


def new_rows(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str],
             within_partitions: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not yet stored at ``path`` (NULL-safe left-anti join).

    ``within_partitions`` names partition columns of the stored table that
    follow from the key (e.g. the arrival date of an arrival). Then only stored
    partitions between the increment's smallest and largest value are read (two
    values per column reach the driver), and of those only the ones the
    increment has rows of (a semi join with its distinct values). So a monthly
    append reads one month of keys, whatever the number of partitions. Without
    them only files are read whose key range meets the increment's
    (``file_stats.files_with_keys``).
    """
    if not table_exists(spark, path):
        return df
    if within_partitions:
        return rows_not_in(df, spark.read.parquet(path), keys, within_partitions)
    return rows_not_in(df, file_stats.rows_near(spark, path, df, keys), keys)


def rows_not_in(df: DataFrame, stored: DataFrame, keys: Sequence[str],
                within_partitions: Sequence[str] | None = None) -> DataFrame:
    """``new_rows`` for a stored table that is read already."""
    if within_partitions:
        cols = [sql_ident(c) for c in within_partitions]
        ends = df.agg(*[f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))],
                      *[F.max(F.col(c).isNull()).alias(f"null{i}") for i, c in enumerate(cols)]).first()
        for i, c in enumerate(cols):
            inside = F.lit(False)
            if ends[f"lo{i}"] is not None:
                inside = F.col(c).between(F.lit(ends[f"lo{i}"]), F.lit(ends[f"hi{i}"]))
            stored = stored.filter(inside | F.col(c).isNull() if ends[f"null{i}"] else inside)
        touched = df.select(*[F.col(c).alias(f"__t_{i}") for i, c in enumerate(cols)]).distinct()
        same = F.lit(True)
        for i, c in enumerate(cols):
            same = same & stored[c].eqNullSafe(touched[f"__t_{i}"])
        stored = stored.join(touched, same, "left_semi")
    stored = stored.select(*[F.col(sql_ident(k)).alias(f"__s_{i}") for i, k in enumerate(keys)])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[sql_ident(k)].eqNullSafe(stored[f"__s_{i}"])
    return df.join(stored, cond, "left_anti")


def append_parquet(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str] | None = None,
                   partition_by: Sequence[str] | None = None, keys_within_partitions: bool | None = None,
                   order: Sequence[str] | None = None) -> str:
    """Add an increment to a stored table; with ``keys``, rows whose key is
    already stored are skipped, so re-running the same increment adds nothing.

    One rule holds for keys repeated inside an increment: the first row by
    ``order`` (default: all other columns, ascending, NULLs first) is kept.
    Keys are compared only in the partitions the increment touches if the
    partition columns are part of the key, or if ``keys_within_partitions`` says
    that they follow from it; otherwise only in files whose key range meets
    the increment's (see ``new_rows``). Files are written sorted by key, so
    their ranges stay narrow, and their ranges are kept in ``_stats`` beside them.
    """
    if not keys:
        return write_parquet(df, path, mode="append", partition_by=partition_by)
    if keys_within_partitions is None:
        keys_within_partitions = bool(partition_by) and set(partition_by) <= set(keys)
    rows = first_rows(df, keys, order)
    rows = new_rows(spark, rows, path, keys, partition_by if keys_within_partitions else None)
    return write_parquet(rows, path, mode="append", partition_by=partition_by, sort_by=keys)


def write_code_csv(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = ",") -> str:
    """A code table as CSV with a header line. Values come back unchanged from ``scan_csv`` (with ``multi_line`` if
    they hold line breaks): quotes are doubled, blanks at the edges stay, NULL is an empty field and the empty text
    an empty quoted one."""
    (df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Bind ``name`` to the plan (replacing a previous binding) for SQL users."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
