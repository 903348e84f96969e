"""Statistics of the data files of a stored table, kept beside it.

A data file never changes once it is written, so what was counted in it stays right while it exists. Each kind of
statistics is a small Parquet table ``<table>/_stats/<kind>`` (hidden from readers of the table) with one row per
data file. ``update`` computes the rows of files that have none, in one job over those files alone: the files of the
last append, of another writer, or of an append that was lost before its statistics were written. Rows of files that
are gone are ignored, and of rows written twice by two updates at once, which are equal, one counts.

Kinds:

* key ranges (``files_with_keys``): the smallest and largest key of a file. An append compares its keys only with files
  whose range meets a range of the increment;
* column profiles (``stored_profile``): rows, NULLs and NaNs by column. They add up to the profile of the table, so a
  check after an append scans the new files only;
* distinct keys (``stored_unique_key``): rows and first occurrences of keys, batch by batch.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.profile import profile_aggregates, profile_rows, sql_ident
from starmart.session import file_system

STATS = "_stats"
# Ranges that the keys of an increment are summarised into (rows of one small aggregate).
INTERVALS = 64


def _kind(name: str, parts: Sequence[str]) -> str:
    return f"{name}-{zlib.crc32(json.dumps(list(parts)).encode()):08x}"


def _uri_path(spark: SparkSession, path: str) -> str:
    files, cls = file_system(spark, path)
    return urlparse(files.makeQualified(cls(path)).toUri().toString()).path.rstrip("/")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of the table at ``path``: paths below it, as they stand in a URI."""
    root = _uri_path(spark, path)
    return sorted(urlparse(f).path[len(root) + 1:] for f in spark.read.parquet(path).inputFiles())


def read_files(spark: SparkSession, path: str, files: Sequence[str]) -> DataFrame:
    """The rows of some data files, with the columns and types of the whole table."""
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    root = path.rstrip("/")
    names = [f"{root}/" + re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(f)) for f in files]  # no pattern but the caller's
    return spark.read.schema(schema).option("basePath", path).parquet(*names)


def _file_column(spark: SparkSession, path: str) -> Column:
    whole = F.regexp_replace(F.col("_metadata.file_path"), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.substring(whole, len(_uri_path(spark, path)) + 2, 1 << 20)


def _names(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(f,) for f in files], "file string")


def _stored(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    where = f"{path.rstrip('/')}/{STATS}/{kind}"
    files, cls = file_system(spark, where)
    # a folder that an unfinished write left empty has no schema yet
    return spark.read.parquet(where) if files.globStatus(cls(f"{where}/*.parquet")) else None


def update(spark: SparkSession, path: str, kind: str, aggregates: Sequence[Column]) -> list[str]:
    """Compute ``aggregates`` of every data file without a row; returns those files."""
    present, stored = data_files(spark, path), _stored(spark, path, kind)
    known = set() if stored is None else {r.file for r in stored.select("file").collect()}
    missing = [f for f in present if f not in known]
    if missing:
        found = (read_files(spark, path, missing).groupBy(_file_column(spark, path).alias("file"))
                 .agg(F.count(F.lit(1)).alias("row_count"), *aggregates))
        rows = (_names(spark, missing).join(found, "file", "left")  # a file without rows has a row, too
                .withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("long"))))
        rows.coalesce(1 + len(missing) // 10_000).write.mode("append").parquet(f"{path.rstrip('/')}/{STATS}/{kind}")
    return missing


def statistics(spark: SparkSession, path: str, kind: str, aggregates: Sequence[Column]) -> DataFrame:
    """One row per data file of the table, brought up to date first."""
    update(spark, path, kind, aggregates)
    return (_stored(spark, path, kind).join(_names(spark, data_files(spark, path)), "file", "left_semi")
            .dropDuplicates(["file"]))


# ---------------------------------------------------------------- key ranges

def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(sql_ident(k)).alias(f"k{i}") for i, k in enumerate(keys)])


def key_ranges(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``file, row_count, lo, hi``: the smallest and largest key of every data file (NULLs first)."""
    return statistics(spark, path, _kind("keys", keys), [F.min(_key(keys)).alias("lo"), F.max(_key(keys)).alias("hi")])


def files_with_keys(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str],
                    intervals: int = INTERVALS) -> list[str]:
    """The data files that may hold a key of ``df``: their key range meets one of its ranges.

    The keys of ``df`` are sorted into ``intervals`` ranges, of which only the ends are kept, so gaps between its keys
    count. If key types differ from the stored ones, every file may hold one. The bound on what an append reads
    comes from the ranges: keys that arrive roughly in order, or a table written by ``append_parquet`` (sorted by
    key), touch few files; random keys touch all.
    """
    schema = spark.read.parquet(path).schema
    if any(df.schema[k].dataType != schema[k].dataType for k in keys):
        return data_files(spark, path)
    ranges = key_ranges(spark, path, keys)
    ends = (df.select(_key(keys).alias("key")).repartitionByRange(intervals, "key")
            .groupBy(F.spark_partition_id()).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
            .agg(F.collect_list(F.struct("lo", "hi")).alias("ends")))
    met = F.exists("ends", lambda e: (F.col("lo") <= e["hi"]) & (F.col("hi") >= e["lo"]))
    return sorted(r.file for r in ranges.withColumn("ends", ends.scalar()).filter(met).select("file").collect())


def rows_near(spark: SparkSession, path: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the files that may hold a key of ``df``."""
    return read_files(spark, path, files_with_keys(spark, path, df, keys))


# ---------------------------------------------------------------- column profiles

def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """``null_profile`` of a stored table from the profiles of its files; only files that are new since the last call are
    scanned. A column that a file was written (and profiled) without is NULL in all its rows."""
    fields = spark.read.parquet(path).schema.fields
    counts = [F.expr(a) for a in profile_aggregates(fields)]
    names = [F.lit(f.name) for f in fields]
    # per file: column name -> (NULLs, NaNs)
    entries = [v for i, (f, name) in enumerate(zip(fields, names))
               for v in (name, F.struct(counts[2 * i].alias("null_count"), counts[2 * i + 1].alias("nan_count")))]
    files = statistics(spark, path, "columns", [F.create_map(*entries).alias("columns")])
    sums = [F.coalesce(F.sum("row_count"), F.lit(0).cast("long")).alias("__rows")]
    for i, name in enumerate(names):
        at = F.try_element_at("columns", name)
        nulls, nans = F.coalesce(at["null_count"], F.col("row_count")), F.coalesce(at["nan_count"], F.lit(0))
        sums += [F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(f"__{what}{i}") for what, n in (("null", nulls), ("nan", nans))]
    return profile_rows(files.agg(*sums), fields)


# ---------------------------------------------------------------- distinct keys

def stored_unique_key(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """``check_unique_key`` of a stored table; only files new since the last call, and old ones that may hold one
    of their keys, are read.

    ``_stats/unique-…`` has a row per counted file with its batch and the batch's rows and keys that no earlier batch had.
    Their sums are the report. If a counted file is gone, or was counted by two batches at once, everything is counted anew.
    """
    kind = _kind("unique", keys)
    present, stored = set(data_files(spark, path)), _stored(spark, path, kind)
    rows = [] if stored is None else stored.collect()
    epochs = [r.epoch for r in rows]
    epoch = max(epochs, default=0)
    rows = [r for r in rows if r.epoch == epoch]
    counted = {r.file for r in rows}
    if len(counted) != len(rows) or not counted <= present:
        epoch, rows, counted = epoch + 1, [], set()
    batches = {r.batch: (r.row_count, r.new_keys) for r in rows}
    missing = sorted(present - counted)
    if missing:
        fresh = read_files(spark, path, missing)
        total = fresh.groupBy(_key(keys).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        old = []
        if counted:
            near = set(files_with_keys(spark, path, fresh, keys))
            old = sorted(near & counted)
        if old:
            seen = read_files(spark, path, old).select(_key(keys).alias("old_key")).distinct().withColumn("seen", F.lit(1))
            total = total.join(seen, F.col("key").eqNullSafe(F.col("old_key")), "left")
        else:
            total = total.withColumn("seen", F.lit(None).cast("int"))
        found = total.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                          F.count_if(F.col("seen").isNull()).alias("new_keys")).first()
        batch = uuid.uuid4().hex
        batches[batch] = (found["rows"], found["new_keys"])
        spark.createDataFrame([(epoch, batch, f, found["rows"], found["new_keys"]) for f in missing], T.StructType([
            T.StructField("epoch", T.LongType()), T.StructField("batch", T.StringType()), T.StructField("file", T.StringType()),
            T.StructField("row_count", T.LongType()), T.StructField("new_keys", T.LongType())])).coalesce(
            1 + len(missing) // 10_000).write.mode("append").parquet(f"{path.rstrip('/')}/{STATS}/{kind}")
    total_rows, distinct = (sum(b[i] for b in batches.values()) for i in (0, 1))
    return spark.createDataFrame([(total_rows, distinct, total_rows == distinct)],
                                 "row_count long, distinct_keys long, is_unique boolean")
