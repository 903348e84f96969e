"""Small helpers shared by the text operators."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starmart
from starmart.session import file_system, scratch_path

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application: a zip of its sources in the shared folder, added with
    ``addPyFile``. Tasks import the modules their functions come from, and executors need not have them installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(starmart.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(source.relative_to(root.parent)))
    path = f"{scratch_path(spark, 'sources')}/starmart.zip"
    files, cls = file_system(spark, path)
    stream = files.create(cls(path))
    stream.write(packed.getvalue())
    stream.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shipped(function: Callable) -> Callable:
    """A query or stage (its first argument is the session) that ships the package first."""
    @wraps(function)
    def run(spark: SparkSession, *args):
        ship_package(spark)
        return function(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; NULL for a NULL id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(col.cast("string").cast("binary")) % F.lit(folds)).cast("int")


def written(spark: SparkSession, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Used to cut lineage and to compute an expensive table once: the files are on the shared file system, so
    they outlive lost executors.
    """
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, key: Column, rows: int, count: int) -> DataFrame:
    """About ``rows`` of ``count`` rows, chosen by a hash of ``key`` (the same rows on every run)."""
    return df if count <= rows else df.where(in_sample(key, rows, count))


def in_sample(key: Column, rows: int, count: int) -> Column:
    """Whether ``hashed_sample`` takes a row."""
    share = min(1.0, rows / count) if count else 1.0
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
