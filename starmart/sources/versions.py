"""Versions of a set of tables that readers always see together.

A version is one small file, ``_versions/00000002.json``, that names the folders each table consists of. Data folders are
written first and never changed; the file is written under another name and renamed when all of them are there. Readers take
the highest version, so they see all of an update or nothing, and an update that fails anywhere leaves the version
before. Folders that were published without a version file (``root/<table>``) count as version 1.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from starmart.session import file_system
from starmart.sources.sinks import table_exists

VERSIONS, DATA = "_versions", "_data"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, path = file_system(spark, root)
    found = files.globStatus(path(f"{root}/{VERSIONS}/*.json")) or []
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found)


def _content(spark: SparkSession, root: str, number: int) -> dict:
    files, path = file_system(spark, root)
    stream = files.open(path(f"{root}/{VERSIONS}/{number:08d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, root: str, tables: Mapping[str, str]) -> dict:
    """``{"version": n, "tables": {name: [folders below root]}}`` of the highest version; version 0 has no folders.

    ``tables`` maps the names to the folders they have without a version file.
    """
    numbers = _numbers(spark, root)
    if numbers:
        return _content(spark, root, numbers[-1])
    there = {name: [folder] for name, folder in tables.items() if table_exists(spark, f"{root}/{folder}")}
    return {"version": 1 if there else 0, "tables": {name: there.get(name, []) for name in tables}}


def new_folder(number: int) -> str:
    """A folder below the root for the data of a version; an attempt that failed never shares it."""
    return f"{DATA}/{number:08d}-{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, root: str, number: int, tables: Mapping[str, Sequence[str]]) -> None:
    """Make ``tables`` version ``number``. Another update that took the number first is an error."""
    files, path = file_system(spark, root)
    target, staged = path(f"{root}/{VERSIONS}/{number:08d}.json"), path(f"{root}/{VERSIONS}/_{uuid.uuid4().hex[:12]}")
    stream = files.create(staged)
    try:
        stream.write(bytearray(json.dumps({"version": number, "tables": {k: list(v) for k, v in tables.items()}}).encode()))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(staged, target):
        files.delete(staged, False)
        raise FileExistsError(f"version {number} of {root} is there: another update came first")


def read(spark: SparkSession, root: str, folders: Iterable[str]) -> DataFrame:
    """The rows of some folders. Each is read on its own, as the folders of partitioned tables have no common root;
    filters and columns are pushed into every one."""
    return reduce(DataFrame.unionByName, (spark.read.parquet(f"{root}/{folder}") for folder in folders))


def clean(spark: SparkSession, root: str, tables: Mapping[str, str], keep: int = 2) -> list[str]:
    """Delete data that none of the newest ``keep`` versions needs, and the files of older versions.

    Call it when no reader is left that began with an older version. Returns the folders that went.
    """
    numbers = _numbers(spark, root)
    if not numbers:
        return []
    files, path = file_system(spark, root)
    needed = {folder for n in numbers[-keep:] for folders in _content(spark, root, n)["tables"].values() for folder in folders}
    listed = [f"{DATA}/{v.getPath().getName()}/{t.getPath().getName()}" for v in files.globStatus(path(f"{root}/{DATA}/*")) or []
              for t in files.listStatus(v.getPath())]
    gone = [f for f in [*tables.values(), *listed] if f not in needed and files.exists(path(f"{root}/{f}"))]
    for n in numbers[:-keep]:
        files.delete(path(f"{root}/{VERSIONS}/{n:08d}.json"), False)
    for folder in gone:
        files.delete(path(f"{root}/{folder}"), True)
    return gone
