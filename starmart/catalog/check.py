"""Compare a registered query with its SQL twin (development and test tool).

Row count, column names (sorted) and the multiset of rows are compared; float
values are rounded to 9 significant digits before comparing, so only real
differences count.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from dataclasses import dataclass

import duckdb
from pyspark.sql import SparkSession

from starmart.catalog.oracle import ORACLE
from starmart.catalog.spark_queries import QUERIES
from starmart.plans.adapters import TABLES


@dataclass
class Result:
    name: str
    ok: bool
    spark_rows: int
    oracle_rows: int | None
    detail: str = ""


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


EXACT = False  # compare floats bit for bit (set by ``tools/oracle_check.py --exact``)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> Result:
    df = QUERIES[name](spark, sf_dir)
    s_names = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        return Result(name, True, len(s_rows), None, "no oracle")
    rel = con.sql(ORACLE[name])
    o_names = [d[0] for d in rel.description]
    o_rows = rel.fetchall()
    if sorted(s_names) != sorted(o_names):
        return Result(name, False, len(s_rows), len(o_rows), f"columns {sorted(s_names)} vs {sorted(o_names)}")
    if len(s_rows) != len(o_rows):
        return Result(name, False, len(s_rows), len(o_rows), "row counts differ")
    a, b = Counter(_rows(s_names, s_rows)), Counter(_rows(o_names, o_rows))
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_o = list((b - a).elements())[:3]
        return Result(name, False, len(s_rows), len(o_rows), f"spark-only {only_s} oracle-only {only_o}")
    return Result(name, True, len(s_rows), len(o_rows))
