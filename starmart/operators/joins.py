"""Joins of the star: code lookups, key-set joins and ``IN (subquery)``.

A code table is broadcast only after its rows and bytes were counted (one
aggregate over the code table alone; the other side is never probed). A larger
code table is joined by one salted shuffle join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code tables of the star have hundreds of rows; a side up to this size is
# broadcast. Beyond it the join shuffles.
DEFAULT_BROADCAST_MAX_ROWS = 200_000
DEFAULT_BROADCAST_MAX_BYTES = 32 << 20
DEFAULT_SALT_BUCKETS = 32


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: the length of texts and binaries (of others their text), 16 for a fixed-width value."""
    sizes = [F.lit(16)]
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16)
        else:
            sizes.append(F.lit(16))
    return reduce(lambda x, y: x + y, sizes).cast("long")


def fits_broadcast_all(dfs: Sequence[DataFrame], max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> list[bool]:
    """For each table: at most ``max_rows`` rows and ``max_bytes`` bytes? One job
    of partial aggregates; one row per table reaches the driver."""
    if max_rows <= 0 or not dfs:
        return [False] * len(dfs)
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes"))
             .select(F.lit(i).alias("i"), "rows", "bytes") for i, df in enumerate(dfs)]
    found = {r["i"]: r for r in reduce(DataFrame.unionByName, parts).collect()}
    return [found[i]["rows"] <= max_rows and (found[i]["bytes"] or 0) <= max_bytes for i in range(len(dfs))]


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """Does ``df`` have at most ``max_rows`` rows and ``max_bytes`` bytes? (see ``fits_broadcast_all``)"""
    return fits_broadcast_all([df], max_rows, max_bytes)[0]


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is within both bounds, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def _hashable(kind: T.DataType) -> bool:
    """Can Spark hash values of the type? (maps have no order)"""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def salted_join(df: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner",
                salt_buckets: int = DEFAULT_SALT_BUCKETS, null_safe: bool = False) -> DataFrame:
    """Shuffle join in which a key's rows of ``df`` spread over ``salt_buckets`` partitions.

    ``on`` maps columns of ``df`` to columns of ``right``. The salt of a row comes
    from its values and its input partition: a key spreads where ``df`` is already
    partitioned by it, rows that are equal in every column spread over the
    partitions they come from, and a task that runs again draws the same salts. Each row
    of ``right`` is repeated once per salt, so every row of ``df`` meets it
    once. That holds for inner and left joins; other joins would return the
    repeated rows of ``right`` and are refused. With ``null_safe`` NULL keys
    are equal.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted joins are inner or left, not {how!r}")
    values = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields if _hashable(f.dataType)]
    left = df.withColumn("__salt", F.pmod(F.xxhash64(*values, F.spark_partition_id()), F.lit(salt_buckets)).cast("int"))
    right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    cond = left["__salt"] == right["__salt_r"]
    for a, b in on.items():
        cond = cond & (left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b])
    return left.join(right, cond, how).drop("__salt", "__salt_r")


def lookup_join(df: DataFrame, codes: DataFrame, key: str, add: Mapping[str, str],
                code_col: str = "code", how: str = "inner",
                broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, broadcast: bool | None = None,
                salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Join a code table on ``df[key] = codes[code_col]`` and add its columns.

    ``add`` maps code-table columns to new names. With ``how='inner'`` rows whose
    code is unknown are dropped, as in the original star build; ``left`` keeps
    them; other joins are refused. The same code table can be joined again for
    a second role (another ``key``). ``broadcast`` gives a size decision made
    earlier (``fits_broadcast``); when it is None the code table is checked
    here. A code table too large to broadcast takes ``salted_join``: no code is
    hot for a single task, and ``df`` is read once whatever its size.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookups are inner or left joins, not {how!r}")
    tmp = f"__code_{key}"
    right = codes.select(F.col(code_col).alias(tmp), *[F.col(src).alias(dst) for src, dst in add.items()])
    if broadcast is None:
        broadcast = fits_broadcast(right, broadcast_max_rows)
    if broadcast:
        right = F.broadcast(right)
        return df.join(right, df[key] == right[tmp], how).drop(tmp)
    return salted_join(df, right, {key: tmp}, how, salt_buckets).drop(tmp)


def _key_frame(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])


def distinct_pair_join(left: DataFrame, left_keys: Sequence[str], right: DataFrame,
                       right_keys: Sequence[str]) -> DataFrame:
    """Inner join of the DISTINCT key sets of two tables (NULL keys never match).

    Each side is reduced to its distinct keys first (partial aggregation
    before the shuffle), so a hot key costs one row per map task.
    """
    names = [f"k{i}" for i in range(len(left_keys))]
    lk = _key_frame(left, left_keys, names).distinct()
    rk = _key_frame(right, right_keys, names).distinct()
    return lk.join(rk, names, "inner").select(*[F.col(n).alias(k) for n, k in zip(names, left_keys)])


def in_subquery(df: DataFrame, c: str, other: DataFrame, other_c: str) -> DataFrame:
    """Rows of ``df`` whose ``c`` occurs in ``other[other_c]`` (``IN (SELECT ...)``).

    A left-semi join against the distinct values of the subquery.
    """
    values = other.select(F.col(other_c).alias("__in_value")).distinct()
    return df.join(values, df[c] == values["__in_value"], "left_semi")
