"""Table profiles: missing values per column, schema and table statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)


def sql_ident(name: str) -> str:
    """A column name as a quoted SQL identifier (blanks, dots and backticks are safe)."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """A text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def profile_aggregates(fields: Sequence[T.StructField]) -> list[str]:
    """Two SQL aggregates a column: its NULLs and (0 but for float/double columns) its NaNs."""
    aggs = []
    for field in fields:
        c = sql_ident(field.name)
        aggs.append(f"count_if({c} IS NULL)")
        aggs.append(f"count_if(isnan({c}))" if isinstance(field.dataType, _FLOATS) else "CAST(0 AS BIGINT)")
    return aggs


def profile_rows(sums: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """One row per column of the table from one row of ``__rows``, ``__null<i>`` and ``__nan<i>``."""
    entries = [f"named_struct('position', {i + 1}, 'column_name', {sql_string(field.name)}, "
               f"'null_count', __null{i}, 'nan_count', __nan{i}, 'missing_count', __null{i} + __nan{i}, "
               f"'row_count', __rows)" for i, field in enumerate(fields)]
    return sums.selectExpr(f"inline(array({', '.join(entries)}))")


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values of every column in one pass over the table.

    One aggregate computes, per column, the NULL count and (for float/double
    columns) the NaN count; the one-row result is turned into one row per
    column: ``position, column_name, null_count, nan_count, missing_count, row_count``.
    Both steps are given as SQL expressions (quoted names), which keeps plan
    construction cheap for wide tables. ``file_stats.stored_profile`` adds up the
    same counts per data file of a stored table.
    """
    fields = df.schema.fields
    aggs = profile_aggregates(fields)
    named = [f"{aggs[2 * i + j]} AS __{what}{i}" for i in range(len(fields)) for j, what in enumerate(("null", "nan"))]
    return profile_rows(df.selectExpr("count(1) AS __rows", *named), fields)


def null_percent(df: DataFrame) -> DataFrame:
    """Missing share in % of all rows, only for columns that have any."""
    p = null_profile(df)
    return (p.filter(F.col("missing_count") > 0)
            .select("position", "column_name", "missing_count",
                    (F.col("missing_count") * F.lit(100.0) / F.col("row_count")).alias("missing_percent")))


def schema_report(spark: SparkSession, df: DataFrame, table_name: str | None = None) -> DataFrame:
    """The schema as rows ``(position, column_name, data_type, nullable)``.

    Built from the plan's metadata (one row per column), not from the data.
    """
    rows = [(table_name, i + 1, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    schema = "table_name string, position int, column_name string, data_type string, nullable boolean"
    out = spark.createDataFrame(rows, schema)
    return out if table_name is not None else out.drop("table_name")


def table_stats(spark: SparkSession, tables: Mapping[str, DataFrame], sample: bool = False) -> DataFrame:
    """For each table: its schema rows and its row count (a scalar subquery).

    ``sample`` adds the values of a sample row as text (``sample_value``): the
    smallest row, comparing column by column with NULLs first. Count and sample
    come from one partially aggregated pass over the table.
    """
    parts = []
    for name, df in tables.items():
        report = schema_report(spark, df, name)
        if not sample:
            parts.append(report.withColumn("row_count", df.agg(F.count(F.lit(1))).scalar()))
            continue
        cols = [F.col(sql_ident(c)) for c in df.columns]
        one = df.agg(F.count(F.lit(1)).alias("row_count"), F.min(F.struct(*cols)).alias("row"))
        values = F.array(*[F.col("row").getField(c).cast("string") for c in df.columns])
        one = one.select("row_count", F.posexplode(values).alias("__pos", "sample_value"))
        parts.append(report.join(one, report["position"] == one["__pos"] + 1).drop("__pos"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
