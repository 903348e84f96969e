"""Readers: parquet, comma and semicolon CSV, declared schemas.

Everything is read by Spark directly into a DataFrame; no table passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.profile import sql_ident


def scan_parquet(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet with the schema from the files; ``columns`` prunes the scan."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def scan_parquet_footers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet whose counts, minima and maxima come from the file footers; no data page is read for them.

    ``row_count``, ``min_max`` and plain ``agg(count, min, max)`` over it push the aggregate into the scan, where Parquet keeps
    exact statistics: numbers, dates and booleans (not texts or old timestamps), without a filter on rows. Everything else
    gives the same result by a scan. Spark does this in its newer file reader alone, which is a setting of a session, so
    the frame belongs to a session of its own with the settings of ``spark``, which stays as it is.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    v1 = [s for s in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(*([path] if isinstance(path, str) else path))


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, sep: str = ",",
             null_value: str | None = None, header: bool = True, multi_line: bool = False,
             corrupt_column: str | None = None) -> DataFrame:
    """CSV with a header line and a declared schema, applied by position.

    Quotes inside a quoted field are doubled, as pandas and spreadsheets write
    them. An empty field is NULL, an empty quoted field the empty text; the word
    ``NA`` stays text unless it is passed as ``null_value``; blanks at the edges
    of a field are kept. With ``multi_line`` a quoted field may hold line
    breaks; a file is then read by one task, so large files should be many.
    Malformed values become NULL (permissive mode); ``corrupt_column`` adds a
    text column with the whole record of every malformed row, so that they can
    be counted.
    """
    if corrupt_column:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    reader = (spark.read.schema(schema).option("header", header).option("sep", sep).option("escape", '"')
              .option("multiLine", multi_line).option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False).option("mode", "PERMISSIVE").option("enforceSchema", True))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    # an unquoted empty field reads as this text, which is then NULL; an empty quoted field stays the empty text
    reader = reader.option("nullValue", "\u0000" if null_value is None else null_value)
    return reader.csv(path if isinstance(path, str) else list(path))


def scan_csv_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                       sep: str = ";", **kwargs) -> DataFrame:
    """CSV with another separator (semicolon by default)."""
    return scan_csv(spark, path, schema, sep=sep, **kwargs)


def typed_frame(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Apply a declared schema by position: rename and cast every column.

    Text that does not fit the type becomes NULL (``try_cast``).
    """
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns, schema has {len(schema.fields)}")
    return df.select(*[F.col(sql_ident(c)).try_cast(f.dataType).alias(f.name)
                       for c, f in zip(df.columns, schema.fields)])
