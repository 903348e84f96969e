"""The five code tables of the label file, as one Spark job per section.

Replaces the original's "read the label file five times on the driver and write
CSVs" step: every section is parsed from the same whole-text rows, typed, and
optionally written as a CSV code table with a header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import constants as K
from starmart.sources.labels import label_dictionary, label_dictionary_pair
from starmart.sources.sinks import write_code_csv

PAIR_SECTIONS = {"I94PORT"}
NUMERIC_CODES = {"i94_country", "i94_model", "i94_visa"}


def _number(code: str, table: str) -> Column:
    number = F.col(code).try_cast("bigint")
    problem = F.raise_error(F.concat(F.lit(f"{table}: code is not a number: "), F.col(code))).cast("bigint")
    return F.when(F.col(code).isNotNull() & number.isNull(), problem).otherwise(number)


def code_tables(texts: DataFrame, required: bool = True) -> dict[str, DataFrame]:
    """``{table name: DataFrame}`` for every section of ``K.LABEL_SECTIONS``.

    Numeric code lists get a BIGINT code; a code that is not a number fails the
    job. So does a text without one of the sections, unless ``required`` is
    false.
    """
    out = {}
    for tag, (name, header) in K.LABEL_SECTIONS.items():
        if tag in PAIR_SECTIONS:
            df = label_dictionary_pair(texts, tag, required=required).select(
                F.col("code").alias(header[0]), F.col("value1").alias(header[1]), F.col("value2").alias(header[2]))
        else:
            df = label_dictionary(texts, tag, required=required).select(F.col("code").alias(header[0]), F.col("value").alias(header[1]))
        if name in NUMERIC_CODES:
            df = df.withColumn(header[0], _number(header[0], name))
        out[name] = df
    return out


def write_code_tables(texts: DataFrame, out_dir: str, mode: str = "errorifexists") -> dict[str, str]:
    """Write every code table as ``out_dir/<name>`` (CSV with header)."""
    return {name: write_code_csv(df, f"{out_dir.rstrip('/')}/{name}", mode=mode)
            for name, df in code_tables(texts).items()}
