"""The corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; its result is written as
Parquet on the shared file system and read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm.common import shipped, table, written
from starmart.llm.decontamination import without_contaminated
from starmart.llm.packing import pack_documents
from starmart.llm.pii import without_pii
from starmart.llm.simhash import without_near_duplicates
from starmart.llm.toxicity import without_toxic


@shipped
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.5 or more."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


@shipped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by SimHash fingerprints."""
    return without_near_duplicates(docs)


@shipped
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain benchmark items."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@shipped
def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return without_pii(docs)


@shipped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: Trained classifiers and tokenizer ids cannot be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
