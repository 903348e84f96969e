"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A change is a row with a sign: an insert is ``+1``, a delete ``-1``, a revised count a ``-1`` row with the old and a
``+1`` row with the new values (also when a document changes its source or language). Totals are additive, so a batch
is reduced to its sums per group and stored on its own; the totals are the sums over all committed batches. A commit
writes to a staging folder and renames it to the folder of its batch id, which happens at once or not at all. A
batch id that is already there is not applied again, so a batch can be replayed after any failure.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import table, written
from starmart.llm.tokens import tokenizer, vocabulary_path
from starmart.session import scratch_path

GROUP = ("source", "lang", "tokenizer_version")
WORDS, PIECES = "words_v1", "byte_bpe_50k"
STORED = "source string, lang string, tokenizer_version string, documents long, tokens long"
LOADS = 4


def counted(batches: Iterator, path: str) -> Iterator:
    import pyarrow as pa

    encode = tokenizer(path).encode
    for batch in batches:
        texts = [t.as_py() or "" for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2),
             pa.array([len(t.encode("utf-8", "replace").split()) for t in texts], pa.int64()),
             pa.array([len(encode(t)) // 4 for t in texts], pa.int64())],
            names=["doc_id", "source", "lang", "words", "pieces"])


def document_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, source, lang, words, pieces`` of every whole text; NULL texts count as empty."""
    path = vocabulary or vocabulary_path()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text").mapInArrow(
        lambda b: counted(b, path), "doc_id long, source string, lang string, words long, pieces long")


def signed(counts: DataFrame, version: str, column: str, sign: int) -> DataFrame:
    """Changes of one sign: ``source, lang, tokenizer_version, sign, tokens``."""
    return counts.select("source", "lang", F.lit(version).alias("tokenizer_version"), F.lit(sign).alias("sign"),
                         F.col(column).cast("long").alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that replace the rows ``old`` (``source, lang, tokenizer_version, tokens``) with ``new``."""
    columns = [*GROUP, "tokens"]
    return (old.select(*columns).withColumn("sign", F.lit(-1))
            .unionByName(new.select(*columns).withColumn("sign", F.lit(1))))


class RollupStore:
    """Totals in a folder of the shared file system, one sub-folder per committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file_system(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        return hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop.Path

    def _folder(self, batch_id: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_-]{1,100}", batch_id):
            raise ValueError(f"batch id {batch_id!r}: 1 to 100 letters, digits, _ and - are allowed")
        return f"{self.path}/committed/batch={batch_id}"

    def has(self, batch_id: str) -> bool:
        files, path = self._file_system()
        return files.exists(path(self._folder(batch_id)))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (``source, lang, tokenizer_version, sign, tokens``) unless the batch is already there.

        Sums are taken before the shuffle in every task, so a hot source costs no more than any other. Returns
        whether this call committed the batch. NULL group values are groups of their own.
        """
        target = self._folder(batch_id)
        if self.has(batch_id):
            return False
        staged = f"{self.path}/staging/{batch_id}-{uuid.uuid4().hex}"
        sums = (changes.groupBy(*GROUP)
                .agg(F.sum(F.col("sign").cast("long")).alias("documents"),
                     F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
                .where("documents <> 0 OR tokens <> 0"))
        sums.select(*(F.col(f.split()[0]).cast(f.split()[1]) for f in STORED.split(", "))).write.parquet(staged)
        files, path = self._file_system()
        files.mkdirs(path(f"{self.path}/committed"))
        if not files.exists(path(target)) and files.rename(path(staged), path(target)) and not files.exists(
                path(f"{target}/{staged.rsplit('/', 1)[1]}")):
            return True
        files.delete(path(staged), True)  # another writer was first: its batch stands
        files.delete(path(f"{target}/{staged.rsplit('/', 1)[1]}"), True)
        return False

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer_version, documents, tokens`` over all committed batches; empty groups are left out."""
        files, path = self._file_system()
        folder = f"{self.path}/committed"
        if not files.exists(path(folder)):
            return self.spark.createDataFrame([], STORED)
        return (self.spark.read.schema(STORED).parquet(folder).groupBy(*GROUP)
                .agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
                .where("documents <> 0 OR tokens <> 0"))


def load_and_revise(docs: DataFrame, store: RollupStore, vocabulary: str | None = None) -> DataFrame:
    """Totals of ``docs`` (``doc_id, source, lang, text``), maintained through batches as a pipeline would.

    Documents arrive in ``LOADS`` batches with their word counts, which also stand in for the token counts; one batch
    revises those to the counts of the tokenizer; every batch is then delivered a second time, which changes nothing.
    Repeated rows count as often as they occur; an empty table gives no groups.
    """
    counts = written(docs.sparkSession, document_counts(docs, vocabulary), "token-counts")
    load = F.pmod(F.xxhash64("doc_id"), F.lit(LOADS))
    batches = {}
    for i in range(LOADS):
        own = counts.where(load == i)
        batches[f"load-{i}"] = signed(own, WORDS, "words", 1).unionByName(signed(own, PIECES, "words", 1))
    old, new = signed(counts, PIECES, "words", 1), signed(counts, PIECES, "pieces", 1)
    batches["revise"] = revisions(old, new)
    for _ in range(2):
        for batch_id, changes in batches.items():
            store.commit(batch_id, changes)
    return store.totals()


def op9_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_and_revise(table(spark, sf_dir, "documents"), RollupStore(spark, scratch_path(spark, "token-rollups")))
