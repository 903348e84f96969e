"""Monthly increments appended to a stored table with Structured Streaming.

The update rule of the star is "append each new month". Here new parquet files
dropped into a folder are picked up by a file stream and appended in
micro-batches (``foreachBatch``). The stream's checkpoint remembers which
files were done, so a restarted job continues where it stopped; rows whose
key is already stored are skipped and of keys repeated inside a batch the first
row counts (the rule of ``append_parquet``), so a batch that is replayed after
a failure adds nothing twice and keeps the same rows.

``trigger(availableNow=True)`` processes whatever is there and stops, which
suits a monthly scheduled run; without it the same code runs continuously.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmart.sources.sinks import append_parquet


def append_increments(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                      keys: Sequence[str], checkpoint: str, available_now: bool = True,
                      max_files_per_trigger: int | None = None, partition_by: Sequence[str] | None = None,
                      keys_within_partitions: bool | None = None, timeout_seconds: float | None = None):
    """Append every new file of ``source_dir`` to the parquet table ``target``.

    Each micro-batch is appended by ``append_parquet``. If the files are not
    done after ``timeout_seconds``, the stream is stopped and ``TimeoutError``
    raised; a later run goes on from its checkpoint.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def append_batch(batch: DataFrame, _epoch: int) -> None:
        append_parquet(batch.sparkSession, batch, target, keys=keys,
                       partition_by=partition_by, keys_within_partitions=keys_within_partitions)

    writer = stream.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    handle = writer.start()
    if available_now:
        done = handle.awaitTermination(timeout_seconds)
        if timeout_seconds is not None and not done:
            handle.stop()
            raise TimeoutError(f"files left after {timeout_seconds} seconds")
    return handle
