"""Exact top-k search by tiled matrix products.

Vectors are quantised and gathered into blocks inside the tasks that read them: candidate blocks of at most
``BLOCK_ROWS`` rows, which are dealt evenly over shards, and query blocks of at most ``QUERY_ROWS`` rows. Every query
block is sent to every shard (a copy per shard, not per row), and the join on the shard gives the tiles. A tile is one
matrix product followed by a partial selection of ``k`` candidates per query. The lists are merged as a tree: first
those of the tiles of a shard, in the task that made them, then ``FAN`` shards at a time.

Scores are exact integers. Vectors are kept divided by ``SCALE``, so that no component overflows. Products run in 32-bit or 64-bit floating point only where the norms show that every
partial sum is an integer that the type holds; otherwise in whole numbers of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import table, written

K = 5
QUERY_EVERY = 50
SCALE = 256
BLOCK_ROWS, QUERY_ROWS = 8192, 1024
SHARD_ROWS = 1 << 20  # candidates per shard, once there are more shards than cores
FAN = 16  # lists merged into one at each level of the tree
LONG_MAX = (1 << 63) - 1
BLOCKS = ("dim int, block long, rows int, ids binary, data binary, norm double")


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows with an id and a vector without NULL and non-finite components."""
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite))


def blocks(batches: Iterator, rows: int) -> Iterator:
    """Blocks of vectors of equal length; each block is numbered by task and place."""
    import pyarrow as pa
    from pyspark import TaskContext

    partition = TaskContext.get().partitionId()
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    made = 0

    def block(dim: int, parts: list) -> pa.RecordBatch:
        nonlocal made
        ids = np.concatenate([p[0] for p in parts])
        order = np.argsort(ids, kind="stable")
        ids, data = ids[order], np.concatenate([p[1] for p in parts])[order]
        with np.errstate(over="ignore"):
            norm = float(np.sqrt((data * data).sum(1)).max()) * SCALE if dim else 0.0
        made += 1
        small = norm < 1 << 24  # whole numbers that a 32-bit float holds
        values = [[dim], [(partition << 32) + made], [len(ids)], [ids.astype("<i8").tobytes()],
                  [data.astype("<f4" if small else "<f8").tobytes()], [norm]]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)],
                                          names=[f.split()[0] for f in BLOCKS.split(", ")])

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(1)
        dims = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        # beyond 2^45 a double times 256 is whole
        fine = np.abs(flat) < 1 << 45
        flat = np.where(fine, np.floor(np.where(fine, flat, 0.0) * SCALE) / SCALE, flat)
        starts = np.concatenate(([0], np.cumsum(dims)))
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            data = flat[starts[at][:, None] + np.arange(dim)[None, :]].reshape(len(at), dim)
            for low in range(0, len(at), rows):
                parts = waiting.setdefault(dim, [])
                parts.append((ids[at[low:low + rows]], data[low:low + rows]))
                if sum(len(p[0]) for p in parts) >= rows:
                    yield block(dim, waiting.pop(dim))
    for dim, parts in waiting.items():
        yield block(dim, parts)


def matrix(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<f8" if rows * dim and len(data) == 8 * rows * dim else "<f4").reshape(rows, dim)


def whole_numbers(m: np.ndarray) -> np.ndarray:
    """A matrix of ``SCALE`` times the entries, as whole numbers of any size."""
    return np.array([[int(x) * SCALE if abs(x) >= 1 << 53 else int(x * SCALE) for x in row] for row in m.tolist()],
                    dtype=object).reshape(m.shape)


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products of the ``SCALE``-fold of matrices; ``bound`` is a bound of every sum of absolute terms."""
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T * np.float32(SCALE * SCALE)).astype(np.int64)
    if bound < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T * float(SCALE * SCALE)).astype(np.int64)
    exact = whole_numbers(a) @ whole_numbers(b).T
    return np.array([[max(-LONG_MAX, min(LONG_MAX, int(x))) for x in row] for row in exact], np.int64).reshape(exact.shape)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of each row, the first columns among ties, in order."""
    n = scores.shape[1]
    if n > 4 * k and np.abs(scores).max() < 1 << 46:  # score and place in one number, so that selection is exact
        joint = scores * n + np.arange(n - 1, -1, -1)
        top = np.argpartition(-joint, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(joint, top, 1), axis=1)
        return np.take_along_axis(top, order, 1)
    return np.argsort(-scores, axis=1, kind="stable")[:, :k]


def tiles(batches: Iterator, k: int) -> Iterator:
    """Partial top lists: one row per query of a tile with its candidates in order."""
    import pyarrow as pa

    for batch in batches:
        for t in batch.to_pylist():
            dim, queries, rows = t["dim"], t["q_rows"], t["rows"]
            q_ids, ids = np.frombuffer(t["q_ids"], "<i8"), np.frombuffer(t["ids"], "<i8")
            a, b = matrix(t["q_data"], queries, dim), matrix(t["data"], rows, dim)
            bound = (t["q_norm"] + 1) * (t["norm"] + 1)
            scores = products(a, b, bound)
            top = best(scores, min(rows, k + int(np.unique(ids, return_counts=True)[1].max())))
            value, found = np.take_along_axis(scores, top, 1), ids[top]
            keep = found != q_ids[:, None]  # a query's own row is no candidate
            keep &= np.cumsum(keep, axis=1) <= k
            counts = keep.sum(1)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(value[keep]), pa.array(found[keep])], names=["score", "vec_id"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(queries, t["q_block"])), pa.array(np.arange(queries)), pa.array(q_ids),
                 pa.array(np.full(queries, t["part"])), pa.ListArray.from_arrays(pa.array(offsets), entries)],
                names=["q_block", "q_row", "query_id", "part", "top"])


def merged(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` best entries (score down, vec_id up) of all lists with the same ``by``: ``down, vec_id, rank``."""
    entry = F.transform("top", lambda e: F.struct((-e["score"]).alias("down"), e["vec_id"].alias("vec_id")))
    return (lists.select(*by, "query_id", F.inline(entry))
            .withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("down", "vec_id")))
            .where(F.col("rank") <= k))


def top_k(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """The ``k`` highest inner products of every query: ``query_id, rank, vec_id, score``.

    Queries are the rows whose ``vec_id`` is divisible by ``query_every``; candidates all rows with another
    ``vec_id`` (rows that repeat a query's id are taken for its own). Ties go to the smaller ``vec_id``. Vectors that are NULL or hold NULL or non-finite components, and
    rows with a NULL ``vec_id``, take no part. Only vectors of equal length are compared. A repeated candidate row
    counts as often as it occurs, a repeated query row is answered again. Scores beyond the range of a long are the
    nearest long. An empty table gives no rows; extra columns are ignored.
    """
    spark = embeddings.sparkSession
    vectors = usable(embeddings)
    candidates = written(spark, vectors.mapInArrow(lambda b: blocks(b, BLOCK_ROWS), BLOCKS), "topk-blocks")
    asked = vectors.where(F.col("vec_id") % query_every == 0)
    asked = asked.repartition(max(1, -(-asked.count() // QUERY_ROWS)))
    queries = written(spark, asked.mapInArrow(lambda b: blocks(b, QUERY_ROWS), BLOCKS), "topk-queries")
    made = candidates.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("blocks")).first()
    shards = max(1, -(-(made.rows or 0) // SHARD_ROWS), min(made.blocks, spark.sparkContext.defaultParallelism))
    # a list belongs to its shard: the lists of a shard meet in one task, which cuts them to k before they are shuffled
    right = candidates.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int")).withColumn(
        "part", F.col("shard").cast("long"))
    left = queries.select("dim", F.col("block").alias("q_block"), F.col("rows").alias("q_rows"),
                          F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("norm").alias("q_norm"),
                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    pairs = left.join(right, ["dim", "shard"]).drop("shard", "block")
    lists = pairs.mapInArrow(lambda b: tiles(b, k), "q_block long, q_row long, query_id long, part long, "
                                                    "top array<struct<score:long,vec_id:long>>")
    query, parts = ["q_block", "q_row"], shards
    while parts > 1:
        lists = (merged(lists, [*query, "part"], k).groupBy(*query, "part", "query_id")
                 .agg(F.collect_list(F.struct((-F.col("down")).alias("score"), "vec_id")).alias("top")))  # k entries
        parts = -(-parts // FAN)
        lists = lists.withColumn("part", F.col("part") % parts)
    return merged(lists, query, k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", (-F.col("down")).alias("score"))


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::HUGEINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
WHERE rank <= {K}
"""


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
