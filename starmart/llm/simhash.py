"""SimHash near-duplicates found by Golay-code fuzzy hashing.

Fingerprints (64 bits) link when at most 3 bits differ. A fingerprint is cut into segments of 22, 21 and 21 bits.
Three errors over three segments leave one of two cases: some segment has none and a second one at most one, or
each has exactly one. So the keys of a fingerprint are, for every ordered pair of segments, the exact first segment
with each decoding index of the second (a segment is padded to a 23-bit Golay word), and the triples of decoding
indices of all three segments, matched only between opposite weight parities. Two linked fingerprints share a key;
candidates with a common key are verified bit by bit inside the join.

Only different fingerprints take part, so copies cost nothing. A key shared by more than ``FULL_KEY`` fingerprints
(a large family of near copies) is not paired: its members go to an exact linear path. Every such fingerprint visits
all words within 2 bits of it. A word visited by a fingerprint at most 1 bit away joins all its visitors (they
are at most 3 bits from that fingerprint), and any two fingerprints within 3 bits meet at such a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm import golay
from starmart.llm.common import table, written
from starmart.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
FULL_KEY = 128
TASK_FINGERPRINTS = 20_000  # keyed by one task: about a million keys
TASK_CROWDED = 1000  # their visits are made by one task: about two millions
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and length


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the word shingles of a text (XXH64, seed 42); 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    count = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):  # bounded memory for very long texts
        a = starts[at:at + (1 << 16)][:count - at]
        b = ends[min(SHINGLE_WORDS, len(words)) - 1:][at:at + (1 << 16)]
        hashes = np.array([digest(line[i:j], SEED) for i, j in zip(a.tolist(), b.tolist())], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > count, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprinted(batches: Iterator) -> Iterator:
    """Replaces the last column, the text, with its fingerprint."""
    import pyarrow as pa

    for batch in batches:
        *others, texts = batch.columns
        found = np.array([fingerprint(text.as_py()) for text in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*others, pa.array(found)], names=[*batch.schema.names[:-1], "fingerprint"])


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints (int64): ``(key, position of its fingerprint)``."""
    words = fingerprints.view(np.uint64)
    parts = [((words >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    decoded = [golay.indices(p) for p in parts]
    rows = np.arange(len(words))
    found, owners = [], []

    def add(key: np.ndarray, valid: np.ndarray) -> None:
        found.append(key[valid])
        owners.append(np.broadcast_to(rows.reshape(-1, *[1] * (key.ndim - 1)), key.shape)[valid])

    for tag, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        key = (tag << 40) | (parts[i][:, None] << 12) | decoded[j]
        add(key, decoded[j] >= 0)
    odd = sum(golay.parity(p) << k for k, p in enumerate(parts))
    group = np.minimum(odd, 7 - odd)  # 0 to 3: a class of parities and its opposite
    a, b, c = decoded[0][:, :, None, None], decoded[1][:, None, :, None], decoded[2][:, None, None, :]
    triple = ((6 + group)[:, None, None, None] << 40) | (a << 24) | (b << 12) | c
    add(triple, (a >= 0) & (b >= 0) & (c >= 0))
    return np.concatenate(found), np.concatenate(owners)


def keyed(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 2000):
            fingerprints = every[at:at + 2000]
            key, owner = keys(fingerprints)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fingerprints[owner])],
                                             names=["key", "fingerprint"])


def masks() -> tuple[np.ndarray, np.ndarray]:
    """The 2081 words of weight at most 2, and whether the weight is at most 1."""
    bits = [c for k in range(3) for c in combinations(range(64), k)]
    return (np.array([sum(1 << b for b in c) for c in bits], np.uint64).view(np.int64),
            np.array([len(c) < 2 for c in bits]))


def visited(batches: Iterator) -> Iterator:
    import pyarrow as pa

    words, close = masks()
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 64):
            fingerprints = every[at:at + 64]
            hub = (fingerprints[:, None] ^ words[None, :]).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(hub), pa.array(np.repeat(fingerprints, len(words))),
                 pa.array(np.tile(close, len(fingerprints)))], names=["hub", "fingerprint", "close"])


def crowded_links(fingerprints: DataFrame) -> DataFrame:
    """Edges that connect exactly the fingerprints within 3 bits of each other; linear in their number.

    The visitors of a word (2081 at most) meet in a window. A join would be planned by the size of the fingerprints, to
    Spark also that of their 2081 times as many visits, and would broadcast the visits.
    """
    tasks = max(1, -(-fingerprints.count() // TASK_CROWDED))
    visits = (fingerprints.select("fingerprint").repartition(tasks, "fingerprint")
              .mapInArrow(visited, "hub long, fingerprint long, close boolean"))
    hub = Window.partitionBy("hub")
    return (visits.select("fingerprint", F.min("fingerprint").over(hub).alias("b"), F.max("close").over(hub).alias("close"))
            .where("close AND fingerprint <> b").select(F.col("fingerprint").alias("a"), "b").distinct())


def links(fingerprints: DataFrame, full_key: int = FULL_KEY) -> DataFrame:
    """Edges ``a, b`` between different fingerprints (a column ``fingerprint`` without repeats) whose components
    are those of all links of at most 3 bits."""
    spark = fingerprints.sparkSession
    tasks = max(1, -(-fingerprints.count() // TASK_FINGERPRINTS))  # a small table would be read by few tasks
    table_of_keys = fingerprints.select("fingerprint").repartition(tasks, "fingerprint").mapInArrow(keyed, "key long, fingerprint long")
    sizes = table_of_keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # merged: planned by the size of the fingerprints, their 51 times as many keys would be broadcast
    shared = written(spark, table_of_keys.join(written(spark, sizes, "simhash-keys").hint("merge"), "key"), "simhash-shared")
    pairs = shared.where(F.col("members") <= full_key)
    left, right = pairs.select("key", F.col("fingerprint").alias("a")), pairs.select("key", F.col("fingerprint").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    direct = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & close).select("a", "b")
    crowded = shared.where(F.col("members") > full_key).select("fingerprint").distinct()
    if crowded.take(1):
        direct = direct.unionByName(crowded_links(written(spark, crowded, "simhash-crowded")))
    return direct


def fingerprint_classes(prints: DataFrame, full_key: int = FULL_KEY) -> DataFrame:
    """``fingerprint, component, component_id`` of the different fingerprints of ``prints`` (``row, fingerprint``):
    the smallest fingerprint and the smallest row id of the component."""
    spark = prints.sparkSession
    groups = written(spark, prints.groupBy("fingerprint").agg(F.min("row").alias("first")), "simhash-groups")
    members = connected_components(links(groups, full_key)).withColumnRenamed("node", "fingerprint")
    smallest = (members.join(groups, "fingerprint").groupBy("component").agg(F.min("first").alias("smallest")))
    joined = written(spark, members.join(smallest, "component"), "simhash-members")
    return written(spark, groups.join(joined, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"),
        F.coalesce("smallest", "first").alias("component_id")), "simhash-classes")


def simhash_components(docs: DataFrame, full_key: int = FULL_KEY) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (``doc_id``, ``text``).

    NULL and empty texts have the fingerprint zero and are linked like any other. ``component_id`` is the smallest
    ``doc_id`` of the component; a NULL ``doc_id`` is never the smallest, and a component of such rows alone has
    NULL. Repeated rows stay; extra columns are ignored; an empty table gives no rows.
    """
    prints = written(docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("row"), "text")
                     .mapInArrow(fingerprinted, "row long, fingerprint long"), "simhash-prints")
    return (prints.join(fingerprint_classes(prints, full_key), "fingerprint", "left")
            .select(F.col("row").alias("doc_id"),
                    F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"))


def without_near_duplicates(docs: DataFrame, full_key: int = FULL_KEY) -> DataFrame:
    """The rows of ``docs`` (all columns) with one row for each component: that of the smallest ``doc_id`` (NULL last;
    of several rows with that id the one with the smallest row hash).

    Rows are told apart by id and a hash of all columns. The texts are shuffled once, to meet the chosen rows.
    """
    spark = docs.sparkSession
    row_hash = F.xxhash64(*(docs[f"`{c}`"] for c in docs.columns))
    prints = written(spark, docs.select(F.col("doc_id").cast("long").alias("row"), row_hash.alias("hash"), "text")
                     .mapInArrow(fingerprinted, "row long, hash long, fingerprint long"), "simhash-prints")
    rows = prints.groupBy("fingerprint", "row", "hash").agg(F.count(F.lit(1)).alias("times"))
    chosen = (rows.join(fingerprint_classes(prints, full_key), "fingerprint").groupBy("component")
              .agg(F.min(F.struct(F.col("row").isNull().alias("last"), "row", "hash", "times")).alias("c"))
              .select(F.col("c.row").alias("kept_row"), F.col("c.hash").alias("kept_hash"), "c.times"))
    chosen = written(spark, chosen, "simhash-kept")

    def rows_of(which: DataFrame) -> DataFrame:
        return docs.join(which, docs["doc_id"].cast("long").eqNullSafe(which["kept_row"])
                         & (row_hash == which["kept_hash"]), "left_semi")

    repeated = chosen.where("times > 1")
    if not repeated.take(1):
        return rows_of(chosen)
    return rows_of(chosen.where("times = 1")).unionByName(rows_of(repeated).dropDuplicates())


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
