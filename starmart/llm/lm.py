"""Language-model scores by deleted interpolation.

A bigram, a smoothed unigram and a uniform estimate are mixed with weights that depend on how often the context was
seen (buckets of powers of two). The weights are learned by expectation-maximisation on a held-out tenth of the
training documents, with counts of the other training documents; scores then use the counts of all of them.

Counts grow with the corpus, so they are never gathered anywhere. Consecutive documents form chunks, inside tasks.
A chunk lists its different words and bigrams once, as sorted 64-bit hashes with counts, cut into shards by the top
bits of the hash. A shard adds up what all chunks say about its hashes, and answers each chunk with the totals in
the order asked, without the hashes. A chunk joined with its answers has all counts its documents need. The number
of shards grows with the tokens, so a shard's size does not; a frequent word is one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import fold, table, written

FOLDS = 10
EM_FOLD = 9  # of the training folds 1 to 9, the one the mixture weights are learned on
CHUNK_TOKENS = 2_000_000
LEAST_SHARDS = 128
SHARD_TOKENS = 2_000_000
SMOOTHING = 0.1
BINS = 4  # per factor of two, for the ratios that expectation-maximisation works on
ROUNDS = 200
CHUNKS = ("chunk long, em boolean, tokens long, train_tokens long, doc_ids array<long>, folds array<int>, "
          "lengths array<int>, stream binary, words binary")
REQUESTS = "shard int, chunk long, em boolean, n int, hashes binary, counts binary"
ANSWERS = "chunk long, shard int, em boolean, counts binary, counts_em binary, known long, known_em long"
CELLS = "bucket int, bigram int, unigram int, events long"
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(data: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=size * n), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


def names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def chunked(batches: Iterator) -> Iterator:
    """Documents as word numbers within a chunk; number 0 ends a document and is the context of its first word."""
    import pyarrow as pa
    from pyspark import TaskContext

    partition, made = TaskContext.get().partitionId(), 0
    waiting: dict[bool, tuple[dict, list, list, list]] = {}

    def chunk(em: bool) -> pa.RecordBatch:
        nonlocal made
        index, ids, folds, streams = waiting.pop(em)
        made += 1
        lengths = [len(s) for s in streams]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in index), np.uint64, len(index))
        values = [[(partition << 32) + made], [em], [sum(lengths)], [sum(n for n, f in zip(lengths, folds) if f)],
                  [ids], [folds], [lengths], [squeezed(np.concatenate(streams))], [squeezed(hashes)]]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[
            "chunk", "em", "tokens", "train_tokens", "doc_ids", "folds", "lengths", "stream", "words"])

    sizes = {True: 0, False: 0}
    for batch in batches:
        for doc_id, number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            em = number == EM_FOLD
            index, ids, folds, streams = waiting.setdefault(em, ({b"": 0}, [], [], []))
            words = (text.as_py() or "").encode("utf-8", "replace").lower().split()
            streams.append(np.array([*[index.setdefault(w, len(index)) for w in words], 0], np.uint32))
            ids.append(doc_id)
            folds.append(number)
            sizes[em] += len(words) + 1
            if sizes[em] >= CHUNK_TOKENS:
                sizes[em] = 0
                yield chunk(em)
    for em in list(waiting):
        yield chunk(em)


class Chunk:
    """The different words and bigrams of a chunk row and their order by hash."""

    def __init__(self, row: dict):
        self.row = row
        self.lengths = np.array(row["lengths"], np.int64)
        total = int(self.lengths.sum())
        self.hashes = expanded(row["words"], "<u8", self._words(row["words"]))
        self.now = expanded(row["stream"], "<u4", total).astype(np.int64)
        self.before = np.concatenate(([0], self.now[:-1]))  # a document ends with 0, so the next one starts after 0
        self.ends = np.cumsum(self.lengths)
        codes = self.before * len(self.hashes) + self.now
        pairs, self.pair = np.unique(codes, return_inverse=True)
        with np.errstate(over="ignore"):
            a, b = self.hashes[pairs // len(self.hashes)], self.hashes[pairs % len(self.hashes)]
            mixed = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xD6E8FEB86659FD93)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        # the last bit tells words from bigrams
        self.keys = np.concatenate((self.hashes | np.uint64(1), mixed & ~np.uint64(1)))
        self.order = np.argsort(self.keys, kind="stable")

    @staticmethod
    def _words(data: bytes) -> int:
        return zstandard.frame_content_size(data) // 8

    def cuts(self, shards: int) -> np.ndarray:
        """Where the shards (a power of two of them) begin and end in the ordered keys."""
        shift = np.uint64(64 - (shards.bit_length() - 1))
        parts = (self.keys[self.order] >> shift).astype(np.int64)
        return np.searchsorted(parts, np.arange(shards + 1))

    def train_counts(self) -> np.ndarray:
        """How often each key occurs in the training documents of the chunk."""
        trains = np.array([bool(f) for f in self.row["folds"]], float)
        weight = np.repeat(trains, self.lengths)
        words = np.bincount(self.now, weight, len(self.hashes))
        return np.concatenate((words, np.bincount(self.pair, weight, len(self.keys) - len(self.hashes)))).astype(np.int64)


def requests(batches: Iterator, shards: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            chunk = Chunk(row)
            counts, keys, cuts = chunk.train_counts()[chunk.order], chunk.keys[chunk.order], chunk.cuts(shards)
            for low in range(0, shards, 64):
                rows = [(s, a, b) for s, a, b in zip(range(low, shards), cuts[low:low + 64].tolist(),
                                                     cuts[low + 1:low + 65].tolist()) if b > a]
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _, _ in rows], pa.int32()), pa.array([row["chunk"]] * n, pa.int64()),
                     pa.array([row["em"]] * n, pa.bool_()), pa.array([b - a for _, a, b in rows], pa.int32()),
                     pa.array([squeezed(np.diff(keys[a:b], prepend=np.uint64(0))) for _, a, b in rows], pa.binary()),
                     pa.array([squeezed(counts[a:b]) for _, a, b in rows], pa.binary())], names=names(REQUESTS))


def answers(asked):
    """All requests of one shard: totals per hash, sent back to every chunk in its order."""
    import pyarrow as pa

    rows = asked.to_pylist()
    hashes = [np.cumsum(expanded(r["hashes"], "<u8", r["n"]), dtype=np.uint64) for r in rows]
    counts = [expanded(r["counts"], "<i8", r["n"]) for r in rows]
    keys, place = np.unique(np.concatenate(hashes), return_inverse=True)
    every = np.concatenate(counts)
    kept = np.concatenate([np.zeros(r["n"], np.int64) if r["em"] else c for r, c in zip(rows, counts)])
    total = np.bincount(place, every, len(keys)).astype(np.int64)
    without_em = np.bincount(place, kept, len(keys)).astype(np.int64)
    word = (keys & np.uint64(1)) == 1
    known, known_em = int((word & (total > 0)).sum()), int((word & (without_em > 0)).sum())
    ends = np.cumsum([r["n"] for r in rows])
    parts = np.split(place, ends[:-1])
    values = [[r["chunk"] for r in rows], [r["shard"] for r in rows], [r["em"] for r in rows],
              [squeezed(total[p]) for p in parts], [squeezed(without_em[p]) if r["em"] else None for r, p in zip(rows, parts)],
              [known] + [0] * (len(rows) - 1), [known_em] + [0] * (len(rows) - 1)]
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names(ANSWERS))


class Statistics:
    """Training tokens and different training words: of all, and without the held-out tenth."""

    def __init__(self, tokens: int, words: int, tokens_em: int, words_em: int):
        self.tokens, self.words, self.tokens_em, self.words_em = tokens, words, tokens_em, words_em


def estimates(chunk: Chunk, answered, column: str, tokens: int, words: int) -> tuple[np.ndarray, ...]:
    """Per token of a chunk: context count, word count, bigram, unigram and uniform estimates."""
    parts = sorted(answered.select(["shard", column]).to_pylist(), key=lambda r: r["shard"])
    ordered = [expanded(r[column], "<i8", zstandard.frame_content_size(r[column]) // 8) for r in parts]
    counts = np.zeros(len(chunk.keys), np.int64)
    counts[chunk.order] = np.concatenate(ordered)
    word, pair = counts[:len(chunk.hashes)], counts[len(chunk.hashes):]
    context, own = word[chunk.before], word[chunk.now]
    bigram = pair[chunk.pair] / np.maximum(context, 1)
    unigram = (own + SMOOTHING) / (tokens + SMOOTHING * (words + 1))
    return context, own, bigram, unigram, 1.0 / (words + 1)


def buckets(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the exponent of its count."""
    return np.frexp(context.astype(float))[1]


def held_out_cells(stats: Statistics):
    """Function of a chunk and its answers: its tokens counted by bucket and ratios of the estimates."""
    def of(chunks, answered):
        import pyarrow as pa

        found: dict[tuple, int] = {}
        for row in chunks.to_pylist():
            context, _, bigram, unigram, uniform = estimates(Chunk(row), answered, "counts_em", stats.tokens_em,
                                                             stats.words_em)
            with np.errstate(divide="ignore"):
                second = np.where(bigram > 0, np.rint(BINS * np.log2(bigram / uniform)), -10_000).astype(np.int64)
            first = np.rint(BINS * np.log2(unigram / uniform)).astype(np.int64)
            cells, n = np.unique(np.stack([buckets(context).astype(np.int64), second, first], 1), axis=0, return_counts=True)
            for cell, k in zip(map(tuple, cells.tolist()), n.tolist()):
                found[cell] = found.get(cell, 0) + k
        columns = list(zip(*((*c, n) for c, n in found.items()))) or [(), (), (), ()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int32()] * 3 + [pa.int64()])],
                                    names=names(CELLS))
    return of


def expectation_maximisation(cells: list[tuple[int, int, int, int]]) -> dict[int, tuple[float, float, float]]:
    """Mixture weights (bigram, unigram, uniform) by bucket; key -1 holds the weights over all events.

    Each event's estimates are known up to the factor of the uniform one, which the weights do not depend on.
    """
    def fitted(rows: list) -> tuple[float, float, float]:
        ratio = np.array([[0.0 if b == -10_000 else 2.0 ** (b / BINS), 2.0 ** (a / BINS), 1.0] for b, a, _ in rows])
        events = np.array([n for *_, n in rows], float)
        weights = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = ratio * weights
            share /= share.sum(1, keepdims=True)
            new = events @ share / events.sum()
            done = np.abs(new - weights).max() < 1e-7
            weights = new
            if done:
                break
        weights = np.maximum(weights, 1e-6)  # no text may get probability zero
        return tuple(float(w) for w in weights / weights.sum())

    by_bucket: dict[int, list] = {}
    for bucket, second, first, n in sorted(cells):
        by_bucket.setdefault(bucket, []).append((second, first, n))
    found = {bucket: fitted(rows) for bucket, rows in by_bucket.items()}
    every = [r for rows in by_bucket.values() for r in rows]
    found[-1] = fitted(every) if every else (1 / 3, 1 / 3, 1 / 3)
    return found


def weights_table(weights: dict[int, tuple[float, float, float]]) -> np.ndarray:
    """Weights of buckets 0 to 63; a bucket without events takes those of the next lower one that has any."""
    rows, last = [], weights[-1]
    for bucket in range(64):
        last = weights.get(bucket, last)
        rows.append(last)
    return np.array(rows)


def scored(stats: Statistics, weights: np.ndarray):
    """Function of a chunk and its answers: the scores of its documents."""
    def of(chunks, answered):
        import pyarrow as pa

        out = []
        for row in chunks.to_pylist():
            chunk = Chunk(row)
            context, own, bigram, unigram, uniform = estimates(chunk, answered, "counts", stats.tokens, stats.words)
            w = weights[buckets(context)]
            mixed = np.log10(w[:, 0] * bigram + w[:, 1] * unigram + w[:, 2] * uniform)
            starts = chunk.ends - chunk.lengths
            sums = [np.add.reduceat(v, starts) for v in ((own > 0).astype(np.int64), np.log10(unigram), mixed)]
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array([None if f is None else f == 0 for f in row["folds"]], pa.bool_()),
                 pa.array(chunk.lengths), pa.array(sums[0]), pa.array(np.full(len(starts), stats.tokens)),
                 pa.array(sums[1]), pa.array(sums[2])], names=names(SCORES)))
        return pa.Table.from_batches(out) if out else pa.table(
            {n: pa.array([], {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[f.split()[1]])
             for n, f in zip(names(SCORES), SCORES.split(", "))})
    return of


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text of ``docs``.

    Learns from rows with ``crc32(doc_id) mod 10 <> 0``. NULL and empty texts are the end token alone. A row with a
    NULL ``doc_id`` is scored with ``held_out`` NULL and not learned from. Repeated rows are learned and scored each.
    Extra columns are ignored; an empty table gives no rows. Without training rows every estimate is uniform.
    """
    spark = docs.sparkSession
    chunks = written(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold("doc_id", FOLDS).alias("fold"),
                                        "text").mapInArrow(chunked, CHUNKS), "lm-chunks", "uncompressed")
    sums = chunks.agg(F.sum("tokens").alias("tokens"), F.sum("train_tokens").alias("train"),
                      F.sum(F.when(~F.col("em"), F.col("train_tokens"))).alias("train_em")).first()
    shards = 1 << max(LEAST_SHARDS - 1, (sums.tokens or 0) // SHARD_TOKENS).bit_length()
    asked = chunks.select("chunk", "em", "folds", "lengths", "stream", "words").mapInArrow(
        lambda b: requests(b, shards), REQUESTS)
    answered = written(spark, asked.groupBy("shard").applyInArrow(answers, ANSWERS), "lm-answers", "uncompressed")
    words = answered.agg(F.sum("known").alias("words"), F.sum("known_em").alias("words_em")).first()
    stats = Statistics(sums.train or 0, words.words or 0, sums.train_em or 0, words.words_em or 0)

    def with_answers(column: str, which, function, schema: str) -> DataFrame:
        left = chunks.where(which).select("chunk", "doc_ids", "folds", "lengths", "stream", "words")
        right = answered.where(which).select("chunk", "shard", column)
        return left.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(function, schema)

    cells = (with_answers("counts_em", F.col("em"), held_out_cells(stats), CELLS)
             .groupBy("bucket", "bigram", "unigram").agg(F.sum("events").alias("events")).collect())  # bounded by its bins
    weights = weights_table(expectation_maximisation([tuple(r) for r in cells]))
    return with_answers("counts", F.lit(True), scored(stats, weights), SCORES)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
