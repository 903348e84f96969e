"""Toxicity by compression distance: one zstandard dictionary of toxic and one of ordinary text.

Every word is encoded as a few fixed-length codes (hashes of its first 4, 5 and 6 letters and of the whole word).
Such codes do not compress by themselves, so a window of them gets shorter only where the dictionary holds them.
On plain bytes the two lengths differ more by chance matches of ordinary syllables than by toxic words.

Training, on a bounded sample of labelled rows: a code is counted once per context (the words before and after),
so copies of a document do not add up. Codes whose log odds towards toxic rows are high with confidence make the
toxic dictionary; those most typical of ordinary rows make the ordinary one. Of every window of a document the
distance is the length with the ordinary dictionary less the length with the toxic one. The largest and the summed
distances are calibrated on further labelled rows by logistic regression; the threshold is a score of 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import fold, table, written
from starmart.llm.compression import compressor, letters_only

TRAIN_TOXIC, TRAIN_ORDINARY = 1000, 1200  # rows for the dictionaries
CALIBRATE_TOXIC, CALIBRATE_ORDINARY = 600, 2400  # rows for the calibration
EXCERPT_CHARS = 12_000
WINDOW_WORDS = 32
CODE_BYTES = 6
PREFIXES = (4, 5, 6)
DICTIONARY_CODES = 1000
LOG_ODDS = 0.7  # least lower bound of the log odds of a toxic code
LEVEL = 2
CACHED_WORDS = 1 << 16
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
_CODES: dict[bytes, bytes] = {}
_COMPRESSORS: dict[tuple, tuple] = {}


def word_codes(word: bytes) -> list[bytes]:
    text = word.decode("utf-8", "replace")
    parts = [f"{n}:{text[:n]}" for n in PREFIXES if len(text) > n]
    return [xxhash.xxh64_digest(p)[:CODE_BYTES] for p in [*parts, f"={text}"]]


def encoded(words: list[bytes]) -> list[bytes]:
    """The joined codes of each word."""
    if len(_CODES) > CACHED_WORDS:
        _CODES.clear()
    known = _CODES
    for word in words:
        if word not in known:
            known[word] = b"".join(word_codes(word))
    return [known[w] for w in words]


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: tuple[float, ...] = ()):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights

    def compressors(self) -> tuple:
        key = (self.toxic, self.ordinary)
        if key not in _COMPRESSORS:
            _COMPRESSORS.clear()
            _COMPRESSORS[key] = (compressor(self.toxic, LEVEL), compressor(self.ordinary, LEVEL))
        return _COMPRESSORS[key]

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Largest distance, sum of the positive ones and their mean per window, damped."""
        codes = encoded(letters_only(text or "").split())
        toxic, ordinary = self.compressors()
        largest = total = count = 0
        for at in range(0, len(codes), WINDOW_WORDS):
            window = b"".join(codes[at:at + WINDOW_WORDS])
            distance = max(0, len(ordinary.compress(window)) - len(toxic.compress(window)))
            largest, total, count = max(largest, distance), total + distance, count + 1
        return math.sqrt(largest), math.log1p(total), total / max(1, count) / 10.0

    def score(self, text: str | None) -> float:
        if not self.weights or not self.toxic:
            return 0.0
        z = self.weights[0] + sum(w * f for w, f in zip(self.weights[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def code_contexts(texts: list[str]) -> tuple[dict[bytes, int], int]:
    """How many different contexts (neighbouring words) each code has, and how many contexts there are."""
    index: dict[bytes, int] = {b"": 0}
    seen = []
    for text in texts:
        ids = np.array([0, *(index.setdefault(w, len(index)) for w in letters_only(text).split()), 0], np.uint64)
        if len(ids) > 2:
            context = ids[:-2] * np.uint64(0x9E3779B97F4A7C15) + ids[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
            seen.append(np.unique(np.stack([ids[1:-1], context], 1), axis=0))
    if not seen:
        return {}, 0
    distinct = np.unique(np.concatenate(seen), axis=0)
    times = np.bincount(distinct[:, 0].astype(np.int64), minlength=len(index))
    counts: dict[bytes, int] = {}
    for word, n in zip(index, times.tolist()):
        if n:
            for code in word_codes(word):
                counts[code] = counts.get(code, 0) + n
    return counts, len(distinct)


def train(toxic_texts: list[str], ordinary_texts: list[str]) -> Model:
    (a, total_a), (b, total_b) = code_contexts(toxic_texts), code_contexts(ordinary_texts)
    if not a:
        return Model(b"", b"")
    shift = math.log(total_b + 1.0) - math.log(total_a + 1.0)

    def bound(code: bytes, sign: int) -> float:
        x, y = a.get(code, 0) + 0.5, b.get(code, 0) + 0.5
        return sign * (math.log(x) - math.log(y) + shift) - 2.0 * math.sqrt(1.0 / x + 1.0 / y)

    ranked = sorted(((bound(c, 1), c) for c in a), reverse=True)[:DICTIONARY_CODES]
    toxic = [c for v, c in ranked if v > LOG_ODDS]
    plain = sorted(((bound(c, -1), c) for c in b if c not in set(toxic)), reverse=True)
    ordinary = [c for v, c in plain[:max(200, len(toxic))] if a.get(c, 0) == 0]
    return Model(b"".join(reversed(toxic)), b"".join(reversed(ordinary)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Logistic regression with balanced classes (Newton steps)."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def calibrate(features: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic weights whose bias is moved so that a score of 0.5 is the threshold of the best F1.

    A document without any window nearer to toxic text (all features 0) always stays below the threshold.
    """
    if not len(features) or not toxic.any():
        return ()
    if toxic.all():
        return (-1e-6, *(1.0,) * features.shape[1])
    w = logistic(features, toxic)
    z = w[0] + features @ np.array(w[1:])
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + toxic.sum())
    last = np.append(np.diff(z[order]) != 0, True)  # a threshold cannot part equal values
    at = int(np.argmax(np.where(last, f1, -1)))
    low = z[order][at + 1] if at + 1 < len(z) else z[order][at] - 1.0
    return (w[0] - max(float(z[order][at] + low) / 2, w[0] + 1e-6), *w[1:])


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A bounded sample of labelled documents: ``toxic, train, text``; chosen by hash among the learning rows.

    The chosen ids number at most about the sum of the four row parameters, so they are broadcast. Repeated rows
    count once.
    """
    known = (labels.where(F.col("toxic").isin(0, 1)).where(fold("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = {1: (TRAIN_TOXIC, CALIBRATE_TOXIC), 0: (TRAIN_ORDINARY, CALIBRATE_ORDINARY)}
    spread = 1 << 30
    place = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    keep, train_part = F.lit(False), F.lit(False)
    for toxic, (for_train, for_calibration) in rows.items():
        n = max(1, counts.get(toxic, 0))
        both = for_train + for_calibration
        limit = int(min(1.0, both / n) * spread)
        keep = keep | ((F.col("toxic") == toxic) & (place < limit))
        train_part = train_part | ((F.col("toxic") == toxic) & (place < int(limit * for_train / both)))
    chosen = known.where(keep).withColumn("train", train_part)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "toxic", "train", F.coalesce("text", F.lit("")).alias("text")).distinct()


def scored(batches: Iterator, model: Model) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        scores = np.array([model.score(text.as_py()) for text in batch.column(2)], float)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(scores),
             pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])


def sample_features(batches: Iterator, model: Model) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = np.array([model.features(text.as_py()) for text in batch.column(1)], float).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in found.T)],
                                         names=["toxic", "f0", "f1", "f2"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the bounded sample: excerpts for the dictionaries, whole texts for the calibration."""
    sample = written(docs.sparkSession, labelled_sample(docs, labels), "toxicity-sample")
    room = F.greatest(F.length("text") - F.lit(EXCERPT_CHARS), F.lit(0)) + F.lit(1)
    start = (F.pmod(F.xxhash64("text"), room.cast("long")) + F.lit(1)).cast("int")
    excerpts = (sample.where("train").select("toxic", F.substring("text", start, F.lit(EXCERPT_CHARS)).alias("text"))
                .distinct().collect())
    texts = sorted((r["toxic"], r["text"]) for r in excerpts)
    model = train([t for x, t in texts if x == 1], [t for x, t in texts if x == 0])
    if model.toxic:
        rows = (sample.where("NOT train").select("toxic", "text")
                .mapInArrow(lambda b: sample_features(b, model), "toxic int, f0 double, f1 double, f2 double").collect())
        data = np.array(sorted(tuple(r) for r in rows), float).reshape(-1, 4)
        model.weights = calibrate(data[:, 1:], data[:, 0])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every whole text of ``docs`` (``doc_id, text``): ``doc_id, held_out, score, predicted``; map-only.

    Learns only from labels whose ``crc32(doc_id) mod 5 <> 0``; a document labelled several times counts as toxic
    if any label says so; labels other than 0 and 1 are ignored. NULL texts score as empty ones. A NULL ``doc_id``
    is scored with ``held_out`` NULL. Without toxic training rows every score is 0.
    """
    model = fit(docs, labels)
    return docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text").mapInArrow(
        lambda batches: scored(batches, model), SCHEMA)


def ordinary_rows(batches: Iterator, model: Model) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        keep = [model.score(text.as_py()) < 0.5 for text in batch.column(batch.schema.get_field_index("text"))]
        yield batch.filter(pa.array(keep, pa.bool_()))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below 0.5; the model is that of ``score_toxicity``."""
    model = fit(docs, labels)
    return docs.mapInArrow(lambda batches: ordinary_rows(batches, model), docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
