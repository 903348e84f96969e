"""Document quality by co-training of two views.

The text-content view sees the characters (frequencies of pairs of character classes), how far the text compresses and
how many of its words differ. The page-metadata view sees the source, the language, the stated length and the layout
(lines, line lengths, shares of capitals, digits and signs). Each view is a logistic classifier, first trained on a
bounded sample of labelled documents. In every round each view labels the documents of an unlabelled pool that it is
most sure of, in the proportion of the classes, and hands them to the other view, which trains on them too. At the
end each view is calibrated on labelled documents kept aside, and the calibrated log odds of both are combined by a
third logistic fit. The combined model scores every whole text in one pass.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import fold, table, written
from starmart.llm.toxicity import logistic

LABELLED_PER_CLASS = 1500  # rows per class; two thirds train, the rest calibrates
POOL_ROWS = 4000  # unlabelled rows
ROUNDS = 5
CONFIDENT_SHARE = 0.05  # of the pool, labelled by each view in a round
SURE = 0.9  # least probability of a pseudo-label
SOURCE_SLOTS, LANG_SLOTS = 16, 8
SCHEMA = ("doc_id long, held_out boolean, score double, predicted int, text_score double, metadata_score double")


def character_classes() -> np.ndarray:
    """16 classes of bytes: letters by case and kind, digits, blanks, line ends, common signs, the rest."""
    found = np.full(256, 15, np.uint8)
    for byte in range(0x21, 0x7F):
        found[byte] = 12  # signs not named below
    for group, signs in ((4, b"0123456789"), (5, b" \t"), (6, b"\n\r"), (7, b"."), (8, b","), (9, b"!?"), (10, b"#$%&*@^~"),
                         (11, b"|_=<>/\\")):
        found[list(signs)] = group
    for byte in range(0x61, 0x7B):
        vowel = byte in b"aeiou"
        found[byte], found[byte - 32] = (0, 2) if vowel else (1, 3)
    found[0x80:0xC0], found[0xC0:] = 13, 14
    return found


CLASSES = character_classes()


def features(text: str | None, source: str | None, lang: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The two views of a document. NULL texts are empty; a NULL source or language is a value of its own."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    classes = CLASSES[np.frombuffer(data, np.uint8)]
    pairs = np.bincount(classes[:-1].astype(np.int64) * 16 + classes[1:], minlength=256) if len(data) > 1 else np.zeros(256)
    words = data.lower().split()
    squeezed = len(zlib.compress(data, 1)) / (len(data) + 20.0)
    distinct = len(set(words)) / max(1, len(words))
    content = np.concatenate((np.sqrt(pairs / max(1, len(data))) * 4, [squeezed * 4, distinct * 4]))

    shares = np.bincount(classes, minlength=16) / max(1, len(data))
    lines = text.split("\n")
    longest, mean = max(map(len, lines)), len(text) / len(lines)
    slots = np.zeros(SOURCE_SLOTS + LANG_SLOTS)
    slots[zlib.crc32(repr(source).encode()) % SOURCE_SLOTS] = 0.5
    slots[SOURCE_SLOTS + zlib.crc32(repr(lang).encode()) % LANG_SLOTS] = 0.5
    layout = [math.log1p(max(0, n_chars if n_chars is not None else len(text))) / 4, math.log1p(len(lines)) / 2,
              math.log1p(mean) / 4, math.log1p(longest) / 4, len(text) / max(1, len(words)) / 8]
    return content, np.concatenate((slots, layout, 4 * np.sqrt(shares[2:])))


def predict(weights: tuple[float, ...], x: np.ndarray) -> np.ndarray:
    """Log odds of rows ``x``."""
    return np.clip(weights[0] + x @ np.array(weights[1:]), -30, 30)


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


class Model:
    def __init__(self, views: list[tuple[float, ...]], calibrations: list[tuple[float, ...]], mix: tuple[float, ...]):
        self.views, self.calibrations, self.mix = views, calibrations, mix

    def logits(self, views: list[np.ndarray]) -> np.ndarray:
        """Calibrated log odds of both views, one column each."""
        return np.column_stack([predict(c, predict(w, x)[:, None])
                                for w, c, x in zip(self.views, self.calibrations, views)])

    def scores(self, views: list[np.ndarray]) -> np.ndarray:
        """Combined score and the two calibrated scores."""
        z = self.logits(views)
        return np.column_stack([probability(predict(self.mix, z)), probability(z)])


def co_train(labelled: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> list[tuple[float, ...]]:
    """Weights of both views after ``ROUNDS`` exchanges of confident pseudo-labels."""
    x = [v.copy() for v in labelled]
    target = [y.copy(), y.copy()]
    free = np.ones(len(pool[0]), bool)
    weights = [logistic(v, t) for v, t in zip(x, target)]
    take = max(1, int(CONFIDENT_SHARE * len(free)))
    for _ in range(ROUNDS):
        chosen: list[tuple[np.ndarray, np.ndarray]] = []
        for view in (0, 1):
            p = np.where(free, probability(predict(weights[view], pool[view])), np.nan)
            share = min(max(float(np.nanmean(p >= 0.5)) if free.any() else 0.0, 0.1), 0.9)
            good = np.argsort(np.where(np.isnan(p) | (p < SURE), np.inf, -p), kind="stable")[:max(1, int(take * share))]
            bad = np.argsort(np.where(np.isnan(p) | (p > 1 - SURE), np.inf, p), kind="stable")[:max(1, int(take * (1 - share)))]
            good, bad = good[p[good] >= SURE], bad[p[bad] <= 1 - SURE]
            chosen.append((np.concatenate((good, bad)), np.concatenate((np.ones(len(good)), np.zeros(len(bad))))))
        if not any(len(rows) for rows, _ in chosen):
            break
        for view in (0, 1):
            rows, labels = chosen[1 - view]  # what the other view is sure of
            x[view] = np.concatenate((x[view], pool[view][rows]))
            target[view] = np.concatenate((target[view], labels))
            free[rows] = False
        weights = [logistic(v, t) for v, t in zip(x, target)]
    return weights


def train(train_views: list[np.ndarray], y: np.ndarray, held_views: list[np.ndarray], held_y: np.ndarray,
          pool: list[np.ndarray], good_share: float) -> Model | None:
    """A model, or None without both classes among the training rows. ``good_share`` is the share of good documents
    among all labelled ones; the calibration rows are balanced, so their odds are moved to it."""
    if len(set(y.tolist())) < 2:
        return None
    weights = co_train(train_views, y, pool)
    if len(set(held_y.tolist())) < 2:
        held_views, held_y = train_views, y
    logits = [predict(w, x)[:, None] for w, x in zip(weights, held_views)]
    calibrations = [logistic(z, held_y, 1e-3) for z in logits]
    model = Model(weights, calibrations, ())
    mix = logistic(model.logits(held_views), held_y, 1e-2)
    shift = math.log(good_share / (1 - good_share))
    model.calibrations = [(c[0] + shift, *c[1:]) for c in calibrations]
    model.mix = (mix[0] + shift * (1 - sum(mix[1:])), *mix[1:])
    return model


def featured(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        both = [features(*(c.as_py() for c in row)) for row in zip(*batch.columns[2:])]
        views = [pa.array([v[i].astype("<f8").tobytes() for v in both], pa.binary()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *views], names=["part", "quality", "content", "metadata"])


def scored(batches: Iterator, model: Model | None) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        both = [features(*(c.as_py() for c in row)) for row in zip(*batch.columns[2:])]
        if model and both:
            found = model.scores([np.stack([v[i] for v in both]) for i in (0, 1)])
        else:
            found = np.full((len(both), 3), 0.5)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(found[:, 0]),
             pa.array((found[:, 0] >= 0.5).astype(np.int32)), pa.array(found[:, 1]), pa.array(found[:, 2])],
            names=[f.split()[0] for f in SCHEMA.split(", ")])


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """Rows to learn from (``part``: 0 train, 1 calibrate, 2 pool) with both views, and the share of good labels.

    Bounded by the row parameters: ids are chosen by hash thresholds from counts, repeated rows count once.
    """
    known = (labels.where(F.col("quality").isin(0, 1)).where(fold("doc_id", 5) != 0)
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    spread = 1 << 30
    keep = F.lit(False)
    for quality, n in counts.items():
        keep = keep | ((F.col("quality") == quality)
                       & (F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < int(min(1.0, LABELLED_PER_CLASS / n) * spread)))
    chosen = known.where(keep)
    columns = ["text", "source", "lang", "n_chars"]
    place = F.pmod(F.xxhash64(F.lit("pool"), "doc_id", "text"), F.lit(spread))
    pool_limit = int(min(1.0, POOL_ROWS / max(1, docs.count())) * spread)
    rows = (docs.where(fold("doc_id", 5) != 0).select("doc_id", *columns).join(F.broadcast(chosen), "doc_id", "left")
            .where(F.col("quality").isNotNull() | (place < pool_limit)))
    part = F.when(F.col("quality").isNull(), 2).when(F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(3)) == 0, 1).otherwise(0)
    views = rows.select(part.alias("part"), "quality", *columns).distinct().mapInArrow(
        featured, "part int, quality int, content binary, metadata binary")
    total = sum(counts.values())
    return views, min(max(counts.get(1, 0) / total, 0.02), 0.98) if total else 0.5


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    views, good_share = sampled(docs, labels)
    rows = sorted((r["part"], r["quality"] if r["quality"] is not None else -1, bytes(r["content"]), bytes(r["metadata"]))
                  for r in written(docs.sparkSession, views, "quality-sample").collect())
    empty = features("", None, None, None)

    def part(k: int) -> tuple[list[np.ndarray], np.ndarray]:
        own = [r for r in rows if r[0] == k]
        return ([np.array([np.frombuffer(r[2 + i], "<f8") for r in own]).reshape(-1, len(empty[i])) for i in (0, 1)],
                np.array([r[1] for r in own], float))

    (train_views, y), (held_views, held_y), (pool, _) = part(0), part(1), part(2)
    return train(train_views, y, held_views, held_y, pool, good_share)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, text_score, metadata_score`` of every document; map-only after training.

    ``score`` is the probability of quality 1, ``predicted`` is 1 from 0.5 on. ``docs`` has ``doc_id, text, source, lang,
    n_chars``. Learns only from documents and labels with ``crc32(doc_id) mod 5 <> 0``; of several labels of a document
    the worst counts; labels other than 0 and 1 are ignored. NULL texts are empty ones. A NULL ``doc_id`` is scored
    with ``held_out`` NULL. Without both classes of labels every score is 0.5. Extra columns are ignored.
    """
    model = fit(docs, labels)
    return docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text", "source", "lang", "n_chars").mapInArrow(
        lambda batches: scored(batches, model), SCHEMA)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
