"""Language identification by compression with one raw-content dictionary per language.

Training: the different words of a bounded sample of whole labelled documents per language (``SAMPLE_ROWS``) fill a
dictionary of at most ``DICTIONARY_BYTES``, those of most documents first. Prediction: the different words
of the whole text, reduced to letters, are compressed in windows with every dictionary, and the language with the
fewest bytes wins.
The margin is the share of bytes by which the runner-up is longer. Predictions with a margin below the threshold
are rejected (column ``accepted``); the threshold is the largest one that still keeps ``KEEP_SHARE`` of the right
predictions on further labelled training rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import fold, table, written
from starmart.llm.compression import compressor, letters_only, windows

SAMPLE_ROWS = 300  # documents per language in a dictionary; as many again set the threshold
LANGUAGES = 500  # at most so many, those with the most labelled documents
DICTIONARY_BYTES = 64_000
WINDOW = 1024
LEVEL = 9
KEEP_SHARE = 0.99
UNKNOWN = "und"
#: Ends every dictionary and begins every window: its match makes even a short window worth compressing, so that
#: words known to a dictionary shorten it.
FRAME = b"".join(hashlib.sha256(bytes([i])).digest() for i in range(2))
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, margin double, accepted boolean"
_COMPRESSORS: dict[int, list] = {}


def training_rows(docs: DataFrame) -> DataFrame:
    """A bounded, hash-chosen sample of labelled rows: ``lang, text`` and ``part`` 0 or 1.

    Per language about ``2 * SAMPLE_ROWS`` rows: the counts per language give a hash threshold for each, so the
    rows are filtered where they are read and nothing is ranked or gathered. Repeated rows count once.
    """
    labelled = (docs.where(fold("doc_id", 5) != 0).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
                .select("doc_id", "lang", "text"))
    spread = 1 << 30
    counts = (labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect())
    limits = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, 2 * SAMPLE_ROWS / r["n"]) * spread)) for r in counts], "lang string, below long")
    key = F.xxhash64("doc_id", "text")
    chosen = labelled.join(F.broadcast(limits), "lang").where(F.pmod(key, F.lit(spread)) < F.col("below"))
    return chosen.select("lang", "text",
                         F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(2)).cast("int").alias("part")).distinct()


class Model:
    """Dictionaries by language (sorted by name) and the margin below which a prediction is rejected."""

    def __init__(self, languages: list[str], contents: list[bytes], threshold: float = 0.0):
        self.languages, self.contents, self.threshold = languages, contents, threshold

    def compressors(self) -> list:
        key = hash((tuple(self.languages), tuple(self.contents)))
        if key not in _COMPRESSORS:
            _COMPRESSORS.clear()
            _COMPRESSORS[key] = [compressor(c + FRAME, LEVEL) for c in self.contents]
        return _COMPRESSORS[key]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score in [0, 1] and margin. ``und`` without a letter or without any learned language."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        sizes = np.zeros(len(self.contents))
        compressors = self.compressors()
        # each word once: a repeated line compresses by itself and says no more than its first copy
        words = b" ".join(dict.fromkeys(letters_only(text).split()))
        for window in windows(words, WINDOW):
            sizes += [len(c.compress(FRAME + window)) for c in compressors]
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.languages[0], 1.0, 1.0
        second = float(np.min(np.delete(sizes, best)))
        margin = (second - sizes[best]) / max(1.0, sizes[best])
        return self.languages[best], 1.0 / (1.0 + math.exp(-40.0 * margin)), float(margin)


def words_of(text: str) -> set[bytes]:
    return set(letters_only(text).split())


def content(words: Iterable[bytes]) -> bytes:
    """A dictionary of words given by rank; the first ones stand last, where zstandard finds them cheapest."""
    return b" ".join(reversed(list(words)))


def rejected_below(margins: list[float]) -> float:
    return float(np.quantile(margins, 1.0 - KEEP_SHARE)) if margins else 0.0


def train(rows: list[tuple[str, str, int]]) -> Model:
    """A model from a few ``(lang, text, part)``: part 0 fills the dictionaries, part 1 sets the threshold."""
    languages = sorted({lang for lang, _, _ in rows})
    contents = []
    for lang in languages:
        least = min(part for g, _, part in rows if g == lang)
        counts = Counter(w for t in {t for g, t, part in rows if g == lang and part == least} for w in words_of(t))
        ranked, size = [], 0
        for word in sorted(counts, key=lambda w: (-counts[w], xxhash.xxh64_intdigest(w), w)):
            size += len(word) + 1
            if size > DICTIONARY_BYTES:
                break
            ranked.append(word)
        contents.append(content(ranked))
    model = Model(languages, contents)
    model.threshold = rejected_below([m for lang, t, part in rows if part == 1 for p, _, m in [model.predict(t)] if p == lang])
    return model


def counted_words(batches: Iterator) -> Iterator:
    """``lang, text`` to ``lang, word, docs``: in how many texts of the batch a word stands."""
    import pyarrow as pa

    for batch in batches:
        counts = Counter((lang, word) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                         for word in words_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.binary()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "docs"])


def right_margins(batches: Iterator, model: Model) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [(model.predict(text), lang) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([p[2] for p, lang in found if p[0] == lang], pa.float64())], names=["margin"])


def fit(docs: DataFrame) -> Model:
    """The model of ``train`` from the sample of a table; texts are read in tasks, only dictionaries and margins come back."""
    rows = written(docs.sparkSession, training_rows(docs), "language-sample")
    least = rows.groupBy("lang").agg(F.min("part").alias("part"))
    counts = (rows.join(F.broadcast(least), ["lang", "part"]).select("lang", "text")
              .mapInArrow(counted_words, "lang string, word binary, docs long")
              .groupBy("lang", "word").agg(F.sum("docs").alias("docs")))
    by_rank = Window.partitionBy("lang").orderBy(F.desc("docs"), F.xxhash64("word"), "word")
    ranked = (counts.withColumn("rank", F.row_number().over(by_rank)).withColumn(
        "bytes", F.sum(F.length("word") + 1).over(by_rank.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("bytes") <= DICTIONARY_BYTES))
    words = ranked.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("words")).collect()
    found = {r["lang"]: content(bytes(w["word"]) for w in r["words"]) for r in words}
    languages = sorted(r["lang"] for r in least.collect())
    model = Model(languages, [found.get(lang, b"") for lang in languages])
    margins = rows.where("part = 1").select("lang", "text").mapInArrow(lambda b: right_margins(b, model), "margin double")
    model.threshold = rejected_below([r["margin"] for r in margins.collect()])
    return model


def predicted(batches: Iterator, model: Model) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [model.predict(text.as_py()) for text in batch.column(2)]
        langs, scores, margins = zip(*found) if found else ((), (), ())
        accepted = [p != UNKNOWN and m >= model.threshold for p, _, m in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(langs, pa.string()),
             pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), pa.array(accepted, pa.bool_())],
            names=["doc_id", "held_out", "lang_pred", "score", "margin", "accepted"])


def identify_language(docs: DataFrame) -> DataFrame:
    """Predict the language of every whole text of ``docs`` (``doc_id, text, lang``); a map-only job.

    Learns from rows with a non-NULL ``lang`` and ``crc32(doc_id) mod 5 <> 0``. Texts that are NULL or have no
    letter get ``und`` and score 0. A row with a NULL ``doc_id`` is predicted with ``held_out`` NULL and never
    learned from. Of languages with equal sizes the first by name wins. Without learned languages all is ``und``.
    Repeated rows are each predicted; extra columns are ignored; an empty table gives no rows. Of more than ``LANGUAGES``
    values of ``lang`` those with the most labelled rows are learned.
    """
    model = fit(docs)
    return docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text").mapInArrow(
        lambda batches: predicted(batches, model), SCHEMA)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(table(spark, sf_dir, "documents"))
