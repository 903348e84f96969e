"""Phrase collocations by best-first branch and bound over phrase prefixes.

A phrase of two or three words is scored by ``floor(1000000 * a * a / (l * r))`` at its worst cut, where ``a`` is how often it
occurs and ``l``, ``r`` how often its parts do. Counts of words and pairs are complete; triples are grown from their
prefix pair only where they can matter. No triple is more frequent than its prefix or its suffix pair, and so its score is
at most that of a triple with the lesser of these counts: an admissible bound, known before anything is counted.

Per language, the frontier is expanded from the best scores down. A round has a score ``low``; it takes all pairs with at
least this score, and counts all triples whose bound reaches it or which might push out one of these pairs. Then every
phrase with a score of ``low`` or more is known, and so is whether a longer one pushes it out. A language is settled when
``TOP`` survivors have at least that score (whatever ties with the last of them has it too), or ``low`` is 0. The others go on to a
lower score in the next round, which counts only what the rounds before did not.

As vocabularies grow with the corpus, counts are gathered nowhere. Documents form chunks inside tasks. A chunk lists its
different words and pairs once, as sorted hashes with counts, cut into shards; a shard adds up what all chunks say and answers
each chunk in its order. With the answers a chunk knows all counts its bounds need, and lists the phrases of the round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.common import table, written
from starmart.llm.lm import expanded, names, squeezed

TOP = 2000
LEAST_COUNT = 10
PUSHED_OUT = 50  # percent of a phrase's occurrences that lie inside one longer phrase
MILLION = 1_000_000
WANTED = (2 * TOP, 16 * TOP)  # pairs above the score of the first rounds; the last round has score 0
LEVELS = 64  # per factor of two, of the scores that are counted to choose a round's score
CHUNK_TOKENS = 1_000_000
LEAST_SHARDS = 64
SHARD_TOKENS = 2_000_000
SALTED_ROWS = 100_000
UNKNOWN = "und"
#: Piece ends become a line feed, tabs a space.
CLEANED = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n\n ")
CHUNKS = "chunk long, tokens long, langs array<string>, counts array<long>, stream binary, hashes binary, owners binary, words binary"
REQUESTS = "shard int, chunk long, n int, hashes binary, counts binary"
ANSWERS = "chunk long, shard int, n int, totals binary, owned binary"
CELLS = "lang string, level int, pairs long"
FOUND = ("lang string, phrase string, head string, tail string, a long, f1 long, f23 long, f12 long, f3 long")


def chunked(batches: Iterator) -> Iterator:
    """``lang, text`` to ``CHUNKS``: texts as word numbers, 0 where a piece ends."""
    import pyarrow as pa
    from pyspark import TaskContext

    partition, made, size = TaskContext.get().partitionId(), 0, 0
    index: dict[str, dict[bytes, int]] = {}
    streams: list[np.ndarray] = []
    counts: dict[str, int] = {}
    free = 1

    def chunk() -> pa.RecordBatch:
        langs = list(index)
        words, hashes, owners = [b""] * free, np.zeros(free, np.uint64), np.zeros(free, np.uint32)
        for at, lang in enumerate(langs):
            for word, number in index[lang].items():
                if number:
                    words[number], owners[number] = word, at
                    hashes[number] = xxhash.xxh64_intdigest(lang.encode() + b"\n" + word)
        values = [[(partition << 32) + made], [size], [langs], [[counts[x] for x in langs]],
                  [squeezed(np.concatenate(streams).astype(np.uint32))], [squeezed(hashes)], [squeezed(owners)],
                  [zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names(CHUNKS))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = index.setdefault(lang, {b"\n": 0})
            counts.setdefault(lang, 0)
            data = (text.as_py() or "").encode("utf-8", "replace").lower().translate(CLEANED).replace(b"\n", b" \n ")
            numbers = []
            for word in data.split(b" "):
                if word:
                    number = words.get(word)
                    if number is None:
                        number = words[word] = free
                        free += 1
                    numbers.append(number)
            stream = np.array([*numbers, 0], np.int64)
            streams.append(stream)
            counts[lang] += int(np.count_nonzero(stream))
            size += len(stream)
            if size >= CHUNK_TOKENS:
                yield chunk()
                made, size, free = made + 1, 0, 1
                index, streams, counts = {}, [], {}
    if streams:
        yield chunk()


class Grams:
    """Words and pairs of a chunk row, and their keys in order."""

    def __init__(self, row: dict):
        size = zstandard.frame_content_size(row["stream"]) // 4
        self.now = expanded(row["stream"], "<u4", size).astype(np.int64)
        self.words = zstandard.frame_content_size(row["hashes"]) // 8
        hashes = expanded(row["hashes"], "<u8", self.words)
        both = np.flatnonzero((self.now[:-1] != 0) & (self.now[1:] != 0))
        self.codes, place, self.pair_counts = np.unique(self.now[both] * self.words + self.now[both + 1],
                                                        return_inverse=True, return_counts=True)
        self.pair_at = np.full(size, -1, np.int64)
        self.pair_at[both] = place
        a, b = hashes[self.codes // self.words], hashes[self.codes % self.words]
        with np.errstate(over="ignore"):
            mixed = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xD6E8FEB86659FD93)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
        # the last bit tells words from pairs; number 0 is no word
        self.keys = np.concatenate((hashes[1:] | np.uint64(1), mixed & ~np.uint64(1)))
        self.order = np.argsort(self.keys, kind="stable")

    def cuts(self, shards: int) -> np.ndarray:
        """Where the shards (a power of two of them) begin and end in the ordered keys."""
        shift = np.uint64(64 - (shards.bit_length() - 1))
        return np.searchsorted((self.keys[self.order] >> shift).astype(np.int64), np.arange(shards + 1))

    def answered(self, rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Totals of words (0 for number 0) and of pairs, and which pairs this chunk owns."""
        rows = sorted(rows, key=lambda r: r["shard"])
        totals, owned = np.zeros(len(self.keys), np.int64), np.zeros(len(self.keys), bool)
        if rows:
            totals[self.order] = np.concatenate([expanded(r["totals"], "<i8", r["n"]) for r in rows])
            owned[self.order] = np.concatenate([np.unpackbits(np.frombuffer(r["owned"], np.uint8))[:r["n"]] for r in rows])
        words = self.words - 1
        return np.concatenate(([0], totals[:words])), totals[words:], owned[words:].astype(bool)


def requests(batches: Iterator, shards: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            grams = Grams(row)
            counts = np.concatenate((np.bincount(grams.now, minlength=grams.words)[1:], grams.pair_counts))[grams.order]
            keys, cuts = grams.keys[grams.order], grams.cuts(shards)
            for low in range(0, shards, 64):
                rows = [(s, a, b) for s, a, b in zip(range(low, shards), cuts[low:low + 64].tolist(),
                                                     cuts[low + 1:low + 65].tolist()) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _, _ in rows], pa.int32()), pa.array([row["chunk"]] * len(rows), pa.int64()),
                     pa.array([b - a for _, a, b in rows], pa.int32()),
                     pa.array([squeezed(np.diff(keys[a:b], prepend=np.uint64(0))) for _, a, b in rows], pa.binary()),
                     pa.array([squeezed(counts[a:b]) for _, a, b in rows], pa.binary())], names=names(REQUESTS))


def answers(asked):
    """All requests of a shard: the totals for every chunk in its order. The first chunk with a key owns it."""
    import pyarrow as pa

    rows = sorted(asked.to_pylist(), key=lambda r: r["chunk"])
    hashes = [np.cumsum(expanded(r["hashes"], "<u8", r["n"]), dtype=np.uint64) for r in rows]
    counts = np.concatenate([expanded(r["counts"], "<i8", r["n"]) for r in rows])
    keys, first, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, counts)
    owned = np.zeros(len(counts), bool)
    owned[first] = True
    ends = np.cumsum([r["n"] for r in rows])[:-1]
    values = [[r["chunk"] for r in rows], [r["shard"] for r in rows], [r["n"] for r in rows],
              [squeezed(total[p]) for p in np.split(place, ends)], [np.packbits(o).tobytes() for o in np.split(owned, ends)]]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names(ANSWERS))


def score(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The score at a cut, not rounded down; only used to compare with limits that leave room for its rounding."""
    return MILLION * a.astype(float) * a / (left.astype(float) * right)


def pair_levels(chunks, answered):
    """How many pairs have which score, by language; a pair is counted by the chunk that owns it."""
    import pyarrow as pa

    out = []
    for row in chunks.to_pylist():
        grams = Grams(row)
        words, pairs, owned = grams.answered(answered.to_pylist())
        first, second = grams.codes // grams.words, grams.codes % grams.words
        fits = owned & (pairs >= LEAST_COUNT)
        level = (LEVELS * np.log2(1 + score(pairs[fits], words[first[fits]], words[second[fits]]))).astype(np.int64)
        lang = expanded(row["owners"], "<u4", grams.words).astype(np.int64)[first[fits]]
        cells, n = np.unique(np.stack([lang, level], 1), axis=0, return_counts=True)
        out += [(row["langs"][a], b, c) for (a, b), c in zip(cells.tolist(), n.tolist())]
    columns = list(zip(*out)) or [(), (), ()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int32(), pa.int64()])], names=names(CELLS))


def frontier(chunks, answered):
    """The phrases of a round in a chunk: pairs that it owns with their totals, triples with its own counts.

    A row's ``limits`` are the languages that take part, with the scores from ``low`` up to below ``high``.
    """
    import pyarrow as pa

    out = []
    for row in chunks.to_pylist():
        if not row["limits"]:
            continue
        grams = Grams(row)
        words, pairs, owned = grams.answered(answered.to_pylist())
        low, high = np.full(len(row["langs"]), np.inf), np.full(len(row["langs"]), np.inf)
        for limit in row["limits"]:
            at = row["langs"].index(limit["lang"])
            low[at] = limit["low"] * (1 - 1e-9)  # more than the rounding of score()
            high[at] = np.inf if limit["high"] is None else limit["high"] * (1 - 1e-9)
        lang = expanded(row["owners"], "<u4", grams.words).astype(np.int64)
        text = zstandard.ZstdDecompressor().decompress(row["words"]).decode().split("\n")
        first, second = grams.codes // grams.words, grams.codes % grams.words
        pair_score = np.where(pairs >= LEAST_COUNT, score(pairs, np.maximum(words[first], 1), np.maximum(words[second], 1)), -1.0)
        of_pair = lang[first]

        for p in np.flatnonzero(owned & (pairs >= LEAST_COUNT) & (pair_score >= low[of_pair]) & (pair_score < high[of_pair])).tolist():
            a, b = int(first[p]), int(second[p])
            out.append((row["langs"][of_pair[p]], f"{text[a]} {text[b]}", None, None, int(pairs[p]), int(words[a]),
                        int(words[b]), None, None))

        at = np.flatnonzero((grams.pair_at[:-1] >= 0) & (grams.pair_at[1:] >= 0))
        head, tail = grams.pair_at[at], grams.pair_at[at + 1]
        common = np.minimum(pairs[head], pairs[tail])
        often = common >= LEAST_COUNT
        at, head, tail, common = at[often], head[often], tail[often], common[often]
        if not len(at):
            continue
        bound = np.minimum(score(common, words[first[head]], pairs[tail]), score(common, pairs[head], words[second[tail]]))
        pushes = lambda p: np.where(100 * common >= PUSHED_OUT * pairs[p], pair_score[p], -1.0)
        bound = np.maximum(bound, np.maximum(pushes(head), pushes(tail)))
        of_triple = of_pair[head]
        takes = (bound >= low[of_triple]) & (bound < high[of_triple])
        at, head, tail, of_triple = at[takes], head[takes], tail[takes], of_triple[takes]
        _, place, n = np.unique(head * grams.words + second[tail], return_index=True, return_counts=True)
        for p, a in zip(place.tolist(), n.tolist()):
            h, t = int(head[p]), int(tail[p])
            one, two, three = (text[int(w)] for w in (first[h], first[t], second[t]))
            out.append((row["langs"][of_triple[p]], f"{one} {two} {three}", f"{one} {two}", f"{two} {three}", a,
                        int(words[first[h]]), int(pairs[t]), int(pairs[h]), int(words[second[t]])))
    kinds = [pa.string()] * 4 + [pa.int64()] * 5
    columns = list(zip(*out)) or [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names(FOUND))


def exact_score(a: str, left: str, right: str) -> Column:
    """The score at a cut in whole numbers; counts may have thirteen digits."""
    wide = lambda c: f"CAST({c} AS DECIMAL(13,0))"
    return F.expr(f"({wide(a)} * {wide(a)} * CAST({MILLION} AS DECIMAL(7,0))) DIV ({wide(left)} * {wide(right)})")


def scored(found: DataFrame) -> DataFrame:
    """Candidates with ``l``, ``r`` and ``score`` of their lowest cut (the first of equal ones)."""
    one, two = exact_score("a", "f1", "f23"), exact_score("a", "f12", "f3")
    both = found.where(F.col("a") >= LEAST_COUNT).withColumn("one", one).withColumn("two", two)
    first = F.col("two").isNull() | (F.col("one") <= F.col("two"))
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    return both.select("lang", "phrase", "head", "tail", "a", pick("f1", "f12").alias("l"), pick("f23", "f3").alias("r"),
                       pick("one", "two").alias("score"))


def survivors(candidates: DataFrame) -> DataFrame:
    """Candidates without those that a longer one pushes out."""
    triples = candidates.where(F.col("head").isNotNull())
    inside = (triples.select("lang", F.col("head").alias("phrase"), F.col("a").alias("inside"))
              .unionByName(triples.select("lang", F.col("tail").alias("phrase"), F.col("a").alias("inside")))
              .groupBy("lang", "phrase").agg(F.max("inside").alias("inside")))
    return (candidates.join(inside, ["lang", "phrase"], "left")
            .where(F.col("inside").isNull() | (100 * F.col("inside") < PUSHED_OUT * F.col("a")))
            .select("lang", "phrase", "a", "l", "r", "score"))


def best(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank: of salted parts first, then of what these leave."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = -(-rows.count() // SALTED_ROWS) or 1
    parts = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    part = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    whole = part.where(F.col("rank") <= top).drop("salt")
    return (whole.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top))


def limits_of(cells: DataFrame, wanted: int | None) -> DataFrame:
    """``lang, low``: the score that at least ``wanted`` pairs of a language reach, 0 if fewer are there."""
    if wanted is None:
        return cells.select("lang").distinct().select("lang", F.lit(0).cast("long").alias("low"))
    above = F.sum("pairs").over(Window.partitionBy("lang").orderBy(F.desc("level")))  # at most 1,300 levels
    level = F.max(F.when(F.col("above") >= wanted, F.col("level")))
    return cells.withColumn("above", above).groupBy("lang").agg(
        F.coalesce(F.ceil(F.pow(F.lit(2.0), level / LEVELS) - 1), F.lit(0)).cast("long").alias("low"))


def mined(docs: DataFrame, top: int = TOP, wanted: tuple[int, ...] = WANTED) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language of ``docs`` (``lang``, ``text``).

    A NULL language counts as ``und``. NULL and empty texts add nothing. Repeated rows count each; extra columns are
    ignored; equal scores are ranked by ``a``, then by the bytes of the phrase; an empty table gives no rows, nor does a
    language without a phrase of ``LEAST_COUNT`` occurrences. Words and pairs are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    chunks = written(spark, docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
                     .mapInArrow(chunked, CHUNKS), "collocation-chunks", "uncompressed")
    tokens = chunks.agg(F.sum("tokens")).first()[0] or 0
    totals = (chunks.select(F.inline(F.arrays_zip("langs", "counts"))).groupBy(F.col("langs").alias("lang"))
              .agg(F.sum("counts").alias("n")))
    shards = 1 << max(LEAST_SHARDS - 1, tokens // SHARD_TOKENS).bit_length()
    asked = chunks.select("chunk", "stream", "hashes").mapInArrow(lambda b: requests(b, shards), REQUESTS)
    answered = written(spark, asked.groupBy("shard").applyInArrow(answers, ANSWERS), "collocation-answers", "uncompressed")

    def with_answers(left: DataFrame, function, schema: str) -> DataFrame:
        return left.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(function, schema)

    cells = written(spark, with_answers(chunks.select("chunk", "langs", "stream", "hashes", "owners"), pair_levels, CELLS)
                    .groupBy("lang", "level").agg(F.sum("pairs").alias("pairs")), "collocation-levels")
    listed = chunks.select("chunk", F.explode("langs").alias("lang"))
    rounds, results, high, done = [], [], None, None
    for want in (*wanted, None):
        low = limits_of(cells, want)
        if high is None:
            limits = low.withColumn("high", F.lit(None).cast("long"))
        else:
            limits = low.join(high.withColumnRenamed("low", "high"), "lang").join(done, "lang", "left_anti")
        limits = written(spark, limits, "collocation-limits")
        if not limits.take(1):
            break
        by_chunk = (listed.join(limits, "lang").groupBy("chunk")  # as many as the chunk has languages
                    .agg(F.collect_list(F.struct("lang", "low", "high")).alias("limits")))
        left = chunks.select("chunk", "langs", "stream", "hashes", "owners", "words").join(by_chunk, "chunk")
        rounds.append(written(spark, with_answers(left, frontier, FOUND).groupBy("lang", "phrase", "head", "tail").agg(
            F.sum("a").alias("a"), *(F.max(c).alias(c) for c in ("f1", "f23", "f12", "f3"))), "collocation-found"))
        known = survivors(scored(reduce(DataFrame.unionByName, rounds).join(limits.select("lang"), "lang", "left_semi")))
        known = known.join(limits.select("lang", "low"), "lang").where(F.col("score") >= F.col("low"))
        known = written(spark, known, "collocation-known")
        settled = limits.join(known.groupBy("lang").agg(F.count(F.lit(1)).alias("known")), "lang", "left").where(
            (F.col("low") == 0) | (F.col("known") >= top)).select("lang")
        settled = written(spark, settled, "collocation-settled")
        results.append(best(known.drop("low").join(settled, "lang", "left_semi"), top))
        high, done = limits.select("lang", "low"), settled
    if not results:
        results.append(best(scored(spark.createDataFrame([], FOUND)).select("lang", "phrase", "a", "l", "r", "score"), top))
    return (reduce(DataFrame.unionByName, results).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "documents"))


#: The same from counts of all phrases.
ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\x0B\f\r]')) AS piece FROM lowered)),
grams AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3
  FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces), (VALUES (1), (2), (3)) AS sizes(k)
  WHERE i + k - 1 <= len(words)),
counts AS (
  SELECT lang, k, phrase, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, count(*) AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, 1 AS cut, x.f AS l, y.f AS r
  FROM counts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.w1 AND x.k = 1
  JOIN counts y ON y.lang = c.lang AND y.k = c.k - 1 AND y.phrase = CASE WHEN c.k = 2 THEN c.w2 ELSE c.w2 || ' ' || c.w3 END
  WHERE c.k > 1 AND c.f >= 10
  UNION ALL
  SELECT c.lang, c.phrase, c.k, c.f, 2, x.f, y.f
  FROM counts c JOIN counts x ON x.lang = c.lang AND x.k = 2 AND x.phrase = c.w1 || ' ' || c.w2
  JOIN counts y ON y.lang = c.lang AND y.k = 1 AND y.phrase = c.w3
  WHERE c.k = 3 AND c.f >= 10),
scores AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, w1 || ' ' || w2 AS phrase, f FROM counts WHERE k = 3 AND f >= 10
    UNION ALL SELECT lang, w2 || ' ' || w3, f FROM counts WHERE k = 3 AND f >= 10) GROUP BY lang, phrase),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.phrase = l.phrase AND l.k = 2
  WHERE i.f IS NULL OR 100 * i.f < 50 * l.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
