"""Runs of periodically repeated words, found with minimizers at several scales.

A run is a stretch of consecutive words with smallest period q that is at least ``LEAST_LENGTH`` words and two periods
long and cannot be extended. Texts become word numbers; the documents of a block lie in one array, separated by numbers
that occur once.

Periods below ``FIRST_SCALE`` are found by direct scans of each lag. A run with lag q has a stretch of at least
``max(LEAST_LENGTH - q, q)`` equal pairs (i, i + q), so it is enough to look at every such many-th word.

Longer periods are found by scale. At scale S, for periods from S to 2S, every window of S/2 words has minimizers: its
smallest hashes of S/4 consecutive words. The first period of a run holds a window, and so does the second, with
the same content and therefore the same minimizers one period later: two equal minimizers whose distance is a period
are a seed, and seeds are extended word by word to both sides. Word groups that lie inside a run with a period of at most a
sixteenth of S are no minimizers, so equal ones are never dense. Where a whole period consists of these, it lies in such a
short run, and the next period in a second one with the same cycle; such neighbours give their seeds directly.

All of it is exact: equal hashes only propose, words decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.arrays import let
from starmart.llm.common import table

LEAST_LENGTH = 12
FIRST_SCALE = 64  # periods below are scanned directly
BLOCK_WORDS = 200_000
WORD = "[^\\x20\\x09-\\x0D]+"
RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every entry."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over all windows of ``width`` entries."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = choose(values[:-step], values[step:])
        done += step
    return values


class Block:
    """Word numbers of some documents and the runs found so far: ``{(start, end): period}``."""

    def __init__(self, docs: list[np.ndarray], separators: int):
        """``separators``: word numbers from here on are free."""
        starts, parts, at = [], [], 1
        for i, doc in enumerate(docs):
            starts.append(at)
            parts += [np.array([separators + i], np.int64), doc]
            at += len(doc) + 1
        self.ids = np.concatenate([*parts, [separators + len(docs)]]).astype(np.int64)
        self.starts = np.array(starts, np.int64)
        self.longest = max(map(len, docs), default=0)
        self.found: dict[tuple[int, int], int] = {}

    def extended(self, at: int, lag: int) -> tuple[int, int]:
        """First and last + 1 of the pairs ``(i, i + lag)`` around ``at`` that are equal without a gap."""
        ids, size, step, end = self.ids, len(self.ids), 16, at + 1
        while True:
            stop = min(end + step, size - lag)
            differ = np.flatnonzero(ids[end:stop] != ids[end + lag:stop + lag])
            if len(differ):
                end += int(differ[0])
                break
            if stop == size - lag:  # not reached: the last entry equals no other
                end = stop
                break
            end, step = stop, 2 * step
        step, begin = 16, at
        while begin > 0:
            low = max(0, begin - step)
            differ = np.flatnonzero(ids[low:begin] != ids[low + lag:begin + lag])
            if len(differ):
                begin = low + int(differ[-1]) + 1
                break
            begin, step = low, 2 * step
        return begin, end

    def keep(self, seeds: np.ndarray, lag: int) -> None:
        """Extend the seeds (ascending places ``i`` with equal words at ``i`` and ``i + lag``); keep the runs."""
        beyond, least = -1, max(LEAST_LENGTH - lag, lag)
        for at in seeds.tolist():
            if at < beyond:
                continue
            begin, end = self.extended(at, lag)
            beyond = end
            if end - begin >= least:
                self.found.setdefault((begin, end + lag), lag)  # with the same ends only a multiple of the period

    def scan(self, lag: int) -> None:
        """All runs of a period by looking at every so many-th word."""
        ids = self.ids
        stride = max(LEAST_LENGTH - lag, lag)
        here = np.arange(0, len(ids) - lag, stride)
        here = here[ids[here] == ids[here + lag]]
        for _ in range(2):  # a stretch of three around the place, then of five
            if not len(here):
                return
            equal = [ids[np.clip(here + d, 0, len(ids) - 1)] == ids[np.clip(here + d + lag, 0, len(ids) - 1)]
                     for d in (-2, -1, 1, 2)]
            here = here[(equal[0] & equal[1]) | (equal[1] & equal[2]) | (equal[2] & equal[3])]
        self.keep(here, lag)

    def covered(self, width: int, longest_period: int) -> np.ndarray:
        """Whether the ``width`` words from a place on lie in a run with a period of at most ``longest_period``."""
        marks = np.zeros(len(self.ids) + 1, np.int32)
        for (begin, end), lag in self.found.items():
            if lag <= longest_period and end - begin >= width:
                marks[begin] += 1
                marks[end - width + 1] -= 1
        return np.cumsum(marks[:len(self.ids) - width + 1]) > 0

    def scale(self, least: int, sums: np.ndarray, inverse: np.ndarray) -> None:
        """All runs with periods from ``least`` to ``2 * least - 1``."""
        group = least // 4
        if len(self.ids) < 2 * least:
            return
        hashes = mixed((sums[group:] - sums[:-group]) * inverse[:len(sums) - group])
        none = np.uint64(2 ** 64 - 1)
        hashes[self.covered(group, group // 4)] = none
        width = least // 2 - group + 1
        lowest = sliding(hashes, width, np.minimum)
        edge = np.zeros(width - 1, np.uint64)
        chosen = sliding(np.concatenate((edge, lowest, edge)), width, np.maximum) == hashes
        places = np.flatnonzero(chosen & (hashes != none))
        order = np.argsort(hashes[places], kind="stable")
        places = places[order]
        values = hashes[places]
        seeds, lags = [], []
        for step in range(1, len(places)):
            same = values[:-step] == values[step:]
            if not same.any():
                break
            lag = places[step:] - places[:-step]
            fits = same & (lag >= least) & (lag < 2 * least)
            seeds.append(places[:-step][fits])
            lags.append(lag[fits])
            if not (same & (lag < 2 * least)).any():
                break
        for a, b, lag in self.neighbours(least, group // 4):
            seeds.append(np.array([max(a, b - lag)]))
            lags.append(np.array([lag]))
        if not seeds:
            return
        seeds, lags = np.concatenate(seeds), np.concatenate(lags)
        # a stretch as long as the period around a seed reaches half a period to one side
        def reaches(sign: int) -> np.ndarray:
            good = np.ones(len(seeds), bool)
            for part in (1, 2, 3, 4):
                at = seeds + sign * (lags * part // 10)
                inside = (at >= 0) & (at + lags < len(self.ids))
                at = np.where(inside, at, 0)
                good &= inside & (self.ids[at] == self.ids[np.minimum(at + lags, len(self.ids) - 1)])
            return good

        good = reaches(1) | reaches(-1)
        seeds, lags = seeds[good], lags[good]
        order = np.lexsort((seeds, lags))
        seeds, lags = seeds[order], lags[order]
        cuts = np.flatnonzero(np.diff(lags, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(lags)]):
            self.keep(seeds[a:b], int(lags[a]))

    def neighbours(self, least: int, longest_period: int) -> Iterator[tuple[int, int, int]]:
        """Seeds of runs whose periods each lie in a short run: ``(start of the first, of the second, lag)``."""
        by_period: dict[int, list[tuple[int, int]]] = {}
        for (begin, end), lag in self.found.items():
            if lag <= longest_period and end - begin >= least:
                by_period.setdefault(lag, []).append((begin, end))
        for period, spans in by_period.items():
            for (a, a_end), (b, b_end) in pairwise(sorted(spans)):
                if b > a_end:
                    continue
                cycle, two = self.ids[b:b + period].tobytes(), self.ids[a:a + 2 * period].tobytes()
                at = two.find(cycle)
                while at >= 0 and at % 8:
                    at = two.find(cycle, at + 1)
                if at < 0:
                    continue
                first = (b - a - at // 8) % period
                low = least + (first - least) % period
                for lag in range(low, min(2 * least, a_end - a + 1, b_end - b + 1), period):
                    yield a, b, lag

    def runs(self) -> list[list[tuple[int, int, int]]]:
        """Per document the runs ``(start, length, period)`` by start and period."""
        for lag in range(1, min(FIRST_SCALE, self.longest // 2 + 1)):
            self.scan(lag)
        if self.longest >= 2 * FIRST_SCALE:
            base = np.uint64(0x9E3779B97F4A7C15)
            back = np.uint64(pow(int(base), -1, 1 << 64))
            ones = np.full(len(self.ids), base)
            ones[0] = 1
            powers = np.cumprod(ones)
            ones[1:] = back
            inverse = np.cumprod(ones)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(self.ids.astype(np.uint64)) * powers)))
            least = FIRST_SCALE
            while 2 * least <= self.longest:
                self.scale(least, sums, inverse)
                least *= 2
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.starts]
        for (begin, end), lag in sorted(self.found.items(), key=lambda r: (r[0][0], r[1])):
            doc = int(np.searchsorted(self.starts, begin, "right")) - 1
            out[doc].append((begin - int(self.starts[doc]), end - begin, lag))
        return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but for those that some run contains after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    return b" ".join([w for w, n in zip(words, np.cumsum(marks).tolist()) if not n])


def runs_of(texts: list[bytes]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each UTF-8 text."""
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in texts]  # bytes: ASCII white space only
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in split]
    found = Block(docs, len(numbers)).runs()
    return [(runs, collapsed(words, runs)) for words, runs in zip(split, found)]


def with_runs(batches: Iterator) -> Iterator:
    """Replaces the last column, the text, with its runs and the collapsed text."""
    import pyarrow as pa

    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def block(rows, texts: list[bytes]):
        found = runs_of(texts)
        runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r, _ in found]
        return pa.RecordBatch.from_arrays(
            [*rows.columns[:-1], pa.array(runs, kind), pa.array([t for _, t in found], pa.binary()).cast(pa.string())],
            names=[*rows.schema.names[:-1], "runs", "collapsed"])

    for batch in batches:
        texts, size, first = [], 0, 0
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            texts.append((text.as_py() or "").encode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= 6 * BLOCK_WORDS:
                yield block(batch.slice(first, i + 1 - first), texts)
                texts, size, first = [], 0, i + 1
        if texts:
            yield block(batch.slice(first), texts)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row of ``docs`` (``doc_id``, ``text``).

    ``runs`` is an array of ``start, length, period`` by start and period; ``collapsed`` is the text without the words that
    some run contains after its first period, single spaces between words. NULL and empty texts have no runs and an
    empty ``collapsed``. NULL ids and repeated rows stay, a row each; extra columns are ignored; an empty table gives no
    rows. Texts are looked at whole; a text longer than a block is a block of its own.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(with_runs, "doc_id long, " + RUNS)


def with_planted_repeats(doc_id: Column, text: Column) -> Column:
    """The contract's text: of a tenth of the ids, the words from a place on repeat with a period of their own."""
    number = F.crc32(doc_id.cast("string").cast("binary"))

    def rebuilt(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(number / 10).cast("long")
        return let(F.struct((g % n).alias("a"), F.floor((n - g % n) / (3 + g % 8)).cast("long").alias("p")), lambda s: F.concat_ws(
            " ", F.transform(words, lambda w, i: F.when(i < s["a"], w).otherwise(
                F.get(words, (s["a"] + (i - s["a"]) % (s["p"] + 1)).cast("int"))))))

    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    changed = let(words, lambda w: F.when(F.size(w) > 0, rebuilt(w)).otherwise(F.lit("")))
    return F.when(number % 10 == 0, changed).otherwise(text)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    runs = periodic_runs(docs.select("doc_id", with_planted_repeats(F.col("doc_id"), F.col("text")).alias("text")))
    # the longest run; ties to the smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                              (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
