"""Sequence packing by non-negative least squares over shallow length combinations.

A document of n tokens (its ids and one closing id) gives ``n // window`` full sequences and one remainder. In a
block of documents the remainders are counted by length class (``quantum`` tokens each). All multisets of at most
three classes whose upper edges add up to the window are the possible fillings; how often to use each is the
solution of ``min |A x - h|, x >= 0`` against the histogram ``h``, rounded to what the classes still hold. The
remainders left over are packed greedily: they are cut to fill the gaps that the class edges leave, then laid end
to end into further sequences. What is left at the end (less than a window) is cut into power-of-two sequences,
which need no padding. So a block has no padding at all.

Blocks are formed inside a task from consecutive rows, bounded by rows and tokens: the operator needs no shuffle,
its memory does not grow with the input, and a lost task is recomputed alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from starmart.llm.common import table
from starmart.llm.tokens import tokenizer, vocabulary_path

WINDOW = 2048
QUANTUM = 32
END_ID = 1
BLOCK_DOCS = 8192
BLOCK_TOKENS = 1 << 22

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


@lru_cache
def combinations(units: int, depth: int = 3) -> tuple[tuple[int, ...], ...]:
    """Multisets of at most ``depth`` classes 1..units adding up to ``units``, as ascending tuples."""
    found: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], low: int, rest: int) -> None:
        if rest >= low:
            found.append((*head, rest))
        if len(head) + 2 <= depth:
            for x in range(low, rest // 2 + 1):
                grow((*head, x), x, rest - x)

    grow((), 1, units)
    return tuple(found)


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """``argmin |a x - b|`` over ``x >= 0`` (active-set method of Lawson and Hanson)."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gradient = a.T @ b
    for _ in range(3 * n):
        if passive.all() or gradient[~passive].max() <= tolerance * max(1.0, np.abs(b).max()):
            break
        passive[np.argmax(np.where(passive, -np.inf, gradient))] = True
        while True:
            trial = np.zeros(n)
            trial[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            low = passive & (trial <= tolerance)
            if not low.any():
                x = trial
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + step * (trial - x)
            passive &= x > tolerance
            x[~passive] = 0
            if not passive.any():
                break
        gradient = a.T @ (b - a @ x)
    return x


def plan_repeats(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Combinations with their rounded repeat counts, most repeated first, never using more than there is."""
    units = len(histogram)
    combos = combinations(units)
    a = np.zeros((units, len(combos)))
    for j, combo in enumerate(combos):
        for c in combo:
            a[c - 1, j] += 1
    repeats = nnls(a, histogram.astype(float))
    left, plan = histogram.copy(), []
    for j in np.argsort(-repeats, kind="stable"):
        if repeats[j] <= 0.5:
            break
        use = a[:, j].astype(int)
        most = int(min(left[c - 1] // use[c - 1] for c in combos[j]))
        count = min(int(round(repeats[j])), most)
        if count:
            left -= count * use
            plan.append((combos[j], count))
    return plan


def pack(lengths: list[int], window: int = WINDOW, quantum: int = QUANTUM) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents with the given token counts.

    Every token is in exactly one piece, every sequence holds ``window`` tokens or a power of two. ``window`` must
    be a power of two and a multiple of ``quantum``.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    units = window // quantum
    classes: list[list[tuple[int, int, int]]] = [[] for _ in range(units)]
    for doc, n in enumerate(lengths):
        for start in range(0, n - window + 1, window):
            pieces.append((doc, start, window, sequence, 0))
            sequence += 1
        if rest := n % window:
            classes[-(-rest // quantum) - 1].append((doc, n - rest, rest))
    filled: list[list[tuple[int, int, int]]] = []
    histogram = np.array([len(c) for c in classes])
    if histogram.any():
        for combo, count in plan_repeats(histogram):
            filled.extend([classes[c - 1].pop() for c in combo] for _ in range(count))
    residual = [piece for c in classes for piece in c]  # taken from the end: the longest first
    need = sum(window - sum(p[2] for p in s) for s in filled)
    have = sum(p[2] for p in residual)
    while filled and have < need:  # too little to fill the gaps: the last sequence becomes filling
        undone = filled.pop()
        tokens = sum(p[2] for p in undone)
        need, have = need - (window - tokens), have + tokens
        residual.extend(undone)

    def take(room: int) -> tuple[int, int, int]:
        doc, start, n = residual.pop()
        if n > room:
            residual.append((doc, start + room, n - room))
            n = room
        return doc, start, n

    for parts in filled:
        offset = 0
        for doc, start, n in parts:
            pieces.append((doc, start, n, sequence, offset))
            offset += n
        while offset < window:
            doc, start, n = take(window - offset)
            pieces.append((doc, start, n, sequence, offset))
            offset += n
        sequence += 1
    left = sum(p[2] for p in residual)
    while left:
        size, offset = min(window, 1 << (left.bit_length() - 1)), 0
        while offset < size:
            doc, start, n = take(size - offset)
            pieces.append((doc, start, n, sequence, offset))
            offset += n
        left -= size
        sequence += 1
    return pieces


def packed_blocks(batches: Iterator, path: str, end_id: int, window: int) -> Iterator:
    import pyarrow as pa
    from pyspark import TaskContext

    encode, end = tokenizer(path).encode, np.array([end_id], "<u4").tobytes()
    partition = TaskContext.get().partitionId()
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    sequences = 0
    ids: list = []
    streams: list[bytes] = []

    def block() -> pa.RecordBatch:
        nonlocal sequences
        doc, start, length, sequence, offset = np.array(pack([len(s) // 4 for s in streams], window), np.int64).T
        crc = [zlib.crc32(streams[d][4 * a:4 * (a + n)])
               for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist())]
        columns = [[ids[d] for d in doc.tolist()], start, length, crc, [len(streams[d]) // 4 for d in doc.tolist()],
                   sequence + ((partition << 33) + sequences), offset]
        sequences += int(sequence.max()) + 1
        ids.clear()
        streams.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    tokens = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            streams.append(encode(text.as_py() or "") + end)
            ids.append(doc_id)
            tokens += len(streams[-1]) // 4
            if len(streams) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                yield block()
                tokens = 0
    if streams:
        yield block()


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID,
                   window: int = WINDOW) -> DataFrame:
    """Pack the whole texts of ``docs`` (``doc_id``, ``text``) into sequences of at most ``window`` tokens.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A NULL or empty text
    is the closing id alone; a repeated row is packed again; a NULL ``doc_id`` stays NULL; extra columns are
    ignored; an empty table gives no rows. ``sequence_id`` is unique (task number and running number). A block is
    bounded by ``BLOCK_DOCS`` documents or ``BLOCK_TOKENS`` tokens plus one document.
    """
    path = vocabulary or vocabulary_path()
    return docs.select("doc_id", "text").mapInArrow(lambda it: packed_blocks(it, path, end_id, window), SCHEMA)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
