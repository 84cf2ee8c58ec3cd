"""Periodic runs of words, found by an online sparse dynamic programme over diagonals.

Words are read from left to right.  A word's *earlier occurrences* give the lags at which it repeats itself: each
increments the match length of its lag's diagonal, a diagonal that gets no increment has ended, and one that has matched
for long enough is emitted as a run at once.  A run of period ``q`` is at least ``max(24, 3q)`` words long, so its
diagonal matches ``max(24 - q, 2q)`` words in a row, which is never under 16.  A word therefore only counts as an earlier
occurrence where the 15 words before it are the same too: in prose hardly any word has one, and the programme stays
sparse.  Such occurrences are told by a 64-bit hash of the 16 words; every run is compared word for word before it counts.

A text made of the same few words over and over has many occurrences for each word.  Where they are more than
``dense`` times its words, its diagonals are looked at from checkpoints instead: one of lag ``q`` matches ``2q`` words,
so checkpoints ``2q - 15`` words apart cannot miss it, and there are only about ``n log n`` of them.  Diagonals are then
grown from the checkpoints that match, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, whole

#: Words that a diagonal of any run matches at least, and what a run must reach.
CONTEXT, LEAST, REPEATS = 16, 24, 3
#: Odd multipliers of the rolling hash over 1, 2, 4 and 8 words.
ROLL = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]

Run = tuple[int, int, int]  # start, length, period


def _contexts(codes: np.ndarray) -> np.ndarray:
    """A hash of each word and its 15 predecessors, from word 15 on."""
    out = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    for k, factor in enumerate(ROLL):
        out = out[: -(1 << k)] * factor + out[1 << k :]
        out ^= out >> np.uint64(31)
    return out


def _emitted(codes: np.ndarray, start: int, end: int, lag: int) -> bool:
    """Whether words ``start`` to ``end`` (exclusive) are long enough for ``lag`` and do have that period."""
    return end - start >= max(LEAST, REPEATS * lag) and bool((codes[start + lag : end] == codes[start : end - lag]).all())


def _online(codes: np.ndarray, before: np.ndarray) -> list[Run]:
    """The programme itself; ``before`` is the last earlier occurrence of each context, -1 without one."""
    n, found, seen = len(codes), [], set()
    back, active = before.tolist(), {}

    def end(ended: list[int], at: int) -> None:
        for lag in sorted(ended):  # a stretch's smallest period ends first, its multiples with it
            start = active[lag] - lag
            if (start, at) not in seen and _emitted(codes, start, at, lag):
                seen.add((start, at))
                found.append((start, at - start, lag))

    last = -1
    for i in np.flatnonzero(before >= 0).tolist():
        if i != last + 1 and active:
            end(list(active), last + CONTEXT)
            active = {}
        now, j = {}, back[i]
        while j >= 0 and REPEATS * (i - j) <= n:
            now[i - j] = active.get(i - j, i)
            j = back[j]
        if ended := [lag for lag in active if lag not in now]:
            end(ended, i + CONTEXT - 1)
        active, last = now, i
    end(list(active), last + CONTEXT)
    return found


def _reach(codes: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """The words (end exclusive) around ``i`` whose diagonal matches at ``lag``."""
    high = i
    for width in _widths():
        a, b = codes[high : high + width], codes[high - lag : high - lag + width]
        b = b[: len(a)]
        if len(a) == 0 or not (a == b).all():
            high += int(np.argmin(a == b)) if len(a) else 0
            break
        high += len(a)
    low = i
    for width in _widths():
        width = min(width, low - lag)
        a, b = codes[low - width : low], codes[low - lag - width : low - lag]
        if width == 0 or not (a == b).all():
            low -= int(np.argmin((a == b)[::-1])) if width else 0
            break
        low -= width
    return low, high


def _widths() -> Iterator[int]:
    width = 32
    while True:
        yield width
        width *= 2


def _checkpoints(codes: np.ndarray, contexts: np.ndarray) -> list[Run]:
    """The same runs from checkpoints on each lag's diagonal."""
    n, m, found = len(codes), len(contexts), []
    for lag in range(1, n // REPEATS + 1):
        at = np.arange(lag, m, max(1, 2 * lag - CONTEXT + 1))
        at = at[contexts[at] == contexts[at - lag]]
        for start, length, period in found:  # in a run, a multiple of its period matches wherever it can
            if len(at) and lag % period == 0:
                at = at[(at < start + lag) | (at + CONTEXT > start + length)]
        done = 0
        for i in at.tolist():
            if i < done:
                continue
            low, high = _reach(codes, i + CONTEXT - 1, lag)
            done = high - CONTEXT + 1
            start = low - lag
            if _emitted(codes, start, high, lag) and not any(s == start and s + size == high for s, size, _ in found):
                found.append((start, high - start, lag))
    return found


def runs_of(words: list, dense: int = 64) -> list[Run]:
    """Every run of ``words``, by start, then period; words are equal or not and nothing else."""
    n = len(words)
    if n < LEAST:
        return []
    ids: dict = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    contexts = _contexts(codes)
    order = np.argsort(contexts, kind="stable")
    same = contexts[order[1:]] == contexts[order[:-1]]
    if not same.any():
        return []
    before = np.full(len(contexts), -1, dtype=np.int64)
    before[order[1:][same]] = order[:-1][same]
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], ~same, [True]])))
    pairs = int((sizes * (sizes - 1) // 2).sum())
    found = _online(codes, before) if pairs <= dense * n else _checkpoints(codes, contexts)
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, runs, text`` for every row: its runs (start, length, period) by start, and its words without repeats.

    Words stand between blanks, tabs and line ends.  ``text`` is the kept words joined by one blank.  Null, empty and
    short texts have no runs; repeated rows and null ids keep a row each; no rows give no rows; other columns are not read.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            runs, kept = [], []
            for text in block.column("text").to_pylist():
                words = text.split()
                own = runs_of(words)
                runs.append([{"start": s, "length": size, "period": q} for s, size, q in own])
                kept.append(b" ".join(without_repeats(words, own) if own else words))
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(runs, kind), pa.array(kept, pa.binary())], names=["id", "runs", "text"])

    schema = "id long, runs array<struct<start:long,length:long,period:long>>, text binary"
    out = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).cast("binary").alias("text")).mapInArrow(scan, schema)
    return out.withColumn("text", F.col("text").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, compared exactly; ties go to the smallest start, then period.

    Null without runs.  ``runs`` come in the order of ``found``, so of equal ones the first stays.
    """
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(best, r), r).otherwise(best))
