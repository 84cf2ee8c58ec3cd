"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language accepts just the substrings of that text.  Another text is parsed against
it into phrases, each the longest that the automaton still accepts; a text needs few phrases in its own language.  The
count, times the cost of pointing into the labelled text, per symbol, estimates the cross entropy; the least wins.

Texts are reduced to the UTF-8 bytes of their letters in lower case, of whatever script, with one blank for anything between,
and parsed in blocks of ``BLOCK`` symbols
whatever their length, so that all blocks of many texts walk an automaton together; a block's end ends a phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, id_residue, whole
from ledgerloom.session import materialise

BLOCK = 2_048
UNKNOWN = "und"
NEW_PHRASE = 1 << 30
GAP = 0x20


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample: texts ranked and symbols read per language, and bytes of all tables together.

    With many languages the tables' bound leaves fewer symbols to each; no language and no letter is left out.
    """

    texts: int = 400
    symbols: int = 30_000
    table_bytes: int = 256 << 20


@dataclass(frozen=True)
class Model:
    """Languages in order, and for each the number of every symbol, a complete transition table, and the bits of a pointer."""

    languages: tuple[str, ...]
    numbers: tuple[np.ndarray, ...]  # symbol (a byte) to its number in the language, 0 for one it never has
    tables: tuple[np.ndarray, ...]
    costs: tuple[float, ...]  # bits to point into the labelled text


def _letters() -> np.ndarray:
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.zeros(0x110000, dtype=bool)
    out[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")] = np.fromiter(map(str.isalpha, text), dtype=bool, count=len(text))
    return out


class Reader:
    """Symbols of texts: the UTF-8 bytes of their letters, of whatever script, and one blank for what stands between words."""

    def __init__(self):
        self.letter = _letters()

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' symbols one after the other, and where each begins (and the last ends); a text begins with a blank."""
        lowered = [" " + (t or "").lower() for t in texts]
        signs = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = self.letter[signs]
        starts = np.cumsum([0] + [len(t) for t in lowered])
        keep = np.ones(len(signs), dtype=bool)
        keep[1:] = letter[1:] | letter[:-1]
        keep[starts[:-1]] = True
        signs = np.where(letter, signs, GAP)[keep].astype("<u4")
        sizes = 1 + (signs >= 0x80) + (signs >= 0x800) + (signs >= 0x10000)
        places = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(keep)])]
        return np.frombuffer(signs.tobytes().decode("utf-32-le").encode(), dtype=np.uint8), places[starts]


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions of the automaton of all substrings, completed: a missing one starts the next phrase at its symbol."""
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        new = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
        last = new
    first = np.full(alphabet, len(follow), dtype=np.int32)  # a symbol that never occurs is a phrase by itself
    for c, state in follow[0].items():
        first[c] = state
    table = np.tile(first | NEW_PHRASE, (len(follow) + 1, 1)).astype(np.int32)
    for state, kids in enumerate(follow):
        for c, to in kids.items():
            table[state, c] = to
    return table


def learn(docs: DataFrame, fit: Fit = Fit(), fold: tuple[int, int] = (4, 2), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Automata of the labelled texts outside of the held-out fold.

    Per language the ``fit.texts`` texts of smallest id hash are ranked, in parts of a language first, and read until
    ``fit.symbols`` are reached; no more than that of any text comes to the driver.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.col("id").isNotNull() & (id_residue("id", fold[0]) != fold[1]))
    order = [F.xxhash64("id"), F.col("id")]
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64))).orderBy(*order)
    first = named.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= fit.texts).drop("rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    chosen = materialise(first.withColumn("rank", rank).where(F.col("rank") <= fit.texts), "labelled-texts")
    small = F.broadcast(chosen) if chosen.count() <= 100_000 else chosen
    begin = F.left(whole(text_col), F.lit(fit.symbols)).alias("text")
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), begin).join(small, ["id", "lang"])
    before = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("rank", "text").rowsBetween(Window.unboundedPreceding, -1))
    rows = texts.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < fit.symbols).orderBy("lang", "rank", "text").collect()
    reader, by_language = Reader(), {}
    for r in rows:
        by_language.setdefault(r["lang"], []).append(r["text"])
    languages = sorted(by_language)
    samples = [reader.read(by_language[language])[0][: fit.symbols] for language in languages]
    widths = [len(np.unique(sample)) + 1 for sample in samples]
    most = max(1, fit.table_bytes // (8 * sum(widths) or 1))  # an automaton has up to two states a symbol, of 4 bytes a transition
    tables, costs, numbers = [], [], []
    for sample in samples:
        own = np.zeros(256, dtype=np.uint8)
        seen = np.unique(sample)
        own[seen] = np.arange(1, len(seen) + 1)
        numbers.append(own)
        tables.append(suffix_automaton(own[sample[:most]].tolist(), len(seen) + 1))
        costs.append(math.log2(len(sample[:most]) + 2))
    return Model(tuple(languages), tuple(numbers), tuple(tables), tuple(costs))


def phrases(table: np.ndarray, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The number of phrases of each stretch of ``symbols``; stretches come longest first."""
    width = table.shape[1]
    flat = table.ravel()
    state = np.zeros(len(starts), dtype=np.int64)
    count = (lengths > 0).astype(np.int64)
    active = len(starts)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[active - 1] <= step:
            active -= 1
        to = flat[state[:active] * width + symbols[starts[:active] + step]]
        new = to >= NEW_PHRASE
        if step:
            count[:active] += new
        state[:active] = to & (NEW_PHRASE - 1)
    return count


def entropies(model: Model, reader: Reader, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bits a symbol by text and language, and whether a text has a letter at all."""
    symbols, edges = reader.read(texts)
    sizes = np.diff(edges)
    lanes = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), lanes)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    starts = edges[owner] + number * BLOCK
    lengths = np.minimum(BLOCK, edges[owner + 1] - starts)
    order = np.argsort(-lengths, kind="stable")
    out = np.zeros((len(texts), len(model.languages)))
    for k, (table, cost, number) in enumerate(zip(model.tables, model.costs, model.numbers, strict=True)):
        count = phrases(table, number[symbols], starts[order], lengths[order])
        out[:, k] = np.bincount(owner[order], weights=count, minlength=len(texts)) * cost
    letters = np.add.reduceat((symbols != GAP).astype(np.int64), edges[:-1]) if len(texts) else np.zeros(0)
    return out / np.maximum(sizes, 1)[:, None], letters > 0


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score`` for every row; the score is how far the second language is behind the first.

    A null text, one without a letter, or any text for a model without languages is ``und`` with score 0.  Ties go to the
    language that comes first.  Repeated rows and null ids keep a row each; no rows give no rows; only id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by Fit.table_bytes

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        reader = Reader()
        for block in blocks(batches, "text"):
            texts = block.column("text").to_pylist()
            if not known.languages:
                names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                bits, there = entropies(known, reader, texts)
                best = bits.argmin(axis=1)
                ranked = np.sort(bits, axis=1)
                second = ranked[:, min(1, ranked.shape[1] - 1)]
                score = np.where(there, 1 - ranked[:, 0] / np.maximum(second, 1e-9), 0.0)
                names = [known.languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), there.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(names, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(find, "id long, lang_pred string, score double")
