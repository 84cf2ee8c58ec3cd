"""Phrase collocations by the external layout of streaming language-model estimation.

Counts are kept as one stored *stream* for each phrase length.  A phrase's first words are a row of the next shorter
stream, and so are its last ones, hence every number a phrase needs comes from that stream by merge joins in lockstep:
in *prefix order* for its left parts, in *suffix order* for its right parts.  The joined row already holds the counts of
its own left (right) parts, so one join a stream and order gives the counts of all cuts.  Extension counts go the other
way, as the largest count among a phrase's rows in the next longer stream.  No table of phrases is hashed in memory or
sent around; Spark sorts, spills and merges.

Streams are counted shortest first.  A phrase can only reach ``least`` if its words and word pairs do, so longer ones are
only counted where these pass a *filter*: a bitmap of fixed size over their checksums.  A false pass costs a row and is
dropped by its count; on a corpus that fills the bitmap nothing is filtered and the result is still the same.  Each task
counts its own texts before the shuffle, so a phrase that stands everywhere is one row a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks, filter_of, passes, whole
from ledgerloom.session import materialise

#: Words whose pairs and longer phrases a task counts at a time.
WORDS_HELD = 1 << 20
#: Entries that a task's word table and word counts hold before they start anew.
TABLE = 400_000
#: What ends a piece, and what stands between words.
ENDS, GAP = b".,;:!?\n\x0b\x0c\r", b"\t"
#: A byte that no UTF-8 text holds, as the end of a piece.
END = b"\xff"
_PIECES = bytes.maketrans(ENDS + GAP, END * len(ENDS) + b" ")

COUNTS = "lang string, phrase string, n long"


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words (A-Z only), with ``END`` between pieces."""
    return text.lower().translate(_PIECES).replace(END, b" \xff ").split(b" ")


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Tokens of one language's texts at a time, each text closed by ``END``; empty strings stand for doubled blanks."""
    for block in blocks(batches, "text"):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(block.column("lang").to_pylist(), block.column("text").to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            yield lang, tokens(END.join([*own, b""]))


def _rows(lang: str, phrases: list[bytes], counts: list[int]) -> pa.RecordBatch:
    text = pa.array(phrases, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), text, pa.array(counts, pa.int64())], names=["lang", "phrase", "n"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, and under the empty phrase the number of all of them."""
    held: dict[str, Counter] = {}

    def flush(lang: str) -> pa.RecordBatch:
        own = held.pop(lang)
        del own[b""], own[END]
        return _rows(lang, [*own, b""], [*own.values(), own.total()])

    for lang, words in _by_language(batches):
        own = held.setdefault(lang, Counter())
        own.update(words)
        if len(own) > TABLE:
            yield flush(lang)
    for lang in list(held):
        yield flush(lang)


def _filter(stream: DataFrame) -> Broadcast:
    key = F.concat_ws("\t", "lang", "phrase").cast("binary")
    return stream.sparkSession.sparkContext.broadcast(filter_of(stream, F.crc32(key)))


def _pass(bits: bytes, lang: str, phrases: list[bytes]) -> np.ndarray:
    own = lang.encode() + b"\t"
    return passes(bits, np.fromiter((crc32(own + p) for p in phrases), dtype=np.int64, count=len(phrases)))


class _Text:
    """Codes of one language's words in a task: those that pass the filter count from 0, all others are -1."""

    def __init__(self, lang: str, words: bytes):
        self.lang, self.bits = lang, words
        self.codes: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.held: list[np.ndarray] = []
        self.size = 0

    def read(self, words: list[bytes]) -> None:
        codes = self.codes
        codes[END] = -1
        new = [w for w in set(words).difference(codes) if w]
        for w, good in zip(new, _pass(self.bits, self.lang, new).tolist(), strict=True):
            codes[w] = len(self.names) if good else -1
            if good:
                self.names.append(w)
        own = np.fromiter([codes[w] for w in words if w], dtype=np.int64)
        self.held.append(own)
        self.size += len(own)

    def taken(self) -> np.ndarray:
        out = np.concatenate(self.held)
        self.held, self.size = [], 0
        return out

    def forget(self) -> None:
        self.codes, self.names = {}, []


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each distinct key, which of them each key is, and how often each occurs."""
    return np.unique(keys, return_index=True, return_inverse=True, return_counts=True)[1:]


def _phrases(pairs: bytes | None, longest: int) -> Callable[[_Text], Iterator[tuple[list[bytes], list[int]]]]:
    """Counts of the phrases in a text's codes: of pairs, or with a filter of pairs of 3 words up to ``longest``."""

    def count(text: _Text) -> Iterator[tuple[list[bytes], list[int]]]:
        codes, names, wide = text.taken(), text.names, np.int64(1) << 32
        at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))  # where a phrase begins
        first, which, often = _counted(codes[at] * wide + codes[at + 1])
        said = [names[a] + b" " + names[b] for a, b in zip(codes[at[first]].tolist(), codes[at[first] + 1].tolist(), strict=True)]
        if pairs is None:
            yield said, often.tolist()
            return
        known = _pass(pairs, text.lang, said)
        joined = np.zeros(len(codes) + longest, dtype=bool)  # whether a frequent pair begins here
        joined[at] = known[which]
        keep = joined[at]
        at, which = at[keep], which[keep]
        for m in range(3, longest + 1):
            more = joined[at + m - 2]
            at, which = at[more], which[more]
            first, longer, often = _counted(which * wide + codes[at + m - 1])
            said = [said[a] + b" " + names[b] for a, b in zip(which[first].tolist(), codes[at[first] + m - 1].tolist(), strict=True)]
            which = longer
            yield said, often.tolist()

    return count


def _counting(words: Broadcast, pairs: Broadcast | None, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _phrases(pairs.value if pairs else None, longest)
        texts: dict[str, _Text] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            if texts[lang].held:
                for phrases, often in count(texts[lang]):
                    yield _rows(lang, phrases, often)

        for lang, own in _by_language(batches):
            text = texts.setdefault(lang, _Text(lang, words.value))
            text.read(own)
            if text.size > WORDS_HELD:
                yield from flush(lang)
                if len(text.codes) > TABLE:
                    text.forget()
        for lang in texts:
            yield from flush(lang)

    return scan


def _stream(rows: DataFrame, least: int, label: str) -> DataFrame:
    """Added-up counts of at least ``least``, stored; and those of the empty phrase."""
    added = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return materialise(added.where((F.col("n") >= least) | (F.col("phrase") == "")), f"collocations-{label}")


def streams(docs: DataFrame, least: int, longest: int, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """``lang, n`` with the number of words, and the count streams ``lang, phrase, n`` of 1 to ``longest`` words."""
    read = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), whole(text_col).cast("binary").alias("text"))
    counted = _stream(read.mapInArrow(_words, COUNTS), least, "words")
    totals = counted.where("phrase = ''").select("lang", "n")
    out = [counted.where("phrase <> ''")]
    words = _filter(out[0])
    if longest >= 2:
        out.append(_stream(read.mapInArrow(_counting(words, None, 2), COUNTS), least, "pairs"))
    if longest >= 3:
        pairs = _filter(out[1])
        more = _stream(read.mapInArrow(_counting(words, pairs, longest), COUNTS), least, "phrases")
        out += [more.where(F.size(F.split("phrase", " ")) == m) for m in range(3, longest + 1)]
    return totals, out


def _first(m: int) -> Column:
    return F.substring_index("phrase", " ", m)


def _last(m: int) -> Column:
    return F.substring_index("phrase", " ", -m)


def counted(docs: DataFrame, least: int, longest: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, phrase, words, a, left, right, extension, n`` of every phrase of two words or more.

    ``left[k]`` is the count of the first ``k + 1`` words, ``right[k]`` that of the last ``k + 1``; ``extension`` the
    largest count of a phrase with one more word on either side, null where none reaches ``least``.
    """
    totals, orders = streams(docs, least, longest, lang_col, text_col)
    shorter = orders[0].select("lang", "phrase", F.array("n").alias("left"), F.array("n").alias("right"))
    known: list[DataFrame] = []
    for m in range(2, longest + 1):
        left = shorter.select("lang", F.col("phrase").alias("first"), "left").hint("merge")
        right = shorter.select("lang", F.col("phrase").alias("last"), "right").hint("merge")
        both = (
            orders[m - 1].withColumns({"first": _first(m - 1), "last": _last(m - 1)})
            .join(left, ["lang", "first"]).join(right, ["lang", "last"])
            .select("lang", "phrase", F.col("n").alias("a"), "left", "right", "first", "last")
        )
        stored = materialise(both, f"collocations-{m}")
        known.append(stored)
        shorter = stored.select("lang", "phrase", F.array_append("left", F.col("a")).alias("left"), F.array_append("right", F.col("a")).alias("right"))
    out: DataFrame | None = None
    for m in range(2, longest + 1):
        own = known[m - 2].select("lang", "phrase", F.lit(m).alias("words"), "a", "left", "right")
        if m < longest:
            longer = known[m - 1]
            ends = longer.select("lang", F.col("first").alias("phrase"), "a").unionByName(longer.select("lang", F.col("last").alias("phrase"), "a"))
            most = ends.groupBy("lang", "phrase").agg(F.max("a").alias("extension"))
            own = own.join(most.hint("merge"), ["lang", "phrase"], "left")
        else:
            own = own.withColumn("extension", F.lit(None).cast("long"))
        out = own if out is None else out.unionByName(own)
    return out.join(totals.hint("merge") if False else totals, "lang")


def mined(docs: DataFrame, least: int = 100, longest: int = 5, first: int = 2000, covered: int = 100, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The best ``first`` phrases of each language: ``lang, rank, phrase, words, a, l, r, n, score``.

    A phrase has 2 to ``longest`` words of one piece of a text and occurs ``a >= least`` times.  Its score is the lowest
    ``floor(1000 * a * n / (l * r))`` over its cuts, with the counts ``l`` and ``r`` of the two parts and the number
    ``n`` of all words; ties go to the earliest cut.  Phrases inside a longer one that occurs at least ``covered``
    hundredths as often are left out.  A null language is ``und``; null and empty texts hold no words; repeated rows count
    each; no rows give no phrases; other columns are not read.
    """
    rows = counted(docs, least, longest, lang_col, text_col)
    rows = rows.where(F.col("extension").isNull() | (100 * F.col("extension") < covered * F.col("a")))
    exact = lambda c: c.cast("decimal(18,0)")  # noqa: E731  products of two stay within 38 digits
    cut = lambda k: F.struct(
        F.call_function("div", exact(1000 * F.col("a")) * exact(F.col("n")), exact(F.get("left", k - 1)) * exact(F.get("right", F.col("words") - k - 1))).alias("score"),
        k.alias("k"), F.get("left", k - 1).alias("l"), F.get("right", F.col("words") - k - 1).alias("r"),
    )
    best = F.array_min(F.transform(F.sequence(F.lit(1), F.col("words") - 1), cut))
    rows = rows.withColumn("best", best).select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first in parts of a language, so that none of them is one task's
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= first).drop("rank")
    best = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return rows.withColumn("rank", best.cast("long")).where(F.col("rank") <= first)
