"""Hashed shingle sets and MinHash signatures, one narrow pass over the texts.

Everything about one notice comes from its own row, so nothing is shuffled: cleaning and tokens are
column expressions, n-grams with their hashes and the modular minima run over Arrow batches.  An md5
of a short n-gram costs a third there of what it does as an expression, and the minima need products
that wrap at 64 unsigned bits, which checked BIGINT arithmetic refuses.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions import hashing
from ledgerloom.functions.hashing import family, gram_hashes, minima
from ledgerloom.functions.similarity import ALPHA
from ledgerloom.session import materialise, spread

ROWS = 128

# Executors need no installed copy of this package: the few helpers travel with the task.
cloudpickle.register_pickle_by_value(hashing)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _fields(cleaned: bool) -> tuple[Column, Column]:
    title, body = F.col("title"), F.col("body")
    if cleaned:
        return T.clean_title(title), T.clean_body(body)
    return F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))


def shingle_columns(cleaned: bool = True) -> tuple[Column, Column]:
    """Title and body n-grams of a notice, from cleaned text or from the text as it came."""
    title, body = _fields(cleaned)
    return T.word_grams(T.tokens(title), T.TITLE_GRAM), T.word_grams(T.tokens(body), T.BODY_GRAM)


def raw_shingles() -> Column:
    """Word 3-grams of the uncleaned title and body together."""
    joined = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("body", F.lit("")))
    return T.word_grams(T.tokens(joined), T.RAW_GRAM)


def hashed(notices: DataFrame, cleaned: bool = True, keep: list[str] = (), dealt: bool = False) -> DataFrame:
    """Per notice: hashed title and body sets, and a key equal for notices with the same words.

    The sets are those of ``hash_grams`` over ``shingle_columns``, in the same order.  Notices that are ``dealt`` to tasks
    stay where they are.
    """
    words = worded(notices if dealt else spread(notices), cleaned).select(
        "notice_id", "portal_id", *keep, F.md5(F.concat_ws("\u0001", "title_words", "body_words")).alias("text_key"),
        "title_words", "body_words",
    )
    kept = words.columns[:-2]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields[:-2])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_lists_of(gram_hashes(batch.column(name).to_pylist(), n)) for name, n in (("title_words", T.TITLE_GRAM), ("body_words", T.BODY_GRAM))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *sets], names=[*kept, "title_set", "body_set"])

    return words.mapInArrow(shingled, f"{schema}, title_set array<bigint>, body_set array<bigint>")


def worded(notices: DataFrame, cleaned: bool = True) -> DataFrame:
    """Notices with ``title_words`` and ``body_words``, their tokens in order with a blank between them."""
    title, body = _fields(cleaned)
    return notices.withColumns({
        "title_words": F.array_join(T.tokens(title), " "), "body_words": F.array_join(T.tokens(body), " "),
    })


def _lists_of(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    values = np.concatenate([*sets, np.empty(0, dtype=np.uint64)]).astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, start positions and lengths of a list column."""
    counts = np.diff(column.offsets.to_numpy()).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
    return values, np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64), counts


def _long_lists(matrix: np.ndarray) -> pa.Array:
    height, width = matrix.shape
    offsets = np.arange(0, (height + 1) * width, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.astype(np.int64).ravel()))


def with_signatures(sets: DataFrame, rows: int = ROWS, interleaved: bool = True) -> DataFrame:
    """Add MinHash signatures to hashed sets.

    Interleaved: one ``signature`` of ``rows`` values, title minima at even and body minima at odd
    places.  Otherwise ``title_sig`` and ``body_sig`` of ``rows`` values each.
    """
    names = sets.columns
    added = ["signature"] if interleaved else ["title_sig", "body_sig"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sets.schema.fields)
    schema += "".join(f", {name} array<bigint>" for name in added)
    per_field = rows // 2 if interleaved else rows
    title_family, body_family = family("title", per_field), family("body", per_field)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            title = minima(*_lists(batch.column("title_set")), *title_family)
            body = minima(*_lists(batch.column("body_set")), *body_family)
            if interleaved:
                both = np.empty((batch.num_rows, rows), dtype=np.uint64)
                both[:, 0::2], both[:, 1::2] = title, body
                extra = [_long_lists(both)]
            else:
                extra = [_long_lists(title), _long_lists(body)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*names, *added])

    return sets.mapInArrow(sign, schema)


def signed(notices: DataFrame, rows: int = ROWS, cleaned: bool = True, keep: list[str] = ()) -> DataFrame:
    """The stored table every later step reads: hashed sets, text key and signature per notice."""
    return materialise(with_signatures(hashed(notices, cleaned, keep), rows), "signed")


def reachable(alpha: float = ALPHA) -> Column:
    """The highest composite similarity a notice can have with any other: empty fields score 0."""
    title = F.when(F.size("title_set") > 0, alpha).otherwise(0.0)
    body = F.when(F.size("body_set") > 0, 1.0 - alpha).otherwise(0.0)
    return title + body
