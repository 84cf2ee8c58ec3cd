"""Packing of token sequences by vector best-fit.

A document is its token ids and a closing id; longer ones are cut into pieces of the capacity.  A piece takes up three
capacities of a sequence: tokens, a document, and attention cost (the square of its length).  Pieces are dealt at random
into groups, and each group is packed by decreasing length: of the open sequences with room in every capacity, the one
with the least weighted residual norm afterwards (or the largest weighted dot-product of need and residual) takes it.
Groups hold thousands of pieces, so what the last sequence of each leaves open is small, and no task sees all pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import isqrt
from struct import pack as pack_ids
from unicodedata import is_normalized, normalize

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm.common import blocks, whole
from ledgerloom.session import materialise

#: Chunks between white space that a generation of a worker's memory holds; there are two generations.
REMEMBERED = 300_000
#: What the tokenizer takes as one word or mark, and the strings that it reads as one token.
WORD_OR_MARK = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
#: Texts with any of these go to the tokenizer as they are: separators that are not its white space, a letter whose lower
#: case depends on its place, and scripts in which the versions of Unicode in use might disagree.
SEPARATORS = "\x1c\x1d\x1e\x1f"
APART = re.compile("[\x1c-\x1f\u03a3\u0530-\U0010ffff]")


#: A mark that follows another one, or an underscore: the tokenizer reads both as one.
JOINED = re.compile(r"[.,](?<=[^\w\s].|_.)\s")
#: What byte-level vocabularies write for each byte: itself where that can be seen, else the next sign from 256 on.
SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
SIGNS = {b: b for b in SEEN} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in SEEN)}


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds.  A piece is as long as ``tokens`` and ``attention`` (its squared length) let it be."""

    tokens: int = 2048
    documents: int = 1024
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"

    @property
    def piece(self) -> int:
        return min(self.tokens, isqrt(self.attention))


def _apart(text: str) -> bool:
    odd = any(s in text for s in SEPARATORS) if text.isascii() else APART.search(text)
    return bool(odd) or any(s in text for s in SPECIAL)


class Encoder:
    """Token ids of whole texts as little-endian bytes, remembered by chunk.

    The tokenizer lower-cases, drops white space, and joins nothing across words and marks, so a text's ids are those of
    its chunks between white space in turn, and a chunk's those of its words and marks.  Ids of recent chunks are kept in
    two generations: when the young one is full it becomes the old one, and what is met again moves up, so common words
    stay and rare ones are forgotten.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _directly(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        known = self.young.get(part) or self.old.get(part)
        if known is None:
            signs = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(SIGNS)
            ids = [t.id for t in self.model.tokenize(signs)]
            known = pack_ids(f"<{len(ids)}I", *ids)
        return known

    def _chunks(self, text: str) -> list[str]:
        text = (text if is_normalized("NFC", text) else normalize("NFC", text)).lower()
        if not JOINED.search(text):  # a closing mark on its own is met more often than each word with one
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " .\n")
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if _apart(t) else self._chunks(t) for t in texts]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        for chunk in set().union(*[own for own in split if own]).difference(young):
            known = old.get(chunk)
            if known is None:
                known = self._part(chunk) if chunk.isalpha() else b"".join(map(self._part, WORD_OR_MARK.findall(chunk)))
            young[chunk] = known
        get = young.__getitem__
        return [self._directly(t) if own is None else b"".join(map(get, own)) for t, own in zip(texts, split, strict=True)]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), closing: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, crc`` (and ``ids``) for every piece; an empty or null text is its closing id alone."""
    end, size = np.array([closing], dtype="<u4").tobytes(), 4 * capacity.piece
    kind = pa.list_(pa.int32())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for block in blocks(batches, "text", 1 << 20):
            out: list[list] = [[], [], [], [], [], []]
            keys = block.column(0)
            for row, ids in enumerate(encoder.encode(block.column("text").to_pylist())):
                ids += end
                for k, start in enumerate(range(0, len(ids), size)):
                    part = ids[start : start + size]
                    for column, value in zip(out, (row, k, start // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        column.append(value)
            arrays = [keys.take(pa.array(out[0])), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(p, dtype="<i4") for p in out[5]], kind))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["id", "piece", "start", "length", "crc"] + ["ids"] * with_ids
    schema = "id long, piece int, start long, length long, crc long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece and its offset there; pieces come in decreasing length."""
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    scale = np.array(capacity.weights) / full**2
    room = np.empty((3, max(1, len(lengths))))  # residuals of the open sequences
    number = np.empty(max(1, len(lengths)), dtype=np.int64)
    sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    opened = made = 0
    for k, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) ** 2])
        fits = np.flatnonzero((room[0, :opened] >= need[0]) & (room[1, :opened] >= 1) & (room[2, :opened] >= need[2]))
        if len(fits):
            residual = room[:, fits]
            if capacity.rule == "dot":
                at = fits[np.argmax((scale * need) @ residual)]
            else:
                at = fits[np.argmin(scale @ (residual - need[:, None]) ** 2)]
        else:
            at = opened
            room[:, at], number[at] = full, made
            opened, made = opened + 1, made + 1
        sequence[k], offset[k] = number[at], capacity.tokens - room[0, at]
        room[:, at] -= need
        if room[0, at] < 1 or room[1, at] < 1 or room[2, at] < 1:  # nothing more can go in
            opened -= 1
            room[:, at], number[at] = room[:, opened], number[opened]
    return sequence, offset


def packed(cut: DataFrame, capacity: Capacity = Capacity(), group_rows: int = 16_000) -> DataFrame:
    """``cut`` (stored pieces) with ``sequence`` and ``offset``.

    A piece that no capacity can hold beside another is a sequence of its own without going through a group.
    """
    numbered = cut.withColumn("_row", F.monotonically_increasing_id())
    alone = (F.col("length") >= capacity.tokens) | (F.col("length") * F.col("length") >= capacity.attention)
    whole_ones = numbered.where(alone).select(
        *cut.columns, (F.col("_row") + F.lit(1 << 60)).alias("sequence"), F.lit(0).cast("long").alias("offset")
    )
    rest = numbered.where(~alone)
    groups = max(1, -(-rest.count() // group_rows))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
        sequence, offset = best_fit(rows["length"].to_numpy(), capacity)
        return rows.drop(columns=["_row", "_group"]).assign(sequence=sequence + (int(rows["_group"].iloc[0]) << 32), offset=offset)

    grouped = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes) + ", sequence long, offset long"
    return grouped.groupBy("_group").applyInPandas(pack, schema).unionByName(whole_ones)


def pack(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), closing: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of every row of ``docs`` with its place; repeated rows and null ids are pieces like any other.

    No rows give no pieces.  Other columns are not read.
    """
    cut = materialise(pieces(docs, tokenizer, capacity, closing, id_col, text_col, with_ids), "pieces")
    return packed(cut, capacity)
