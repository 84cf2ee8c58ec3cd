"""Token hashes and the seeded universal hash family behind the MinHash signatures."""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5
from math import sin

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: signatures are only comparable when these stay as they are ---------------
MODULUS = (1 << 61) - 1
MAX_ROWS = 512
SEED = 42
# ---------------------------------------------------------------------------------------------
#: Values that ``minima`` takes at a time.
BLOCK = 32_768
_LOW_NIBBLES = 0x0F0F0F0F0F0F0F0F
#: Longest text whose md5 is one block, how many of these are hashed at a time, and of how many notices n-grams are cut.
SHORT, TEXTS, NOTICES = 55, 8192, 256
# Constants of md5 (RFC 1321): rotations and addends of its 64 steps, and the state it starts from.
_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_ADDENDS = [int(abs(sin(k + 1)) * (1 << 32)) for k in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _swapped_bits(text: Column) -> Column:
    """The first eight md5 bytes with their order and the two hex digits of each byte reversed.

    ``conv`` to base -10 reads the sixteen digits as a signed value, so it always fits a BIGINT.
    """
    return F.conv(F.reverse(F.substring(F.md5(text), 1, 16)), 16, -10).cast("bigint")


def _unswapped(bits: Column) -> Column:
    """Put the two digits of each byte back in order and keep 61 bits."""
    low = F.shiftleft(bits.bitwiseAND(F.lit(_LOW_NIBBLES)), 4)
    high = F.shiftrightunsigned(bits, 4).bitwiseAND(F.lit(_LOW_NIBBLES))
    return low.bitwiseOR(high).bitwiseAND(F.lit(MODULUS))


def token_hash(text: Column) -> Column:
    """First eight md5 bytes, little-endian, kept to 61 bits, as BIGINT."""
    return _unswapped(_swapped_bits(text))


def hash_grams(grams: Column) -> Column:
    """``token_hash`` of every element; in two passes, so that each md5 is taken once."""
    return F.transform(F.transform(grams, _swapped_bits), _unswapped)


def grams_of(words: str, n: int) -> list[str]:
    """Distinct word n-grams of words with a blank between them, as ``text.word_grams`` has them."""
    own = words.split(" ") if words else []
    if len(own) < n:
        return [words] if own else []
    return list(dict.fromkeys(map(" ".join, zip(*(own[k:] for k in range(n)), strict=False))))


def gram_hashes(texts: list[str], n: int) -> list[np.ndarray]:
    """``token_hash`` of every n-gram of each text, as ``grams_of`` lists them.

    Words have one blank between them, so an n-gram is a slice of its text; the slices of many texts are hashed together.
    """
    return [found for at in range(0, len(texts), NOTICES) for found in _gram_hashes(texts[at : at + NOTICES], n)]


def _gram_hashes(texts: list[str], n: int) -> list[np.ndarray]:
    rows = [(words or "").encode() for words in texts]
    joined = b" ".join(rows)
    data = np.frombuffer(joined + bytes(SHORT + 9), dtype=np.uint8)  # a window of one block may begin anywhere
    blanks = np.flatnonzero(data[: len(joined)] == ord(" "))
    begins, ends = np.concatenate(([0], blanks + 1)), np.concatenate((blanks, [len(joined)]))
    words = np.array([row.count(b" ") + 1 for row in rows], dtype=np.int64)
    grams = np.where(np.array([len(row) for row in rows], dtype=np.int64) > 0, np.maximum(words - n + 1, 1), 0)
    cuts = np.concatenate(([0], np.cumsum(grams)))
    first = np.repeat(np.cumsum(words) - words - cuts[:-1], grams) + np.arange(cuts[-1])
    last = first + np.repeat(np.minimum(words, n) - 1, grams)
    hashes = pa.array(md5_heads(data, begins[first], ends[last]) & np.uint64(MODULUS))
    return [hashes.slice(at, count).unique().to_numpy(zero_copy_only=False) for at, count in zip(cuts[:-1].tolist(), grams.tolist(), strict=True)]


def md5_heads(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """First eight md5 bytes, little-endian, of many slices of ``data``, which goes on for a block after the last one.

    A short text is one block, and the 64 steps of all such blocks are taken together; a long one has its own digest.
    """
    out, sizes = np.empty(len(begins), dtype=np.uint64), ends - begins
    for at in np.flatnonzero(sizes > SHORT):
        out[at] = int.from_bytes(md5(data[begins[at] : ends[at]].tobytes()).digest()[:8], "little")
    windows = np.lib.stride_tricks.sliding_window_view(data, SHORT + 9)
    places = np.arange(SHORT + 9)
    kept = np.where(places < np.arange(SHORT + 1)[:, None], 0xFF, 0).astype(np.uint8)
    closed = np.where(places == np.arange(SHORT + 1)[:, None], 0x80, 0).astype(np.uint8)
    short = np.flatnonzero(sizes <= SHORT)
    for at in range(0, len(short), TEXTS):
        own = short[at : at + TEXTS]
        size = sizes[own]
        block = np.ascontiguousarray(((windows[begins[own]] & kept[size]) | closed[size]).view("<u4").T)
        block[14] = size * 8
        a, b, c, d = (np.full(len(own), word, dtype=np.uint32) for word in _START)
        mixed, turned = np.empty_like(a), np.empty_like(a)
        for k in range(64):
            if k < 16:
                word = k
                np.bitwise_xor(c, d, out=mixed)
                mixed &= b
                mixed ^= d
            elif k < 32:
                word = (5 * k + 1) % 16
                np.bitwise_xor(b, c, out=mixed)
                mixed &= d
                mixed ^= c
            elif k < 48:
                word = (3 * k + 5) % 16
                np.bitwise_xor(b, c, out=mixed)
                mixed ^= d
            else:
                word = 7 * k % 16
                np.invert(d, out=mixed)
                mixed |= b
                mixed ^= c
            mixed += a
            mixed += block[word]
            mixed += np.uint32(_ADDENDS[k])
            np.right_shift(mixed, np.uint32(32 - _TURNS[k]), out=turned)
            mixed <<= np.uint32(_TURNS[k])
            mixed |= turned
            mixed += b
            a, d, c, b, mixed = d, c, b, mixed, a
        out[own] = (a + np.uint32(_START[0])).astype(np.uint64) | ((b + np.uint32(_START[1])).astype(np.uint64) << np.uint64(32))
    return out


@lru_cache(maxsize=None)
def coefficients(field: str, seed: int = SEED, rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of one field's hash functions, drawn in a fixed order from one seed."""
    rng = np.random.RandomState(seed)
    drawn = {}
    for name in ("title", "body"):
        multipliers = rng.randint(1, MODULUS, size=rows, dtype=np.uint64) | np.uint64(1)
        drawn[name] = multipliers, rng.randint(0, MODULUS, size=rows, dtype=np.uint64)
    return drawn[field]


def family(field: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``rows`` functions of one field."""
    multipliers, offsets = coefficients(field)
    return multipliers[:rows], offsets[:rows]


def minima(
    values: np.ndarray, starts: np.ndarray, counts: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray
) -> np.ndarray:
    """Smallest hash per function and set, for many sets laid end to end; zeros for an empty set.

    The product wraps at 64 bits before the modulus is taken; 2^61-1 is taken by folding.  Sets are taken in blocks whose
    values stay in the processor's cache for all functions.
    """
    out = np.zeros((len(counts), len(multipliers)), dtype=np.uint64)
    filled = np.flatnonzero(counts)
    begins = starts[filled]
    modulus, fold = np.uint64(MODULUS), np.uint64(61)
    at = 0
    while at < len(filled):
        first = starts[filled[at]]
        end = max(at + 1, int(np.searchsorted(begins, first + BLOCK)))
        own, at = filled[at:end], end
        block, cuts = values[first : starts[own[-1]] + counts[own[-1]]], starts[own] - first
        hashed, high = np.empty_like(block), np.empty_like(block)
        for row in range(len(multipliers)):
            np.multiply(block, multipliers[row], out=hashed)
            hashed += offsets[row]
            np.right_shift(hashed, fold, out=high)
            hashed &= modulus
            hashed += high
            np.subtract(hashed, modulus, out=high)  # wraps far above where there is nothing to take off
            np.minimum(hashed, high, out=hashed)
            out[own, row] = np.minimum.reduceat(hashed, cuts)
    return out
