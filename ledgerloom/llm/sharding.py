"""Sharding by weighted rendezvous hashing; DataFrame operations only.

Every shard draws a number from a record's key, scaled by the shard's weight; the smallest wins.  A draw depends on the
key and that shard alone, so one more shard takes rows only into itself, in proportion to its weight, and no row moves
between the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import running, whole
from ledgerloom.session import materialise

LANES = 4  # 32-bit draws in one digest


def _digest(key: Column, block: int) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{block}")).cast("binary"))


def shard_of(digests: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard whose exponential draw is smallest; ties go to the lower shard, which no real key shows."""
    draws = []
    for shard, weight in enumerate(weights):
        lane = F.substring(digests[shard // LANES], 1 + 8 * (shard % LANES), 8)
        unit = (F.conv(lane, 16, 10).cast("double") + 0.5) / float(1 << 32)
        draws.append(F.struct((-F.log(unit) / weight).alias("draw"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*draws))["shard"]


def assigned(rows: DataFrame, key: str, weights: Sequence[float], name: str = "shard", grown: Sequence[float] | None = None) -> DataFrame:
    """``rows`` with their shard ``name`` and, where ``grown`` weights are given, ``grown_<name>`` under those.

    Equal keys share a shard, whatever else they hold; null keys count as one empty key.
    """
    most = max(len(weights), len(grown or ()))
    marks = [f"_digest{b}" for b in range(-(-most // LANES))]
    out = rows.select("*", *[_digest(F.col(key), b).alias(m) for b, m in enumerate(marks)])
    columns = [shard_of([F.col(m) for m in marks], weights).alias(name)]
    if grown is not None:
        columns.append(shard_of([F.col(m) for m in marks], grown).alias(f"grown_{name}"))
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], *columns)


def sharded(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard[, grown_shard], slot`` for every row.

    ``size`` is the text's UTF-8 bytes plus one; a null text has none and the checksum of no bytes.  ``slot`` numbers a
    shard's rows without gaps from 0.  Repeated rows have a slot each, a null id is a key like any other, and no rows give
    no rows.
    """
    text = whole(text_col)
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    stored = materialise(assigned(rows, "id", weights, "shard", grown), "shards")
    part = F.substring(_digest(F.col("id"), -1), 1, 3)
    return running(stored, ["shard"], part, [F.col("id"), F.col("size"), F.col("text_crc32")], F.lit(1).cast("long"), "slot")
