"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a Python step holds at a time; a single longer text is handled alone.
BLOCK_BYTES = 4 << 20
#: Bits of a filter (4 MB as it is sent), whatever it stands for.
FILTER_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def id_residue(key: Column | str, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``: how labelled rows are split into folds."""
    return F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary")) % modulus


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in each block."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


def running(rows: DataFrame, by: list[str], bucket: Column, order: list[Column], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows before it in its group.

    ``bucket`` cuts a group into parts that follow the order.  Parts are summed first, the few sums run through a
    window, and each part is then numbered on its own, so a group of any size is spread over its parts.  Columns in
    ``by`` hold no null.
    """
    cut = rows.withColumn("_bucket", bucket).withColumn("_value", value)
    sums = cut.groupBy(*by, "_bucket").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*by, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.join(bases, [*by, "_bucket"])
        .withColumn(name, F.col("_base") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_bucket", "_value", "_base")
    )


def filter_of(rows: DataFrame, checksum: Column) -> bytes:
    """A bitmap with one bit set for each ``checksum`` (not negative) among ``rows``.

    At most ``FILTER_BITS`` bits reach the driver, however many rows there are; a fuller bitmap only lets more through.
    """
    bit = checksum % FILTER_BITS + 1  # Spark's bitmaps count from 1
    parts = rows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out, size = bytearray(FILTER_BITS // 8), 4096
    for row in parts.collect():
        out[(row["part"] - 1) * size : row["part"] * size] = row["bits"]
    return bytes(out)


def passes(bits: bytes, checksums: np.ndarray) -> np.ndarray:
    """Whether each checksum's bit is set."""
    at = checksums % FILTER_BITS
    return (np.frombuffer(bits, dtype=np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def discard(*tables: DataFrame) -> None:
    """Remove stored intermediate tables that nothing reads any more."""
    for table_ in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table_.inputFiles()[:1]}:
            path = table_.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table_.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
