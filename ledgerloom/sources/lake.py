"""The partitioned Parquet lake: landing, scans and a listing of what landed."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.session import scratch_root

PARTITIONS = ["year", "month", "store"]


def land(
    lines: DataFrame, base: str, max_records: int = 5_000_000, slot: Column | None = None, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> None:
    """Land lines as snappy Parquet under year/month/store; a rerun replaces the same partitions.

    ``rebalance`` brings a partition's rows together and splits one that is far larger than the
    others, so a dominant store neither lands in one task nor in one enormous file.  ``finish`` adds columns that need not
    be shuffled; then ``slot`` is a hash of the partition from the columns that are there before.
    """
    together = lines.withColumn("slot", F.hash("year", "month", "store_id") if slot is None else slot).hint("rebalance", "slot")
    (
        finish(together).drop("slot").withColumn("store", F.col("store_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*PARTITIONS)
        .parquet(base)
    )


def manifest(spark: SparkSession, sources: list[str]) -> str:
    """A digest of every file below ``sources``: path, length and time of the last change."""
    found = []
    for source in sources:
        path = spark._jvm.org.apache.hadoop.fs.Path(source)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            file = files.next()
            found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


def _committed(spark: SparkSession, root: str) -> str | None:
    """The first finished table below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []
    done = [n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    return f"{root}/{done[0]}" if done else None


def _root(spark: SparkSession, label: str, sources: list[str]) -> str:
    key = hashlib.md5(f"{label} {sources}".encode()).hexdigest()
    return f"{scratch_root(spark)}/landed/{key}-{manifest(spark, sources)}"


def is_landed(spark: SparkSession, label: str, sources: list[str]) -> bool:
    """Whether ``once`` would find its table made."""
    return _committed(spark, _root(spark, label, sources)) is not None


def once_path(spark: SparkSession, label: str, sources: list[str], columns: list[str], build: Callable[[], DataFrame]) -> str:
    """The folder of a table that ``build`` makes from the files below ``sources``, landed under ``columns``.

    It is made when this application first asks for ``label``, and again whenever one of these files has changed, came or
    went.  Each making goes to a folder of its own and counts from its marker on, so two at once do not disturb each
    other, and what was read from an earlier one stays readable.
    """
    root = _root(spark, label, sources)
    done = _committed(spark, root)
    if done is None:
        rows = build()
        writer = (rows.hint("rebalance", *columns) if columns else rows).write.option("partitionOverwriteMode", "static")
        (writer.partitionBy(*columns) if columns else writer).parquet(f"{root}/{uuid.uuid4().hex}")
        done = _committed(spark, root)
    return done


def once(spark: SparkSession, label: str, sources: list[str], columns: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """The table of ``once_path``, read; its partition columns are strings."""
    return partitioned(spark, once_path(spark, label, sources, columns, build), columns)


def partitioned(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A table whose partition values are taken as they are written: '01' stays a string, whatever the session infers."""
    if not columns:
        return spark.read.parquet(path)
    own = spark.read.option("recursiveFileLookup", True).parquet(path).schema
    schema = StructType([f for f in own.fields if f.name not in columns] + [StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).parquet(path)


def scan(spark: SparkSession, base: str) -> DataFrame:
    """The whole lake with its partition columns; a filter on them prunes files."""
    return partitioned(spark, base, PARTITIONS)


def listing(spark: SparkSession, base: str) -> DataFrame:
    """Files of the lake: partition values, size and path, without reading their rows.

    The binary reader lists files with their lengths; their content column is never asked for.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .load(base).select("path", "length")
    )
    part = lambda name: F.regexp_extract("path", rf"{name}=([^/]+)", 1)
    return files.select(*[part(p).alias(p) for p in PARTITIONS], "length", "path")


def listing_summary(spark: SparkSession, base: str) -> DataFrame:
    """Files and bytes per partition."""
    return listing(spark, base).groupBy(*PARTITIONS).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )


def files_read(df: DataFrame) -> DataFrame:
    """How many files and bytes hold the rows of ``df``, a scan with its filters applied."""
    return (
        df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
        .groupBy("p", "s").agg(F.count("*").alias("n"))
        .agg(F.count("*").alias("files"), F.coalesce(F.sum("s"), F.lit(0)).alias("bytes"),
             F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A small metrics table as JSON lines."""
    metrics.write.mode("overwrite").json(path)
