"""Exact deduplication as a stream over disk-backed keyed state.

1.  Each text is reduced to its SHA-256 digest; digest, id and *content locator* (file and row in it) are landed as
    the stream's input.  Texts themselves stay where they are.
2.  A Structured Streaming aggregation keyed by digest keeps, without expiry, the stable id to keep, its locator and
    the number of rows seen, in RocksDB state with its checkpoint in the shared folder.  Copies are combined before the
    shuffle, so a text with very many copies reaches its state as one row a task.
3.  Digests seen more than once are *hits*.  Their texts are read again and their full bytes compared: the smallest
    and the largest text of a digest must be the same.  Where they differ, the digest's rows are told apart by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import whole
from ledgerloom.session import materialise, scratch_path

#: Bytes of landed keys in a micro-batch.
BATCH_BYTES = 1 << 30
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # many small stores: little memory for each one's writes, no disk set aside beforehand
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns as one), ``file`` and ``row``: where a row's content lies.

    Rows that come from a plan rather than from files are written to the shared folder first.
    """
    def with_locator(df: DataFrame) -> DataFrame:
        own = df.metadataColumn("_metadata")
        return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("doc"), own["file_path"].alias("file"), own["row_index"].alias("row"))

    try:
        return with_locator(docs)
    except AnalysisException:
        return with_locator(materialise(docs, "content"))


def _seen(spark: SparkSession, keys: DataFrame, path: str, batch_bytes: int) -> DataFrame:
    """Run what has landed through the keyed state; ``digest, kept, copies`` as the state ends."""
    work = scratch_path(spark, "exact-dedup")
    session = spark.newSession()
    shared = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    for key, value in (STATE | shared).items():
        session.conf.set(key, value)

    def store(updates: DataFrame, batch: int) -> None:
        updates.write.mode("overwrite").parquet(f"{work}/updates/batch={batch}")  # a batch that is run again replaces itself

    query = (
        session.readStream.schema(keys.schema).option("maxBytesPerTrigger", batch_bytes).parquet(path)
        .groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("kept"), F.count("*").alias("copies"))
        .writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", f"{work}/state").foreachBatch(store).start()
    )
    query.awaitTermination()
    empty = keys.limit(0).groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("kept"), F.count("*").alias("copies"))
    if keys.isEmpty():
        return empty
    updates = spark.read.schema(empty.schema).parquet(f"{work}/updates/*")
    return updates.groupBy("digest").agg(F.max_by("kept", "copies").alias("kept"), F.max("copies").alias("copies"))


def decisions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``id, file, row, digest, keep_id, group_size, kept`` for every row of ``docs``.

    Of equal texts the row with the largest id stays; of rows with the same text and id, the one whose file and row
    come last.  Null texts count as empty; null ids are the smallest.  An empty table gives no rows; other columns
    are not read.
    """
    spark = docs.sparkSession
    rows = located(docs)
    text = whole(F.col("doc")[text_col])
    path = scratch_path(spark, "keys")
    rows.select(F.col("doc")[id_col].alias("id"), digest(text).alias("digest"), "file", "row").write.parquet(path)
    keys = spark.read.parquet(path)
    hits = materialise(_seen(spark, keys, path, batch_bytes).where("copies > 1"), "hits")

    # the share of copies among the rows does not shrink with the corpus, so hits are never a broadcast's size for long
    texts = rows.select(digest(text).alias("digest"), text.alias("text")).join(hits.select("digest").hint("merge"), "digest", "left_semi")
    # written, so that a digest with very many rows may be split in the join and is combined before it is shuffled again
    hit_texts = materialise(texts, "hit-texts")
    differing = materialise(
        hit_texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("digest"), "differing"
    )
    alone = F.col("h.copies").isNull()
    same = keys.alias("k").join(hits.alias("h"), "digest", "left").select(
        "k.id", "k.file", "k.row", "digest", F.when(alone, F.col("k.id")).otherwise(F.col("h.kept.id")).alias("keep_id"),
        F.coalesce("h.copies", F.lit(1)).cast("long").alias("group_size"),
        (alone | ((F.col("k.file") == F.col("h.kept.file")) & (F.col("k.row") == F.col("h.kept.row")))).alias("kept"),
    )
    if differing.isEmpty():
        return same
    # digests shared by different texts: these rows are grouped by the text itself
    apart = rows.select(F.col("doc")[id_col].alias("id"), "file", "row", digest(text).alias("digest"), text.alias("text")).join(differing, "digest", "left_semi")
    by_text = apart.groupBy("digest", "text").agg(F.max(F.struct("id", "file", "row")).alias("kept"), F.count("*").alias("copies"))
    told = apart.alias("k").join(by_text.alias("h"), ["digest", "text"]).select(
        "k.id", "k.file", "k.row", "digest", F.col("h.kept.id").alias("keep_id"), F.col("h.copies").alias("group_size"),
        ((F.col("k.file") == F.col("h.kept.file")) & (F.col("k.row") == F.col("h.kept.row"))).alias("kept"),
    )
    return same.join(differing, "digest", "left_anti").unionByName(told.select(*same.columns))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; null texts are copies of empty ones, no rows give no rows."""
    try:
        docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = materialise(docs, "content")
    dropped = decisions(docs, id_col, text_col).where("not kept").select("file", "row")
    return located(docs).join(dropped.hint("merge"), ["file", "row"], "left_anti").select("doc.*")
