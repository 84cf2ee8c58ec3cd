"""Arriving notices as a stream: each micro-batch is carded against everything stored so far.

State is four tables in folders, one a batch: signed notices, the index of buckets by a hash of their values, the map to cards,
and aliases.  A batch's texts are shuffled once, to the slots that their notices are stored in; what is derived from them is
written there and read back, never copied.  Rows lie in
*slots* by a hash of what they are looked up by, a bucket or a notice id, so a batch reads the slots of its own keys and
nothing else, and a store that grows with its number of slots keeps the cost of a batch in proportion to the batch.

A list of live folders, written last, is what makes a batch count: until then nothing of it is read, and a batch that is
repeated replaces its own folder.  When there are many live folders they are merged into one, which the next list names
in their place; the merged ones are removed once that list is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import banding, cards
from ledgerloom.operators.signatures import hashed, with_signatures
from ledgerloom.session import TASK_ROWS, materialise

SCHEMAS = {
    "signed": "notice_id bigint, portal_id string, text_key string, title_set array<bigint>, body_set array<bigint>, signature array<bigint>, batch_id bigint, slot int",
    "index": "band_id int, bucket bigint, notice_id bigint, batch_id bigint, slot int",
    "card_map": "notice_id bigint, portal_id string, card_id string, created_at timestamp, batch_id bigint, slot int",
    "aliases": "card_id string, same_as string, batch_id bigint, slot int",
}
#: What a table's rows are looked up by, and sorted by inside a slot, so that files skip row groups as well.
KEYS = {"signed": ["notice_id"], "index": [*banding.BUCKET], "card_map": ["notice_id"], "aliases": ["card_id"]}


class CardStore:
    """Signed notices, the bucket index, the notice-to-card map and card aliases under one shared folder.

    ``slots`` holds for a new store; one that is there keeps its own.
    """

    def __init__(self, spark: SparkSession, base: str, slots: int = 64, merge_after: int = 16) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        self.merge_after = merge_after
        self.number, self.folders, self.slots = 0, [], slots
        self._refresh()

    # ---- the list of live folders -----------------------------------------------------------

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _lists(self) -> list[int]:
        files, path = self._path("live")
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        done = [int(n) for n in names if files.exists(self._path(f"live/{n}/_SUCCESS")[1])]
        return sorted(done)

    def _refresh(self) -> None:
        lists = self._lists()
        if lists and lists[-1] != self.number:
            self.number = lists[-1]
            rows = [r["value"] for r in self.spark.read.text(f"{self.base}/live/{self.number}").collect()]
            self.slots = int(next(r for r in rows if r.startswith("slots ")).removeprefix("slots "))
            self.folders = sorted(r for r in rows if not r.startswith("slots "))

    def _publish(self, folders: list[str]) -> None:
        rows = [(f"slots {self.slots}",), *[(f,) for f in folders]]
        self.spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(f"{self.base}/live/{self.number + 1}")
        self.number, self.folders = self.number + 1, sorted(folders)
        for old in self._lists()[:-2]:
            files, path = self._path(f"live/{old}")
            files.delete(path, True)

    # ---- tables -----------------------------------------------------------------------------

    def _read(self, name: str, slots: list[int] | None = None, without: str | None = None) -> DataFrame:
        paths = []
        for folder in self.folders:
            files, path = self._path(f"{name}/part={folder}")
            if folder != without and files.exists(path):
                paths.append(f"{self.base}/{name}/part={folder}")
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        out = self.spark.read.schema(SCHEMAS[name]).option("basePath", f"{self.base}/{name}").parquet(*paths).drop("part")
        return out if slots is None else out.where(F.col("slot").isin(slots))

    def signed(self) -> DataFrame:
        return self._read("signed")

    def index(self) -> DataFrame:
        return self._read("index")

    def card_map(self) -> DataFrame:
        return self._read("card_map")

    def aliases(self) -> DataFrame:
        return self._read("aliases")

    def cards(self) -> DataFrame:
        """Members and portals of each card, those of declared copies among them."""
        return self.card_map().groupBy("card_id").agg(
            F.min("notice_id").alias("first_notice"), F.count("*").alias("member_count"), F.count_distinct("portal_id").alias("portal_count")
        )

    def slot(self, *keys: str | Column) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.slots)).cast("int")

    def _slots_of(self, rows: DataFrame, *keys: str) -> list[int]:
        """The slots of some keys: at most ``slots`` numbers."""
        return sorted(r["slot"] for r in rows.select(self.slot(*keys).alias("slot")).distinct().collect())

    def _write(self, df: DataFrame, name: str, folder: str, dealt: bool = False) -> None:
        """Replace one folder of a table; rows that are ``dealt`` by slot are not shuffled."""
        slotted = df.withColumn("slot", self.slot(*KEYS[name]))
        slotted = slotted if dealt else slotted.hint("rebalance", "slot")
        slotted.sortWithinPartitions("slot", *KEYS[name]).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("slot").parquet(f"{self.base}/{name}/part={folder}")

    def _stored(self, df: DataFrame, name: str, batch_id: int, dealt: bool = False) -> DataFrame:
        """Write rows of one batch and read them back; they only count once ``_publish`` lists the folder."""
        folder = f"batch-{batch_id:012d}"
        self._write(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")), name, folder, dealt)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.base}/{name}/part={folder}").drop("batch_id", "slot")

    def _commit(self, tables: dict[str, DataFrame], batch_id: int) -> None:
        folder = f"batch-{batch_id:012d}"
        for name, rows in tables.items():
            self._stored(rows, name, batch_id)
        self._publish(sorted({*self.folders, folder}))
        if len(self.folders) > self.merge_after:
            self.merge()

    def merge(self) -> None:
        """Bring all live folders into one."""
        old, folder = list(self.folders), f"merged-{self.number:012d}"
        for name in SCHEMAS:
            self._write(self._read(name).drop("slot"), name, folder)
        self._publish([folder])
        for name in SCHEMAS:
            for gone in old:
                files, path = self._path(f"{name}/part={gone}")
                files.delete(path, True)

    # ---- arrivals ---------------------------------------------------------------------------

    def lookup(self, keys: DataFrame, without: str | None = None) -> DataFrame:
        """Ids of the stored notices in given buckets (``band_id, bucket``), from the slots of these buckets alone."""
        keys = banding.hashed_key(keys).select(*banding.BUCKET).distinct()
        index = self._read("index", self._slots_of(keys, *banding.BUCKET), without)
        return index.join(keys, banding.BUCKET, "left_semi").select("notice_id").distinct()

    def of_notices(self, name: str, ids: DataFrame, without: str | None = None) -> DataFrame:
        """Rows of ``signed`` or ``card_map`` for given ids, from the slots of these ids alone."""
        ids = ids.select("notice_id").distinct()
        return self._read(name, self._slots_of(ids, "notice_id"), without).drop("slot", "batch_id").join(ids, "notice_id", "left_semi")

    def add(self, notices: DataFrame, batch_id: int) -> None:
        """Card one batch.  A notice that already has a card is skipped, whichever batch it comes in."""
        self._refresh()
        own = f"batch-{batch_id:012d}"
        new, count = self._new(notices, own)
        fresh = self._stored(with_signatures(hashed(self._dealt(new, count), dealt=True)), "signed", batch_id, dealt=True)
        keys = self._stored(banding.hashed_key(banding.buckets(fresh)).select("band_id", "bucket", "notice_id"), "index", batch_id)
        met = materialise(self.lookup(keys, own), "touched")
        stored = materialise(self.of_notices("signed", met, own), "stored")
        # a declared copy has a card and no content, so only what is stored with content can be met
        known = self.of_notices("card_map", met, own).select("notice_id", "card_id")
        mapped, aliases = cards.arrive(stored, known, fresh)
        placed = mapped.join(fresh.select("notice_id", "portal_id"), "notice_id").withColumn("created_at", F.current_timestamp())
        self._commit({"aliases": aliases, "card_map": placed.select("notice_id", "portal_id", "card_id", "created_at")}, batch_id)

    def _new(self, notices: DataFrame, own: str) -> tuple[DataFrame, int]:
        """Notices without a card, each id once with the smallest of its rows, and their number.

        Only ids are grouped; of the texts, those that come more than once are.  Rows without an id count as one notice.
        """
        ids = materialise(notices.groupBy("notice_id").agg(F.count("*").alias("n")), "arriving")
        known = materialise(self.of_notices("card_map", ids, own).select("notice_id").distinct(), "known")
        asked = ids.join(known, "notice_id", "left_anti") if not known.isEmpty() else ids
        columns = ["notice_id", "portal_id", "title", "body"]
        several = materialise(ids.where("n > 1 OR notice_id IS NULL").select("notice_id"), "several")
        rest, new = notices.select(*columns), notices.select(*columns)
        if not known.isEmpty():
            rest = new = new.join(known, "notice_id", "left_anti")
        if not several.isEmpty():
            repeated = rest.join(several.where("notice_id IS NOT NULL"), "notice_id", "left_semi").unionByName(rest.where("notice_id IS NULL"))
            least = repeated.groupBy("notice_id").agg(F.min(F.struct("portal_id", "title", "body")).alias("n")).select("notice_id", "n.*")
            new = rest.where("notice_id IS NOT NULL").join(several, "notice_id", "left_anti").unionByName(least)
        return new, asked.count()

    def _dealt(self, notices: DataFrame, count: int) -> DataFrame:
        """Notices in tasks of about equally many, each of a few slots at most."""
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-count // TASK_ROWS))
        return notices.repartitionByRange(tasks, self.slot("notice_id"), "notice_id")

    def declare(self, copies: DataFrame, batch_id: int) -> DataFrame:
        """Put arrivals that are declared copies of a known notice on its card, without looking at any content.

        ``copies`` is ``notice_id, duplicate_of, portal_id``.  No card is renamed, and a notice that has a card keeps it.
        Returns the rows whose original is not known, which are left out.  Of several declarations of one notice the
        one of the smallest original counts.
        """
        self._refresh()
        own = f"batch-{batch_id:012d}"
        once = materialise(copies.groupBy("notice_id").agg(F.min(F.struct("duplicate_of", "portal_id")).alias("c")).select("notice_id", "c.*"), "declared")
        originals = once.select(F.col("duplicate_of").alias("notice_id"))
        given = self.of_notices("card_map", originals, own).select(F.col("notice_id").alias("duplicate_of"), "card_id")
        known = self.of_notices("card_map", once, own).select("notice_id")
        found = materialise(once.join(given, "duplicate_of", "left"), "declared")
        new = found.where("card_id IS NOT NULL").join(known, "notice_id", "left_anti")
        self._commit({"card_map": new.select("notice_id", "portal_id", "card_id", F.current_timestamp().alias("created_at"))}, batch_id)
        return found.where("card_id IS NULL").select("notice_id", "duplicate_of", "portal_id")


def run_available(spark: SparkSession, folder: str, store: CardStore) -> None:
    """Card whatever is new in ``folder``; the stream's checkpoint remembers what was seen."""
    source = spark.readStream.schema("notice_id bigint, portal_id string, title string, body string").parquet(folder)
    query = (
        source.writeStream.foreachBatch(lambda batch, batch_id: store.add(batch, batch_id))
        .option("checkpointLocation", f"{store.base}/stream").trigger(availableNow=True).start()
    )
    query.awaitTermination()
