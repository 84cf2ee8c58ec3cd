"""LSH buckets over signatures and the candidate pairs they yield."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise

BANDS = 32
ROWS_PER_BAND = 4
# From this many members on, clustering compares a bucket through its head and rare shingles instead of in full.
PAIRED_BUCKET = 150
BUCKET = ["band_id", "bucket"]


def band_slices(signature: Column, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> Column:
    """The signature cut into ``bands`` runs of ``rows`` values."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.slice(signature, i * rows + 1, rows))


def bucket_text(bucket: Column) -> Column:
    """A bucket's values as sixteen lower-case hex digits each, joined by underscores."""
    return F.array_join(F.transform(bucket, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "_")


def buckets(signed: DataFrame, bands: int = BANDS, rows: int = ROWS_PER_BAND, keep: list[str] = ()) -> DataFrame:
    """One row per notice and band."""
    return signed.select("notice_id", *keep, F.posexplode(band_slices(F.col("signature"), bands, rows))).select(
        "notice_id", *keep, F.col("pos").alias("band_id"), F.col("col").alias("bucket")
    )


def short_key(banded: DataFrame) -> DataFrame:
    """A bucket's values as 128 bits of hashes: enough to tell buckets apart, and half of what is shuffled."""
    return banded.withColumn("bucket", F.struct(F.xxhash64("bucket").alias("lo"), F.xxhash64(F.lit(1), "bucket").alias("hi")))


def hashed_key(banded: DataFrame) -> DataFrame:
    """A bucket's values as one hash, for uses that hold what they find against the values; hashes are left as they are."""
    return banded if dict(banded.dtypes)["bucket"] == "bigint" else banded.withColumn("bucket", F.xxhash64("bucket"))


def bucket_index(signed: DataFrame, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """The bucket table as stored: band, bucket text, notice."""
    return buckets(signed, bands, rows).select("band_id", bucket_text(F.col("bucket")).alias("bucket_hash"), "notice_id")


def _entry() -> Column:
    """Band and hash as one key: files of a table can be told apart by the value of one column only."""
    return F.concat_ws(":", F.col("band_id").cast("string"), "bucket_hash")


def store_index(index: DataFrame, path: str, files: int, row_group_bytes: int = 16 << 20) -> DataFrame:
    """Replace the stored bucket table and return it, with ``entry`` for band and hash: dealt to ``files`` by it, sorted inside.

    A join on the entry reads the table without a shuffle; a single entry reads one file, and there the row groups whose
    range holds it.  The layout is known through a catalogue entry, which is only there while this is called.
    """
    spark, name = index.sparkSession, f"bucket_index_{uuid.uuid4().hex}"
    (
        index.withColumn("entry", _entry()).repartition(files, "entry")  # one file each
        .write.mode("overwrite").option("path", path).option("parquet.block.size", row_group_bytes)
        .bucketBy(files, "entry").sortBy("entry").saveAsTable(name)
    )
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Members of given buckets (``band_id, bucket_hash``); one batch of keys is one join, not one query per key."""
    asked = keys.select(_entry().alias("entry")).distinct()
    return index.join(asked, "entry", "left_semi").select("band_id", "bucket_hash", "notice_id")


def shared_buckets(members: DataFrame) -> DataFrame:
    """Rows in buckets of two or more notices, with the bucket's size.

    Sizes are counted first, so the many single-member buckets never reach a join of rows.
    """
    sizes = members.groupBy(*BUCKET).agg(F.count("*").alias("bucket_size")).where("bucket_size > 1")
    return members.join(sizes, BUCKET)


def shared_rows(signed: DataFrame, across: str | None = None, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """``notice_id, band_id, bucket`` (and ``across``) of all buckets of two or more notices, with the bucket's size ``n``;
    stored, for the many steps that ask nothing of a bucket of one.

    Half of the key says which buckets may be shared, so what most rows are sorted and shuffled for is one hash.
    """
    banded = short_key(buckets(signed, bands, rows, [across] if across else [])).withColumn("lo", F.col("bucket.lo"))
    likely = banded.groupBy("band_id", "lo").agg(F.count("*").alias("n")).where("n > 1").select("band_id", "lo")
    held = materialise(banded.join(likely, ["band_id", "lo"]).drop("lo"), "held")
    sizes = held.groupBy(*BUCKET).agg(F.count("*").alias("n")).where("n > 1")
    return materialise(held.join(sizes, BUCKET), "shared")


def pairs_within(members: DataFrame, across: str | None = None, keep_size: bool = False) -> DataFrame:
    """Distinct pairs ``id_a < id_b`` of notices that share a bucket.

    ``across`` names a column whose values must differ, such as the portal.  With ``keep_size`` each
    pair carries the smallest shared bucket's size.  Bound the buckets before calling this.
    """
    columns = ["notice_id", *([across] if across else [])]
    a = members.select(*BUCKET, *[F.col(c).alias(f"{c}_a") for c in columns], "bucket_size")
    b = members.select(*BUCKET, *[F.col(c).alias(f"{c}_b") for c in columns])
    rule = F.col("notice_id_a") < F.col("notice_id_b")
    if across:
        rule = rule & (F.col(f"{across}_a") != F.col(f"{across}_b"))
    met = a.join(b, BUCKET).where(rule).select(
        F.col("notice_id_a").alias("id_a"), F.col("notice_id_b").alias("id_b"), "bucket_size"
    )
    if keep_size:
        return met.groupBy("id_a", "id_b").agg(F.min("bucket_size").alias("min_bucket"))
    return met.select("id_a", "id_b").distinct()


def capped_candidates(
    signed: DataFrame, cap: int, across: str | None = "portal_id",
    bands: int = BANDS, rows: int = ROWS_PER_BAND,
) -> DataFrame:
    """Candidate pairs under the published stop-bucket rule: a bucket with more than ``cap`` notices is skipped
    whole, its size counted before the portal rule.  The cap is what this operator is, so it has no default;
    ``skipped`` says what it leaves out, and clustering (``matching.linked``) leaves nothing out.
    """
    keep = [across] if across else []
    members = shared_buckets(buckets(signed, bands, rows, keep)).where(F.col("bucket_size") <= cap)
    return pairs_within(members, across)


def skipped(signed: DataFrame, caps: tuple[int, ...], across: str | None = "portal_id", bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """Buckets and comparisons that each cap leaves out; a cap of 0 is none."""
    over = bucket_crowds(signed, across, bands, rows).select("n", "comparisons", F.explode(F.array(*[F.lit(c) for c in caps])).alias("cap"))
    left = (F.col("cap") > 0) & (F.col("n") > F.col("cap"))
    return over.groupBy("cap").agg(
        F.count_if(left).alias("skipped_buckets"), F.coalesce(F.sum(F.when(left, F.col("comparisons"))), F.lit(0)).alias("skipped_comparisons")
    )


def collide(a: Column, b: Column, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> Column:
    """Whether two signatures agree on every row of at least one band."""
    same = F.zip_with(band_slices(a, bands, rows), band_slices(b, bands, rows), lambda x, y: x == y)
    return F.exists(same, lambda hit: hit)


def memberships(signed: DataFrame) -> DataFrame:
    """``representative, notice_id`` for every notice: a wording is represented by the smallest notice that has it."""
    reps = copies_of(signed).select("text_key", F.col("rep_id").alias("representative"))
    return signed.select("notice_id", "text_key").join(reps, "text_key").select("representative", "notice_id")


def class_index(signed: DataFrame, bands: int = BANDS, rows: int = ROWS_PER_BAND, shared: DataFrame | None = None) -> DataFrame:
    """The inverted index over wordings: ``band_id, bucket, representative``.

    Notices of one wording have one signature, so the index holds one row a band for all of them; with ``shared_rows`` one for
    each bucket that is not its notice's own, which is all that a probe meets another notice in.
    """
    reps = copies_of(signed).select(F.col("rep_id").alias("notice_id"))
    if shared is not None:
        return shared.join(reps, "notice_id", "left_semi").select(*BUCKET, F.col("notice_id").alias("representative"))
    return buckets(signed.join(reps, "notice_id", "left_semi"), bands, rows).withColumnRenamed("notice_id", "representative")


def expand_probes(index: DataFrame, members: DataFrame, probes: DataFrame) -> DataFrame:
    """``probe_id, representative``: the distinct wordings that each probe shares a bucket with.

    ``index`` is a ``class_index``, ``members`` the ``memberships``, ``probes`` a table of ``probe_id``.  Buckets are looked
    up once for each wording that has a probe; its own wording counts if another notice has it.  Members of the
    representatives are the candidate notices.
    """
    asked = members.join(probes.select(F.col("probe_id").alias("notice_id")).distinct(), "notice_id", "left_semi")
    asking = asked.select("representative").distinct()
    keys = index.join(asking, "representative", "left_semi").select(*BUCKET, F.col("representative").alias("asked"))
    met = index.join(keys, BUCKET).where("asked <> representative").select("asked", "representative").distinct()
    alone = members.join(asking, "representative", "left_semi").groupBy("representative").agg(F.count("*").alias("n"))
    own = alone.where("n > 1").select(F.col("representative").alias("asked"), "representative")
    by_probe = asked.select(F.col("notice_id").alias("probe_id"), F.col("representative").alias("asked"))
    return by_probe.join(met.unionByName(own), "asked").select("probe_id", "representative")


def candidate_notices(met: DataFrame, members: DataFrame) -> DataFrame:
    """``probe_id, candidate_id``: the wordings that ``expand_probes`` found as the notices that have them, without the probe."""
    candidates = members.withColumnRenamed("notice_id", "candidate_id")
    return met.join(candidates, "representative").where("candidate_id <> probe_id").select("probe_id", "candidate_id").distinct()


def copies_of(signed: DataFrame) -> DataFrame:
    """Groups of notices with the same words: representative, size and portals at both ends.

    A plain aggregation with map-side reduction, however many copies one text has.
    """
    return signed.groupBy("text_key").agg(
        F.min("notice_id").alias("rep_id"), F.count("*").alias("copies"),
        F.min("portal_id").alias("first_portal"), F.max("portal_id").alias("last_portal"),
    )


def crowds(signed: DataFrame, across: str | None = None, bands: int = BANDS, rows: int = ROWS_PER_BAND, key: Callable[[DataFrame], DataFrame] = lambda banded: banded) -> DataFrame:
    """Per group of notices in a bucket (of one portal, with ``across``): the bucket's size ``n`` and what each member of
    the group is compared with there, ``others``.  Everything follows from sizes, so no pair is ever listed.  ``key`` may
    be ``short_key`` where the values of buckets are not asked for."""
    if across is None:
        sizes = key(buckets(signed, bands, rows)).groupBy(*BUCKET).agg(F.count("*").alias("n"))
        return sizes.select(*BUCKET, "n", F.col("n").alias("own"), (F.col("n") - 1).alias("others"))
    own = key(buckets(signed, bands, rows, [across])).groupBy(*BUCKET, across).agg(F.count("*").alias("own"))
    per_bucket = own.groupBy(*BUCKET).agg(F.sum("own").alias("n"))
    return own.join(per_bucket, BUCKET).select(*BUCKET, across, "n", "own", (F.col("n") - F.col("own")).alias("others"))


def comparisons(signed: DataFrame, across: str | None = None, bands: int = BANDS, rows: int = ROWS_PER_BAND, shared: DataFrame | None = None) -> DataFrame:
    """Per notice and shared bucket: the bucket's size and the notices it is compared with; ``shared`` are its ``shared_rows``."""
    held = shared_rows(signed, across, bands, rows) if shared is None else shared
    if across is None:
        return held.select("notice_id", *BUCKET, "n", (F.col("n") - 1).alias("others"))
    own = held.groupBy(*BUCKET, across).agg(F.count("*").alias("own"))
    return held.join(own, [*BUCKET, across]).select("notice_id", across, *BUCKET, "n", (F.col("n") - F.col("own")).alias("others"))


def bucket_crowds(signed: DataFrame, across: str | None = None, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """Per bucket: size, groups, and the comparisons it implies, each pair of notices counted once a bucket."""
    return crowds(signed, across, bands, rows, short_key).groupBy(*BUCKET).agg(
        F.max("n").alias("n"), F.count("*").alias("groups"), (F.sum(F.col("own") * F.col("others")) / 2).cast("bigint").alias("comparisons")
    )


def shared_by(pairs: DataFrame, signed: DataFrame, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """``id_a, id_b, band_id, bucket`` of every bucket that both ends of a pair are in, from their own bands."""
    side = lambda end: signed.select(F.col("notice_id").alias(f"id_{end}"), F.col("signature").alias(f"s_{end}"))
    met = pairs.select("id_a", "id_b").distinct().join(side("a"), "id_a").join(side("b"), "id_b")
    same = F.zip_with(band_slices(F.col("s_a"), bands, rows), band_slices(F.col("s_b"), bands, rows), lambda x, y: F.when(x == y, x))
    return met.select("id_a", "id_b", F.posexplode(same)).where("col is not null").select(
        "id_a", "id_b", F.col("pos").alias("band_id"), F.col("col").alias("bucket")
    )


def smallest_shared(
    pairs: DataFrame, signed: DataFrame, across: str | None = None, bands: int = BANDS, rows: int = ROWS_PER_BAND, shared: DataFrame | None = None
) -> DataFrame:
    """``pairs`` with ``min_bucket``: the size of the smallest bucket both ends are in, null if there is none or
    if both come from one portal.  Pairs meet the ``shared_rows`` of their ends, so no signature is shuffled."""
    ends = pairs.select("id_a", "id_b").distinct()
    if across:
        portal = lambda end: signed.select(F.col("notice_id").alias(f"id_{end}"), F.col(across).alias(f"p_{end}"))
        ends = ends.join(portal("a"), "id_a").join(portal("b"), "id_b").where("p_a <> p_b").select("id_a", "id_b")
    held = shared_rows(signed, None, bands, rows) if shared is None else shared
    side = lambda end, *more: held.select(F.col("notice_id").alias(f"id_{end}"), *BUCKET, *more)
    met = ends.join(side("a", "n"), "id_a").join(side("b"), ["id_b", *BUCKET])
    return pairs.join(met.groupBy("id_a", "id_b").agg(F.min("n").alias("min_bucket")), ["id_a", "id_b"], "left")


def bucket_sizes(signed: DataFrame, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """Per band: buckets, shared buckets, the largest one, and the comparisons they imply."""
    sizes = buckets(signed, bands, rows).groupBy(*BUCKET).agg(F.count("*").alias("n"))
    return sizes.groupBy("band_id").agg(
        F.count("*").alias("buckets"), F.count_if(F.col("n") > 1).alias("shared_buckets"),
        F.max("n").alias("largest"), F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("bigint").alias("comparisons"),
    )


def stored_members(signed: DataFrame, bands: int = BANDS, rows: int = ROWS_PER_BAND, keep: list[str] = ()) -> DataFrame:
    return materialise(shared_buckets(buckets(signed, bands, rows, keep)), "members")
