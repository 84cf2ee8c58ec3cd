"""Named queries over notices: text, signatures, candidates, cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import parsing
from ledgerloom.functions import text as T
from ledgerloom.functions.similarity import composite, estimated_jaccard
from ledgerloom.operators import banding, cards, matching, profile
from ledgerloom.operators.ordered import union_all
from ledgerloom.operators.signatures import hashed, raw_shingles, shingle_columns, signed, with_signatures
from ledgerloom.plans import notice_inputs as N
from ledgerloom.plans.retail import Query
from ledgerloom.session import materialise, scratch_path, spread
from ledgerloom.sources import tables as S
from ledgerloom.streaming import arrivals

NIGHT_SECONDS = 1200.0


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    title, body = T.clean_title(F.col("title")), T.strip_blanks(T.clean_body(F.col("body")))
    return spread(S.notices(spark, sf_dir)).select(
        "notice_id", title.alias("clean_title"), F.length(body).alias("body_chars"), F.md5(body).alias("body_md5")
    )


def _gram_summary(name: str, grams: str) -> list:
    joined = F.array_join(F.array_sort(grams), "|")
    return [F.size(grams).alias(f"{name}_grams"), F.md5(joined).alias(f"{name}_md5")]


def shingles_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    title, body = shingle_columns()
    rows = spread(S.notices(spark, sf_dir)).select("notice_id", title.alias("t"), body.alias("b"))
    return rows.select("notice_id", *_gram_summary("title", "t"), *_gram_summary("body", "b"))


def shingles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(S.notices(spark, sf_dir)).select("notice_id", raw_shingles().alias("g"))
    return rows.select("notice_id", *_gram_summary("raw", "g"))


def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_signatures(hashed(S.notices(spark, sf_dir)))
    text = F.array_join(F.col("signature").cast("array<string>"), ",")
    return rows.select(
        "notice_id", F.get("signature", F.lit(0)).alias("first_row"), F.get("signature", F.lit(127)).alias("last_row"),
        F.md5(text).alias("signature_md5"),
    )


def minhash_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = materialise(with_signatures(hashed(S.notices(spark, sf_dir)), 64, interleaved=False), "wide")
    pairs = matching.both_sides(N.pair_pool(sets), sets, ["title_sig", "body_sig"])
    title = estimated_jaccard(F.col("title_sig_a"), F.col("title_sig_b"))
    body = estimated_jaccard(F.col("body_sig_a"), F.col("body_sig_b"))
    return pairs.select("id_a", "id_b", title.alias("title_estimate"), body.alias("body_estimate")).withColumn(
        "estimate", composite(F.col("title_estimate"), F.col("body_estimate"))
    )


def jaccard_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.scored(spark, sf_dir, raw=True).select("id_a", "id_b", "is_same", "raw_similarity")


def jaccard_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.scored(spark, sf_dir).select("id_a", "id_b", "is_same", "title_sim", "body_sim", "similarity")


def lsh_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return banding.bucket_index(with_signatures(hashed(S.notices(spark, sf_dir))))


# Fixed value: the smallest size of the published sweep of stop-buckets.
LEAST_CAP = 10


def candidates_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared bucket of any size: its notices, wordings and portals, the comparisons it stands for, and the verified
    links between the wordings in it.  ``lsh_bands`` has the members, ``verify_pairs`` the links."""
    sets = N.signed_notices(spark, sf_dir)
    sized = banding.crowds(sets, "portal_id").where("n > 1").groupBy(*banding.BUCKET).agg(
        F.max("n").alias("notices"), F.count("*").alias("portals"), (F.sum(F.col("own") * F.col("others")) / 2).cast("bigint").alias("cross_portal")
    )
    wordings = banding.class_index(sets).groupBy(*banding.BUCKET).agg(F.count("*").alias("wordings"))
    linked = banding.shared_by(matching.links(sets), sets).groupBy(*banding.BUCKET).agg(F.count("*").alias("verified_links"))
    return sized.join(wordings, banding.BUCKET).join(linked, banding.BUCKET, "left").select(
        "band_id", banding.bucket_text(F.col("bucket")).alias("bucket_hash"), "notices", "wordings", "portals",
        (F.col("notices") * (F.col("notices") - 1) / 2).cast("bigint").alias("comparisons"), "cross_portal",
        F.coalesce("verified_links", F.lit(0)).cast("bigint").alias("verified_links"),
    )


def candidates_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return banding.capped_candidates(N.signed_notices(spark, sf_dir), LEAST_CAP)


def pair_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = N.signed_notices(spark, sf_dir)
    joined = matching.both_sides(N.pair_pool(sets), sets, ["signature"])
    return joined.select("id_a", "id_b", banding.collide(F.col("signature_a"), F.col("signature_b")).alias("collides"))


def stored_index(spark: SparkSession, sets: DataFrame) -> DataFrame:
    return banding.store_index(banding.bucket_index(sets), scratch_path(spark, "index"), int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of every bucket that a probe falls into; the probes are the notices whose id is divisible by 20."""
    index = stored_index(spark, N.signed_notices(spark, sf_dir))
    return banding.lookup(index, index.where(F.col("notice_id") % 20 == 0))


def probe_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``probe_id, candidate_id``: for every notice as a probe, the distinct other notices that it shares a bucket with."""
    sets = N.signatures(spark, sf_dir)
    index = materialise(banding.class_index(sets, shared=banding.shared_rows(sets)), "class-index")
    members = materialise(banding.memberships(sets), "memberships")
    met = banding.expand_probes(index, members, sets.select(F.col("notice_id").alias("probe_id")))
    return banding.candidate_notices(met, members)


def screen_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.screened(N.signatures(spark, sf_dir))


def verify_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.links(N.signed_notices(spark, sf_dir))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many notices, shingles, wordings, buckets, comparisons, links and cards each stage yields; nothing is left out.

    A comparison counts once a bucket that its notices share; screened and verified links are those between wordings.
    """
    sets = N.signed_notices(spark, sf_dir)
    screened = materialise(matching.screened(sets), "screened")
    verified = materialise(matching.links(sets, passed=screened), "verified")
    mapping = materialise(cards.card_map(sets), "map")
    sizes = mapping.groupBy("root_id").agg(F.count("*").alias("n"))
    crowds = materialise(banding.bucket_crowds(sets, "portal_id").agg(F.count("*").alias("buckets"), F.sum("comparisons").alias("comparisons")), "crowds")
    grams = sets.agg(F.sum(F.size("title_set") + F.size("body_set")))
    counts = [
        ("notices", sets.agg(F.count("*"))), ("shingles", grams), ("wordings", banding.copies_of(sets).agg(F.count("*"))),
        ("buckets", crowds.select("buckets")), ("comparisons", crowds.select("comparisons")),
        ("screened_links", screened.agg(F.count("*"))), ("verified_links", verified.agg(F.count("*"))),
        ("cards", sizes.agg(F.count("*"))), ("cards_with_duplicates", sizes.agg(F.count_if(F.col("n") > 1))),
    ]
    return union_all([
        df.toDF("row_count").select(F.lit(name).alias("stage"), F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))
        for name, df in counts
    ])


def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall time of each stage against a nightly budget of twenty minutes."""
    return profile.stage_timings(spark, {
        "hashed": lambda done: hashed(S.notices(spark, sf_dir)),
        "signed": lambda done: with_signatures(done["hashed"]),
        "index": lambda done: banding.bucket_index(done["signed"]),
        "screened": lambda done: matching.screened(done["signed"]),
        "verified": lambda done: matching.links(done["signed"], passed=done["screened"]),
        "cards": lambda done: cards.card_map(done["signed"]),
    }, NIGHT_SECONDS)


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.card_map(N.signed_notices(spark, sf_dir))


def card_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = S.notices(spark, sf_dir).select("notice_id", "portal_id", "title", "lang")
    return cards.cards(materialise(cards.card_map(N.signed_notices(spark, sf_dir)), "map"), notices)


def card_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = materialise(cards.card_map(N.signed_notices(spark, sf_dir)), "map")
    return cards.card_members(mapping)


def card_portals(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = materialise(cards.card_map(N.signed_notices(spark, sf_dir)), "map")
    return cards.card_portals(mapping)


def _base_and_arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All notices in two parts: those that have a quality label were there first, the others arrive."""
    notices = S.notices(spark, sf_dir)
    known = S.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("notice_id")).distinct()
    return notices.join(known, "notice_id", "left_semi"), notices.join(known, "notice_id", "left_anti")


def incremental_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of the labelled documents, then the other documents arriving in one batch."""
    base, late = _base_and_arrivals(spark, sf_dir)
    stored = signed(base)
    before = materialise(
        cards.card_map(stored).select("notice_id", cards.card_name(F.col("root_id")).alias("card_id")), "before"
    )
    arrived = signed(late)
    index = materialise(banding.hashed_key(banding.buckets(stored)).select("band_id", "bucket", "notice_id"), "index")
    met = materialise(cards.touched(index, arrived), "touched")
    mapped, _ = cards.arrive(
        materialise(stored.join(met, "notice_id", "left_semi"), "met"), before.join(met, "notice_id", "left_semi"), arrived
    )
    return before.select("notice_id", "card_id", F.lit(False).alias("arrived")).unionByName(
        mapped.select("notice_id", "card_id", F.lit(True).alias("arrived"))
    )


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two parts as files of a stream; the stream keeps the store up to date itself."""
    base, late = _base_and_arrivals(spark, sf_dir)
    folder = scratch_path(spark, "arrivals")
    store = arrivals.CardStore(spark, scratch_path(spark, "store"), slots=8)
    for part in (base, late):
        part.select("notice_id", "portal_id", "title", "body").write.mode("append").parquet(folder)
        arrivals.run_available(spark, folder, store)
    return store.card_map().select("notice_id", "card_id")


def in_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written inside documents, conversations and event days, normalised, with how often each occurs."""
    docs = S.table(spark, sf_dir, "documents").select("text")
    talk = S.table(spark, sf_dir, "conversations").select("text")
    events = S.table(spark, sf_dir, "events").select(F.date_format("ts", "dd.MM.yyyy").alias("text"))
    found = docs.unionByName(talk).unionByName(events).select(F.explode(parsing.date_mentions(F.col("text"))).alias("mention"))
    return found.select(parsing.parse_date(F.col("mention")).alias("day")).where("day is not null").groupBy("day").agg(
        F.count("*").alias("mentions")
    )


def in_text_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals written in the notations of the portals and read back, against the totals."""
    total = F.col("o_totalprice").cast("decimal(18,2)")
    orders = S.table(spark, sf_dir, "orders").select("o_orderkey", total.alias("total"))
    whole = F.floor("total").cast("string")
    written = F.array(
        F.struct(F.lit("plain").alias("notation"), F.col("total").cast("string").alias("written")),
        F.struct(F.lit("rupees").alias("notation"), F.concat(F.lit("Rs. "), F.format_number("total", 2)).alias("written")),
        F.struct(F.lit("lakh").alias("notation"), F.concat(F.lit("Rs. "), (F.col("total") / 100000).cast("decimal(30,7)").cast("string"), F.lit(" lakh")).alias("written")),
        F.struct(F.lit("crore").alias("notation"), F.concat(F.lit("INR "), (F.col("total") / 10000000).cast("decimal(30,9)").cast("string"), F.lit(" Cr")).alias("written")),
        F.struct(F.lit("words").alias("notation"), F.concat(F.lit("RUPEES "), whole, F.lit(" ONLY")).alias("written")),
    )
    read = orders.select("total", F.inline(written)).withColumn("value", parsing.parse_money(F.col("written")))
    return read.groupBy("notation").agg(
        F.count("*").alias("amounts"), F.count_if(F.col("value") == F.col("total")).alias("exact"),
        F.sum("value").cast("decimal(24,2)").alias("value_sum"),
    )


QUERIES: dict[str, Query] = {
    "profile_nulls": lambda s, d: profile.null_audit(S.notices(s, d)),
    "profile_unique": lambda s, d: profile.uniqueness(S.table(s, d, "documents"), "doc_id", "text", "source"),
    "profile_lengths": lambda s, d: profile.text_lengths(S.notices(s, d)),
    "profile_length_sketches": lambda s, d: profile.sketch_check(S.notices(s, d), profile.length_measures(), "portal_id"),
    "source_share": lambda s, d: profile.frequency_share(S.notices(s, d), "portal_id"),
    "common_prefix": lambda s, d: profile.shared_openings(S.notices(s, d)),
    "attr_agreement": lambda s, d: profile.agreement_by_label(N.scored(s, d), S.notices(s, d), ["lang", "portal_id", "n_chars"]),
    "clean_text": clean_text,
    "in_text_dates": in_text_dates,
    "in_text_money": in_text_money,
    "shingles_raw": shingles_raw,
    "shingles_clean": shingles_clean,
    "jaccard_raw": jaccard_raw,
    "jaccard_composite": jaccard_composite,
    "minhash_signature": minhash_signature,
    "minhash_estimate": minhash_estimate,
    "lsh_bands": lsh_bands,
    "bucket_sizes": lambda s, d: banding.bucket_sizes(N.signed_notices(s, d)),
    "lsh_candidates_all": candidates_all,
    "lsh_candidates_capped": candidates_capped,
    "pair_collision": pair_collision,
    "bucket_lookup": bucket_lookup,
    "probe_expansion": probe_expansion,
    "class_membership": lambda s, d: banding.memberships(N.signed_notices(s, d)),
    "screen_pairs": screen_pairs,
    "verify_pairs": verify_pairs,
    "stage_counts": stage_counts,
    "stage_timings": stage_timings,
    "components": components,
    "cards": card_list,
    "card_members": card_members,
    "card_portals": card_portals,
    "incremental_batch": incremental_batch,
    "incremental_stream": incremental_stream,
}
