"""Two-stage verification of candidate pairs, the links between all of them, and those that clustering needs.

``links`` returns every verified link between different wordings, whatever the size of the buckets they share.
``linked`` finds enough of them to cluster *all* notices exactly, without listing all pairs of a bucket:

1. notices with the same words are one representative; how its copies link follows from its portals;
2. in every bucket each member is compared with the bucket's smallest member;
3. what is then still in different clusters is paired in full in buckets of up to ``cap`` representatives;
4. in a larger one every member is compared with members drawn by hash, as long as this joins anything, and what is still
   in different clusters then meets in a similarity join (``similarity_join``), which loses no link.

Representatives are rows of the signed table: only ids and portals of them are stored, and each step reads the columns
it needs, so sets are shuffled for verification alone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import ALPHA, composite, jaccard, matching_rows
from ledgerloom.operators.banding import BANDS, BUCKET, PAIRED_BUCKET, ROWS_PER_BAND, buckets, collide, copies_of, hashed_key, pairs_within, shared_buckets
from ledgerloom.operators.components import min_labels
from ledgerloom.operators.rooms import Compare, compared, held_by, jaccard_of, lists
from ledgerloom.operators.similarity_join import agreeing, similar
from ledgerloom.operators.signatures import reachable
from ledgerloom.session import materialise

# Executors need no installed copy of this package: the few helpers travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The published thresholds of the two stages.
SCREEN, TAU = 0.45, 0.6028
# Rounds in which members drawn by hash are compared with their buckets.
PIVOTS = 4


def both_sides(pairs: DataFrame, attributes: DataFrame, columns: list[str], key: str = "notice_id") -> DataFrame:
    """Attach ``columns`` of both ends to a pair table as ``<column>_a`` and ``<column>_b``."""
    def side(letter: str) -> DataFrame:
        return attributes.select(
            F.col(key).alias(f"id_{letter}"), *[F.col(c).alias(f"{c}_{letter}") for c in columns]
        )

    return pairs.join(side("a"), "id_a").join(side("b"), "id_b")


def signature_score() -> Column:
    """Share of equal signature rows; unlike the estimate, two empty fields count as equal."""
    return matching_rows(F.col("signature_a"), F.col("signature_b")) / F.size("signature_a")


def screen(pairs: DataFrame, signed: DataFrame, threshold: float = SCREEN, met: tuple[int, int] | None = None) -> DataFrame:
    """Pairs whose signatures agree in at least ``threshold`` of their rows, and with ``met``, bands and rows, in a bucket."""
    scored = both_sides(pairs, signed, ["signature"]).withColumn("screen_score", signature_score())
    passed = F.col("screen_score") >= threshold
    if met:
        passed = F.when(passed, collide(F.col("signature_a"), F.col("signature_b"), *met)).otherwise(F.lit(False))
    return scored.where(passed).select(*pairs.columns, "screen_score")


def exact_scores(pairs: DataFrame, signed: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Add the exact title, body and composite similarity to pairs."""
    joined = both_sides(pairs, signed, ["title_set", "body_set"])
    return joined.select(
        *pairs.columns,
        jaccard(F.col("title_set_a"), F.col("title_set_b")).alias("title_sim"),
        jaccard(F.col("body_set_a"), F.col("body_set_b")).alias("body_sim"),
    ).withColumn("similarity", composite(F.col("title_sim"), F.col("body_sim"), alpha))


def verify(pairs: DataFrame, signed: DataFrame, tau: float = TAU, alpha: float = ALPHA) -> DataFrame:
    """Pairs whose exact composite similarity is at least ``tau``."""
    return exact_scores(pairs, signed, alpha).where(F.col("similarity") >= tau)


def _ends(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The rows of both ends of some pairs, so that sides are joined to these and not to all notices."""
    ids = pairs.select(F.col("id_a").alias("notice_id")).unionByName(pairs.select(F.col("id_b").alias("notice_id"))).distinct()
    return held_by(signed, ids).join(ids, "notice_id", "left_semi")


def confirmed(pairs: DataFrame, signed: DataFrame, screen_at: float, tau: float, alpha: float, met: tuple[int, int] | None = None) -> DataFrame:
    """Ends of the pairs that pass both stages; what passed the first is stored, so that a join knows how few rows there are
    before it would shuffle sets, and only sets of these are shuffled."""
    passed = materialise(screen(pairs, _ends(pairs, signed), screen_at, met).select("id_a", "id_b"), "passed")
    return verify(passed, _ends(passed, signed), tau, alpha).select("id_a", "id_b")


def wordings_of(signed: DataFrame) -> DataFrame:
    """One row per distinct wording: its smallest notice, its number of copies and its outermost portals."""
    return materialise(copies_of(signed).select(F.col("rep_id").alias("notice_id"), "copies", "first_portal", "last_portal"), "wordings")


def portals_differ() -> Column:
    """Whether some copy of one side and some copy of the other come from different portals."""
    return ~(
        (F.col("first_portal_a") == F.col("last_portal_a"))
        & (F.col("first_portal_b") == F.col("last_portal_b"))
        & (F.col("first_portal_a") == F.col("first_portal_b"))
    )


def _allowed(pairs: DataFrame, reps: DataFrame, across: bool) -> DataFrame:
    if not across:
        return pairs
    sides = both_sides(pairs, reps, ["first_portal", "last_portal"])
    return sides.where(portals_differ()).select("id_a", "id_b")


def _in_rooms(pairs: DataFrame, signed: DataFrame, wordings: DataFrame, columns: list[str], compare: Compare, added: str) -> DataFrame:
    """Pairs of wordings compared where their rows meet; rows that are in no pair are not shuffled."""
    pairs = materialise(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("id_a", "id_b")).alias("notice_id"))
    reps = held_by(signed, ends).select("notice_id", *columns).join(wordings.select("notice_id"), "notice_id")
    return compared(pairs, reps, columns, compare, added)


def _members(signed: DataFrame, wordings: DataFrame, bands: int, rows: int, cap: int) -> tuple[DataFrame, DataFrame]:
    """Wordings in buckets of two or more, told apart by a hash of their values; pairs from them are held against the values
    by the screen.  Buckets of one notice go first, by ids and hashes alone, so signatures are not shuffled here."""
    held = materialise(shared_buckets(hashed_key(buckets(signed, bands, rows))).drop("bucket_size"), "shared")
    members = materialise(shared_buckets(held.join(wordings.select("notice_id"), "notice_id", "left_semi")), "members")
    return members.where(F.col("bucket_size") <= cap), members.where(F.col("bucket_size") > cap)


def _of(signed: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of some members of buckets."""
    return held_by(signed, members).join(members.select("notice_id").distinct(), "notice_id", "left_semi")


def _screening(threshold: float, bands: int, rows: int) -> Compare:
    """``screen`` with ``met``, for pairs whose signatures are in one room."""
    def compare(held: pa.Table) -> Callable:
        values, _, counts = lists(held.column("signature"))
        signatures = values.reshape(len(counts), -1)

        def judge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
            equal = signatures[a] == signatures[b]
            score = equal.sum(axis=1) / signatures.shape[1]
            met = equal[:, : bands * rows].reshape(len(a), bands, rows).all(axis=2).any(axis=1)
            kept = np.flatnonzero((score >= threshold) & met)
            return kept, {"screen_score": score[kept]}

        return judge

    return compare


def _verifying(tau: float, alpha: float) -> Compare:
    """``verify`` for pairs whose sets are in one room."""
    def compare(held: pa.Table) -> Callable:
        titles, bodies = jaccard_of(held, "title_set"), jaccard_of(held, "body_set")

        def judge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
            title, body = titles(a, b), bodies(a, b)
            similarity = alpha * title + (1.0 - alpha) * body
            kept = np.flatnonzero(similarity >= tau)
            return kept, {"title_sim": title[kept], "body_sim": body[kept], "similarity": similarity[kept]}

        return judge

    return compare


def screened(signed: DataFrame, cap: int = PAIRED_BUCKET, screen_at: float = SCREEN, across: bool = True, bands: int = BANDS, rows: int = ROWS_PER_BAND) -> DataFrame:
    """``id_a, id_b, screen_score`` of all representatives that share a bucket of any size and pass the screen.

    Buckets over ``cap`` are not paired: their members meet through the rarest rows of their signatures, of which two
    that pass the screen share one.  Signatures of pairs meet in rooms.
    """
    wordings = wordings_of(signed)
    small, large = _members(signed, wordings, bands, rows, cap)
    pairs = pairs_within(small)
    if not large.isEmpty():
        crowd = _of(signed, large).select("notice_id", "signature")
        pairs = pairs.unionByName(agreeing(crowd, bands * rows, screen_at)).distinct()
    pairs = _allowed(pairs, signed.select("notice_id").join(wordings, "notice_id"), across)
    return _in_rooms(pairs, signed, wordings, ["signature"], _screening(screen_at, bands, rows), "screen_score double")


def links(
    signed: DataFrame, cap: int = PAIRED_BUCKET, screen_at: float = SCREEN, tau: float = TAU, alpha: float = ALPHA,
    across: bool = True, bands: int = BANDS, rows: int = ROWS_PER_BAND, passed: DataFrame | None = None,
) -> DataFrame:
    """``id_a, id_b, title_sim, body_sim, similarity`` of all verified links between representatives.

    Every pair of wordings that shares a bucket, whatever its size, passes the screen and reaches ``tau`` is there;
    copies of a wording are its members (``banding.memberships``).  Members of buckets over ``cap`` meet in a similarity
    join instead of in full.  ``passed`` are the pairs that ``screened`` returned for the same notices, where they are known.
    """
    within = signed.where(reachable(alpha) >= tau)
    wordings = wordings_of(within)
    if passed is None:
        small, large = _members(within, wordings, bands, rows, cap)
        pairs = pairs_within(small)
        if not large.isEmpty():
            crowd = _of(within, large).select("notice_id", "title_set", "body_set")
            pairs = pairs.unionByName(similar(crowd, tau, alpha)).distinct()
        pairs = _allowed(pairs, within.select("notice_id").join(wordings, "notice_id"), across)
        passed = _in_rooms(pairs, within, wordings, ["signature"], _screening(screen_at, bands, rows), "screen_score double")
    else:
        for end in ("id_a", "id_b"):
            passed = passed.join(wordings.select(F.col("notice_id").alias(end)), end, "left_semi")
    added = "title_sim double, body_sim double, similarity double"
    return _in_rooms(passed.select("id_a", "id_b"), within, wordings, ["title_set", "body_set"], _verifying(tau, alpha), added)


def linked(
    signed: DataFrame, cap: int = PAIRED_BUCKET, screen_at: float = SCREEN, tau: float = TAU, alpha: float = ALPHA,
    across: bool = True, bands: int = BANDS, rows: int = ROWS_PER_BAND,
    seeds: DataFrame | None = None, fresh: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Representatives and verified links between them, sufficient for exact clusters.

    ``seeds`` are links known beforehand.  ``fresh`` restricts new links to those with at least one
    end in it (a table of ``notice_id``), as an incremental run needs; then only the buckets of such notices count.
    """
    within = signed.where(reachable(alpha) >= tau)
    wordings = copies_of(within).select(F.col("rep_id").alias("notice_id"), "copies", "first_portal", "last_portal")
    new = fresh.select("notice_id").distinct().withColumn("is_fresh", F.lit(True)) if fresh is not None else None
    wordings = materialise(wordings.withColumn("is_fresh", F.lit(True)) if new is None else wordings.join(new, "notice_id", "left"), "wordings")
    reps = within.drop("portal_id").join(wordings, "notice_id")
    # buckets of one notice go first, by ids and hashes alone, so signatures are not shuffled here
    held = materialise(shared_buckets(hashed_key(buckets(within, bands, rows))).drop("bucket_size"), "shared")
    banded = materialise(held.join(wordings.select("notice_id", "is_fresh"), "notice_id"), "banded")
    sizes = banded.groupBy(*BUCKET).agg(F.count("*").alias("bucket_size"), F.count("is_fresh").alias("fresh")).where("bucket_size > 1 AND fresh > 0")
    members = materialise(banded.drop("is_fresh").join(sizes.drop("fresh"), BUCKET), "members")
    small, large = members.where(F.col("bucket_size") <= cap), members.where(F.col("bucket_size") > cap)

    def keep_fresh(found: DataFrame) -> DataFrame:
        if fresh is None:
            return found
        ends = fresh.select("notice_id").distinct()
        a = found.join(ends.withColumnRenamed("notice_id", "id_a"), "id_a", "left_semi")
        b = found.join(ends.withColumnRenamed("notice_id", "id_b"), "id_b", "left_semi")
        return a.unionByName(b).distinct()

    def checked(found: DataFrame) -> DataFrame:
        pairs = materialise(_allowed(keep_fresh(found), wordings, across), "met")
        return materialise(confirmed(pairs, signed, screen_at, tau, alpha, (bands, rows)), "links")

    def still_open(rows: DataFrame, joined: DataFrame) -> DataFrame:
        """Rows of the buckets that hold more than one cluster of ``joined``, with their cluster as ``label``."""
        labels = min_labels(joined).select("notice_id", "label")
        labelled = rows.join(labels, "notice_id", "left").withColumn("label", F.coalesce("label", "notice_id"))
        split = labelled.groupBy(*BUCKET).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
        return materialise(labelled.join(split.select(*BUCKET), BUCKET, "left_semi"), "open")

    def against_drawn(open_rows: DataFrame, turn: int) -> DataFrame:
        """Each row with a member of its bucket drawn by hash, where they are in different clusters."""
        heads = open_rows.groupBy(*BUCKET).agg(F.min_by(F.struct("notice_id", "label"), F.xxhash64("notice_id", F.lit(turn))).alias("head"))
        pairs = open_rows.join(heads, BUCKET).where(F.col("label") != F.col("head.label"))
        return checked(pairs.select(F.least("notice_id", "head.notice_id").alias("id_a"), F.greatest("notice_id", "head.notice_id").alias("id_b")).distinct())

    heads = members.groupBy(*BUCKET).agg(F.min("notice_id").alias("id_a"))
    found = checked(members.join(heads, BUCKET).where("notice_id <> id_a").select("id_a", F.col("notice_id").alias("id_b")).distinct())
    # Seeds say nothing about links of a wording that has new copies, so what is small is only spared by links found.
    open_rows = still_open(small, found)
    if not open_rows.isEmpty():
        found = found.unionByName(checked(pairs_within(open_rows, "label"))).distinct()
    if large.isEmpty():
        return reps, materialise(found, "links")
    known = seeds.select("id_a", "id_b") if seeds is not None else found.limit(0)
    for turn in range(PIVOTS + 1):
        open_rows = still_open(large, found.unionByName(known))
        if turn == PIVOTS or open_rows.isEmpty():
            break
        more = against_drawn(open_rows, turn)
        if more.isEmpty():
            break
        found = found.unionByName(more)
    if open_rows.isEmpty():
        return reps, materialise(found.distinct(), "links")
    rest = held_by(reps, open_rows).join(open_rows.select("notice_id", "label").distinct(), "notice_id").select("notice_id", "title_set", "body_set", "label")
    apart = similar(rest, tau, alpha)
    return reps, materialise(found.unionByName(checked(apart)).distinct(), "links")
