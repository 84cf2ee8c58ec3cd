"""Evaluation of scorers, signatures and banding over labelled pairs.

``scored`` tables hold ``id_a, id_b, is_same`` and one column per score.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.hashing import family, gram_hashes, minima
from ledgerloom.functions.similarity import ALPHA, inflection, rows_for_error, s_curve, standard_error
from ledgerloom.operators.banding import (
    BANDS, BUCKET, ROWS_PER_BAND, bucket_crowds, class_index, collide, comparisons, expand_probes, memberships, shared_rows, skipped, smallest_shared,
)
from ledgerloom.operators.matching import TAU, both_sides
from ledgerloom.operators.ordered import cumulative, folded_by_value, percentiles, union_all
from ledgerloom.operators.rooms import ROOM, compared
from ledgerloom.session import materialise

# Executors need no installed copy of this package: the few helpers travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the published experiments.
SIZES = (32, 64, 128, 256, 512)
# Beside the published sizes, some that are small enough to err across the threshold.
COARSE_SIZES = (4, 8, 16, *SIZES)
CONFIGS = ((8, 16), (16, 8), (32, 4), (64, 2))
RATIOS = (10, 50, 100, 200)
CAPS = (300, 250, 200, 150, 125, 100, 75, 50, 30, 20, 10)
CLASS_SHARES = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
WORK_SHARES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def _int(condition: Column) -> Column:
    return condition.cast("bigint")


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where there is nothing to divide by."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))


# ---- thresholds and curves ------------------------------------------------------------------


def sweep(scored: DataFrame, score: str) -> DataFrame:
    """Confusion counts and macro-F1 for every distinct score taken as the threshold (``>=``)."""
    rows = scored.select(F.col(score).alias("threshold"), _int(F.col("is_same")).alias("y"))
    folded = folded_by_value(rows, "threshold", {"pos": F.col("y"), "neg": 1 - F.col("y")})
    totals = folded.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    ran = cumulative(folded, "threshold", ["pos", "neg"])
    counts = ran.select(
        "threshold", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        (totals.select("p").scalar() - F.col("cum_pos")).alias("fn"),
        (totals.select("n").scalar() - F.col("cum_neg")).alias("tn"),
    )
    return counts.withColumns(rates())


def rates() -> dict[str, Column]:
    """Precision, recall and macro-F1 from ``tp, fp, fn, tn``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    same = _ratio(2 * tp, 2 * tp + fp + fn)
    different = _ratio(2 * tn, 2 * tn + fn + fp)
    return {
        "precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn), "macro_f1": (same + different) / 2,
    }


def best_threshold(scored: DataFrame, score: str) -> DataFrame:
    """Threshold with the best macro-F1 (the smallest among ties), and the margin between classes.

    When the classes do not overlap the chosen threshold is the middle of the gap.
    """
    top = F.max(F.struct("macro_f1", (-F.col("threshold")).alias("minus"))).alias("top")
    best = sweep(scored, score).agg(top).select((-F.col("top.minus")).alias("best_score"), F.col("top.macro_f1").alias("macro_f1"))
    margin = scored.agg(
        F.max(F.when(~F.col("is_same"), F.col(score))).alias("highest_different"),
        F.min(F.when(F.col("is_same"), F.col(score))).alias("lowest_same"),
    )
    low, high = margin.select("highest_different").scalar(), margin.select("lowest_same").scalar()
    return best.select(
        F.lit(score).alias("score"), "best_score", "macro_f1", low.alias("highest_different"), high.alias("lowest_same"),
    ).withColumn(
        "threshold",
        F.when(F.col("highest_different") < F.col("lowest_same"),
               (F.col("highest_different") + F.col("lowest_same")) / 2).otherwise(F.col("best_score")),
    )


def holdout_threshold(scored: DataFrame, score: str, parts: int = 2) -> DataFrame:
    """Thresholds judged on pairs they were not chosen on: each part of the pairs, split by pair hash,
    is judged with the best threshold of all the other parts."""
    digest = F.md5(F.concat_ws(":", F.col("id_a").cast("string"), F.col("id_b").cast("string")).cast("binary"))
    part = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % parts).cast("int")
    split = scored.withColumn("part", part)
    judged = []
    for held in range(parts):
        tau = best_threshold(split.where(F.col("part") != held), score).select("threshold").scalar()
        judged.append(confusion(split.where(F.col("part") == held), F.col(score) >= tau, ["part"]).withColumn("threshold", tau))
    return union_all(judged)


def confusion(pairs: DataFrame, predicted: Column, by: list[str] = ()) -> DataFrame:
    """TP, FP, FN, TN and the rates of a prediction."""
    same = F.col("is_same")
    counted = pairs.withColumn("said", predicted).groupBy(*by).agg(
        F.count_if(F.col("said") & same).alias("tp"), F.count_if(F.col("said") & ~same).alias("fp"),
        F.count_if(~F.col("said") & same).alias("fn"), F.count_if(~F.col("said") & ~same).alias("tn"),
    )
    return counted.withColumns(rates())


def curve_points(scored: DataFrame, score: str) -> DataFrame:
    """ROC and precision-recall points, one per distinct score."""
    ran = sweep(scored, score)
    return ran.select(
        "threshold", _ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
        F.col("recall").alias("tpr"), "precision",
    )


def roc_auc(scored: DataFrame, score: str) -> DataFrame:
    """Area under the ROC curve; a threshold's trapezoid needs only its own counts and totals."""
    p, n = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    slab = (F.col("neg") / n) * (2 * F.col("tp") - F.col("pos")) / (2 * p)
    return sweep(scored, score).agg(F.sum(slab).alias("roc_auc")).select(F.lit(score).alias("score"), "roc_auc")


def pr_auc(scored: DataFrame, score: str) -> DataFrame:
    """Area under the precision-recall points by trapezoids, from the point (recall 0, precision 1)."""
    tp_before, fp_before = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.when(tp_before + fp_before == 0, F.lit(1.0)).otherwise(
        _ratio(tp_before, tp_before + fp_before)
    )
    slab = (F.col("pos") / (F.col("tp") + F.col("fn"))) * (F.col("precision") + before) / 2
    return sweep(scored, score).agg(F.sum(slab).alias("pr_auc")).select(F.lit(score).alias("score"), "pr_auc")


def class_profile(scored: DataFrame, score: str) -> DataFrame:
    """Distribution of a score within each class, with the population deviation."""
    spread = scored.groupBy("is_same").agg(
        F.count("*").alias("pairs"), F.min(score).alias("min"), F.avg(score).alias("mean"), F.max(score).alias("max"),
        F.stddev_pop(score).alias("std"),
    )
    return spread.join(percentiles(scored, score, CLASS_SHARES, by=["is_same"]), "is_same").select(
        F.lit(score).alias("score"), "is_same", "pairs", "min", *CLASS_SHARES, "mean", "max", "std"
    )


def compare_on(scored: DataFrame, anchors: DataFrame, taus: dict[str, float]) -> DataFrame:
    """How each scorer judges given pairs at its threshold."""
    same = F.col("is_same")
    verdicts = []
    for score, tau in taus.items():
        said = F.col(score) >= tau
        verdicts.append(
            F.when(said & same, "TP").when(said, "FP").when(same, "FN").otherwise("TN").alias(f"{score}_verdict")
        )
    kept = scored.join(anchors.select("id_a", "id_b"), ["id_a", "id_b"], "left_semi")
    return kept.select("id_a", "id_b", "is_same", *taus, *verdicts)


# ---- signature sizes ------------------------------------------------------------------------


def estimates_by_size(pairs: DataFrame, worded: DataFrame, sizes: tuple[int, ...] = SIZES, alpha: float = ALPHA, room: int = ROOM) -> DataFrame:
    """Estimated composite similarity of each pair at several signature sizes.

    ``worded`` holds ``title_words`` and ``body_words``.  Signatures of the largest size are several times as long as the
    words they come from, so words meet in rooms, by the ids of the pairs' larger ends, and are hashed and signed there;
    smaller sizes are prefixes.
    """
    families = [family(field, max(sizes)) for field in ("title", "body")]

    def compare(rows: pa.Table) -> Callable:
        signed = []
        for column, n, own in (("title_words", T.TITLE_GRAM, families[0]), ("body_words", T.BODY_GRAM, families[1])):
            sets = gram_hashes(rows.column(column).to_pylist(), n)
            counts = np.array([len(s) for s in sets], dtype=np.int64)
            values = np.concatenate([*sets, np.empty(0, dtype=np.uint64)]).astype(np.uint64)
            signed.append(minima(values, np.cumsum(counts) - counts, counts, *own))

        def judge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
            found = np.empty((len(a), len(sizes)))
            equal = [np.cumsum(s[a] == s[b], axis=1, dtype=np.int64) for s in signed]
            filled = [np.maximum.accumulate(s != 0, axis=1) for s in signed]
            for at, k in enumerate(sizes):
                title, body = (np.where(f[a, k - 1] & f[b, k - 1], e[:, k - 1] / k, 0.0) for e, f in zip(equal, filled, strict=True))
                found[:, at] = alpha * title + (1.0 - alpha) * body
            return np.repeat(np.arange(len(a)), len(sizes)), {"k": np.tile(np.array(sizes, dtype=np.int32), len(a)), "estimate": found.ravel()}

        return judge

    return compared(pairs, worded, ["title_words", "body_words"], compare, "k int, estimate double", F.floor(F.col("id_b") / room))


def estimator_errors(estimates: DataFrame, tau: float = TAU) -> DataFrame:
    """Error of the estimate against the exact similarity per signature size, with theory beside it."""
    error = estimates.withColumn("error", F.abs(F.col("estimate") - F.col("similarity"))).withColumn(
        "agrees", (F.col("estimate") >= tau) == (F.col("similarity") >= tau)
    )
    error = materialise(error.select("k", "similarity", "error", "agrees"), "errors")
    summary = error.groupBy("k").agg(
        F.count("*").alias("pairs"), F.avg("error").alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.max("error").alias("max_error"), F.avg(_int(F.col("agrees")) * 100.0).alias("agreement_pct"),
        F.count_if(~F.col("agrees")).alias("disagreements"),
        F.avg(standard_error(F.col("similarity"), F.col("k"))).alias("mean_standard_error"),
    )
    shares = {"p50_error": 0.5, "p90_error": 0.9, "p99_error": 0.99}
    bound = F.lit(0.98) / F.sqrt("k")
    return summary.join(percentiles(error, "error", shares, by=["k"]), "k").withColumns(
        {"worst_case_bound": bound, "rows_for_bound": rows_for_error(bound - F.lit(1e-12)), "bytes_per_notice": F.col("k") * 16}
    )


def estimator_disagreements(estimates: DataFrame, tau: float = TAU) -> DataFrame:
    """Pairs the estimate puts on the other side of the threshold, with their distance to it."""
    wrong = (F.col("estimate") >= tau) != (F.col("similarity") >= tau)
    return estimates.where(wrong).select(
        "k", "id_a", "id_b", "is_same", "similarity", "estimate",
        (F.col("estimate") - F.col("similarity")).alias("error"),
        F.abs(F.col("similarity") - tau).alias("distance"),
    )


# ---- banding --------------------------------------------------------------------------------


def with_collisions(scored: DataFrame, signed: DataFrame, configs: tuple = CONFIGS) -> DataFrame:
    """One row per labelled pair and banding: whether the two signatures meet in a bucket."""
    joined = both_sides(scored, signed, ["signature"])
    a, b = F.col("signature_a"), F.col("signature_b")
    per_config = F.array(*[
        F.struct(F.lit(n).alias("bands"), F.lit(r).alias("rows"), collide(a, b, n, r).alias("retrieved"))
        for n, r in configs
    ])
    return materialise(joined.select(*scored.columns, F.inline(per_config)), "collisions")


def banding_grid(scored: DataFrame, signed: DataFrame, configs: tuple = CONFIGS) -> DataFrame:
    """Recall, work and buckets of each banding.

    ``comparisons`` count a pair once for every bucket it shares, and ``comparisons_pct`` sets them against all pairs of
    notices: over 100 the banding does more than comparing everything would.
    """
    hits = with_collisions(scored, signed, configs)
    judged = hits.groupBy("bands", "rows").agg(
        F.count_if(F.col("retrieved") & F.col("is_same")).alias("tp"),
        F.count_if(~F.col("retrieved") & F.col("is_same")).alias("fn"),
        F.count_if(F.col("retrieved")).alias("work_pairs"),
    )
    m = signed.agg(F.count("*").alias("m")).scalar()
    parts = [
        bucket_crowds(signed, None, n, r).agg(
            F.count("*").alias("total_buckets"), F.max("n").alias("largest_bucket"), F.sum("comparisons").alias("comparisons")
        ).select(F.lit(n).alias("bands"), F.lit(r).alias("rows"), "*")
        for n, r in configs
    ]
    possible = m * (m - 1) / 2
    return judged.join(union_all(parts), ["bands", "rows"]).select(
        "bands", "rows", inflection(F.col("bands"), F.col("rows")).alias("inflection"),
        (_ratio(F.col("tp"), F.col("tp") + F.col("fn")) * 100).alias("recall_pct"), "work_pairs",
        "total_buckets", "largest_bucket", "comparisons", (F.col("comparisons") / possible * 100).alias("comparisons_pct"),
    )


def retrieval_curve(scored: DataFrame, signed: DataFrame, configs: tuple = CONFIGS) -> DataFrame:
    """Share of pairs retrieved per similarity tenth against theory, for every banding.

    ``theory_score`` puts the bin's middle into the S-curve.  ``theory_fields`` averages the chance
    that follows from a band holding half title and half body rows.
    """
    hits = with_collisions(scored, signed, configs)
    half = F.col("rows") / 2
    field_chance = 1.0 - F.pow(1.0 - F.pow("title_sim", half) * F.pow("body_sim", half), F.col("bands"))
    tenth = F.least(F.floor(F.col("similarity") * 10), F.lit(9)).cast("int")
    seen = hits.groupBy("bands", "rows", tenth.alias("bin")).agg(
        F.count("*").alias("pairs"), F.avg(_int(F.col("retrieved")).cast("double")).alias("retrieved_share"),
        F.avg(field_chance).alias("theory_fields"),
    )
    grid = hits.select("bands", "rows").distinct().select(
        "bands", "rows", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bin")
    )
    middle = (F.col("bin") + 0.5) / 10
    return grid.join(seen, ["bands", "rows", "bin"], "left").select(
        "bands", "rows", "bin", F.coalesce("pairs", F.lit(0)).alias("pairs"), "retrieved_share",
        s_curve(middle, F.col("bands"), F.col("rows")).alias("theory_score"), "theory_fields",
    )


def cost_table(hits: DataFrame, by: list[str], tau: float = TAU, ratios: tuple[int, ...] = RATIOS) -> DataFrame:
    """Cost ``R * FP + FN`` of retrieving, and of retrieving and then verifying, per ratio R."""
    stages = F.array(
        F.struct(F.lit("candidate").alias("stage"), F.col("retrieved").alias("said")),
        F.struct(F.lit("merged").alias("stage"), (F.col("retrieved") & (F.col("similarity") >= tau)).alias("said")),
    )
    long = hits.select(*by, "is_same", F.inline(stages))
    counted = confusion(long, F.col("said"), [*by, "stage"])
    return counted.select(*by, "stage", "tp", "fp", "fn", "tn", F.explode(F.array(*[F.lit(r) for r in ratios])).alias("ratio")).withColumn(
        "cost", F.col("ratio") * F.col("fp") + F.col("fn")
    )


def candidate_recall(
    labelled: DataFrame, signed: DataFrame, across: str | None = "portal_id", bands: int = BANDS, rows: int = ROWS_PER_BAND, shared: DataFrame | None = None
) -> DataFrame:
    """Share of the labelled duplicates that meet in some bucket, whatever its size."""
    met = smallest_shared(labelled.where("is_same").select("id_a", "id_b"), signed, across, bands, rows, shared)
    return met.agg(F.count("*").alias("duplicates"), F.count("min_bucket").alias("found")).withColumn(
        "recall_pct", _ratio(F.col("found"), F.col("duplicates")) * 100
    )


# ---- work and skew --------------------------------------------------------------------------


def work_per_notice(
    signed: DataFrame, across: str | None = "portal_id", caps: tuple[int, ...] = (0,), bands: int = BANDS, rows: int = ROWS_PER_BAND,
    shared: DataFrame | None = None,
) -> DataFrame:
    """``cap, notice_id, portal_id, work``: comparisons of each notice in buckets up to a cap (0: all), zeros included.

    A pair that shares several buckets is compared in each.  One pass serves all caps.
    """
    met = comparisons(signed, across, bands, rows, shared)
    sums = met.groupBy("notice_id").agg(*[
        F.sum("others" if cap == 0 else F.when(F.col("n") <= cap, F.col("others"))).alias(f"w{cap}") for cap in caps
    ])
    levels = F.inline(F.array(*[F.struct(F.lit(cap).alias("cap"), F.coalesce(f"w{cap}", F.lit(0)).alias("work")) for cap in caps]))
    return signed.select("notice_id", "portal_id").join(sums, "notice_id", "left").select("notice_id", "portal_id", levels)


def partner_estimates(
    signed: DataFrame, across: str | None = "portal_id", precision: int = 12, bands: int = BANDS, rows: int = ROWS_PER_BAND, shared: DataFrame | None = None
) -> DataFrame:
    """``notice_id, partners_estimate``: about how many distinct notices each one is compared with, whatever its buckets hold.

    Each bucket has a HyperLogLog sketch of its members; a wording's sketches are merged over its buckets, so a pair that
    shares many buckets counts once.  With ``across`` the same is done for the members from each portal, and a
    notice's own portal is taken off.  A sketch has ``2 ** precision`` registers at most, and the relative standard
    error of what it counts is 1.04 over the root of that.
    """
    crowd = shared_rows(signed, across, bands, rows) if shared is None else shared
    keys = class_index(signed, bands, rows, crowd)

    def merged(by: list[str], name: str) -> DataFrame:
        sketches = crowd.groupBy(*BUCKET, *by).agg(F.hll_sketch_agg("notice_id", F.lit(precision)).alias("sketch"))
        return keys.join(sketches, BUCKET).groupBy("representative", *by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))

    ids = memberships(signed).join(merged([], "met"), "representative", "left")
    if not across:
        return ids.select("notice_id", F.greatest(F.coalesce("met", F.lit(1)) - 1, F.lit(0)).alias("partners_estimate"))
    ids = ids.join(signed.select("notice_id", across), "notice_id").join(merged([across], "same"), ["representative", across], "left")
    return ids.select("notice_id", F.greatest(F.coalesce("met", F.lit(0)) - F.coalesce("same", F.lit(0)), F.lit(0)).alias("partners_estimate"))


def partner_degrees(signed: DataFrame, asked: DataFrame, across: str = "portal_id", precision: int = 12) -> DataFrame:
    """For the ``probe_id`` of ``asked``: comparisons, distinct partners from other portals, counted, and their estimate."""
    shared = shared_rows(signed, across)
    members = materialise(memberships(signed), "memberships")
    sized = members.join(signed.select("notice_id", across), "notice_id").groupBy("representative", across).agg(F.count("*").alias("copies"))
    met = expand_probes(materialise(class_index(signed, shared=shared), "class-index"), members, asked)
    portal = signed.select(F.col("notice_id").alias("probe_id"), F.col(across).alias("own"))
    counted = met.join(portal, "probe_id").join(sized, "representative").where(F.col("own") != F.col(across)).groupBy("probe_id").agg(F.sum("copies").alias("partners"))
    work = work_per_notice(signed, across, shared=shared).select(F.col("notice_id").alias("probe_id"), F.col("work").alias("comparisons"))
    guessed = partner_estimates(signed, across, precision, shared=shared).withColumnRenamed("notice_id", "probe_id")
    return asked.select("probe_id").distinct().join(work, "probe_id").join(counted, "probe_id", "left").join(guessed, "probe_id").select(
        "probe_id", "comparisons", F.coalesce("partners", F.lit(0)).alias("partners"), "partners_estimate"
    )


def work_distribution(work: DataFrame, by: list[str] = ()) -> DataFrame:
    spread = work.groupBy(*by).agg(
        F.count("*").alias("notices"), (F.sum("work") / 2).cast("bigint").alias("comparisons"), F.max("work").alias("max_work")
    )
    shares = percentiles(work, "work", WORK_SHARES, by)
    if by:
        return spread.join(shares, list(by))
    return spread.select("*", *[shares.select(name).scalar().alias(name) for name in WORK_SHARES])


def most_expensive(work: DataFrame, n: int = 20) -> DataFrame:
    """The notices with the most comparisons; ties go to the smaller id."""
    from pyspark.sql import Window as W

    top = work.orderBy(F.desc("work"), "notice_id").limit(n)
    return top.select(
        F.row_number().over(W.orderBy(F.desc("work"), "notice_id")).alias("rank"), "notice_id", "portal_id", "work"
    )


def portal_workload(work: DataFrame) -> DataFrame:
    """Work per portal with its share of all work."""
    per = work.groupBy("portal_id").agg(
        F.count("*").alias("notices"), F.sum("work").alias("total_work"), F.avg("work").alias("avg_work"),
        F.max("work").alias("max_work"),
    )
    total = work.agg(F.sum("work").alias("t")).scalar()
    return per.withColumn("share_pct", _ratio(F.col("total_work"), total) * 100)


def concentration(work: DataFrame, group: list[str]) -> DataFrame:
    """Share of notices and of work held by a named group of portals, by the top portal, and others."""
    per = materialise(portal_workload(work), "portal-work")
    top = per.orderBy(F.desc("total_work"), "portal_id").limit(1).select("portal_id")
    named = per.select(
        F.explode(F.array(
            F.when(F.col("portal_id").isin(group), F.lit("group")).otherwise(F.lit("others")),
            F.when(F.col("portal_id") == top.scalar(), F.lit("top portal")),
        )).alias("part"), "notices", "total_work", "share_pct",
    ).where("part is not null")
    return named.groupBy("part").agg(
        F.sum("notices").alias("notices"), F.sum("total_work").alias("total_work"), F.sum("share_pct").alias("share_pct")
    )


def cap_sweep(signed: DataFrame, labelled: DataFrame, caps: tuple[int, ...] = CAPS, across: str | None = "portal_id") -> DataFrame:
    """Work, recall, and what is skipped under each bucket cap, and under none (``cap`` 0); all from bucket sizes."""
    every = (0, *caps)
    shared = shared_rows(signed, across)
    work = work_distribution(materialise(work_per_notice(signed, across, every, shared=shared), "work"), ["cap"])
    met = smallest_shared(labelled.where("is_same").select("id_a", "id_b"), signed, across, shared=shared)
    levels = F.explode(F.array(*[F.lit(c) for c in every])).alias("cap")
    found = met.select(levels, "min_bucket").groupBy("cap").agg(
        F.count("*").alias("duplicates"), F.count_if(F.col("min_bucket").isNotNull() & ((F.col("cap") == 0) | (F.col("min_bucket") <= F.col("cap")))).alias("found"),
    )
    return work.join(found, "cap").join(skipped(signed, every, across), "cap").withColumn("recall_pct", _ratio(F.col("found"), F.col("duplicates")) * 100)


def retrieval_summary(
    name: str, signed: DataFrame, labelled: DataFrame, across: str | None, bands: int = BANDS, rows: int = ROWS_PER_BAND, shared: DataFrame | None = None
) -> DataFrame:
    """One row on a retrieval variant: comparisons, recall and the spread of work."""
    work = work_distribution(work_per_notice(signed, across, (0,), bands, rows, shared))
    recall = candidate_recall(labelled, signed, across, bands, rows, shared)
    return work.select(F.lit(name).alias("variant"), "*", *[recall.select(c).scalar().alias(c) for c in ("duplicates", "found", "recall_pct")])


def before_after(before: DataFrame, after: DataFrame, measures: list[str]) -> DataFrame:
    """Measures of two one-row summaries side by side with the change in per cent."""
    def long(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], measures, "measure", name)

    return long(before, "before").join(long(after, "after"), "measure").withColumn(
        "change_pct", F.when(F.col("before") != 0, (F.col("after") - F.col("before")) / F.col("before") * 100)
    )
