"""Named evaluation queries: thresholds, curves, signature sizes, banding, work and skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import banding
from ledgerloom.operators import evaluation as E
from ledgerloom.operators.matching import TAU
from ledgerloom.operators.ordered import union_all
from ledgerloom.operators.signatures import worded
from ledgerloom.plans import notice_inputs as N
from ledgerloom.plans.retail import Query
from ledgerloom.session import materialise, spread
from ledgerloom.sources import tables as S

SCORES = ("raw_similarity", "similarity")
TAUS = {"raw_similarity": 0.4659, "similarity": TAU}
BIG_PORTALS = ["src0", "src1", "src2", "src3", "src4", "src5"]
MEASURES = ["comparisons", "max_work", "p50", "p90", "p95", "p99", "found", "recall_pct"]


def _each_score(operator) -> Query:  # noqa: ANN001
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = N.scored(spark, sf_dir, raw=True)
        return union_all([operator(pairs, score) for score in SCORES])

    return run


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.sweep(N.scored(spark, sf_dir), "similarity").drop("pos", "neg")


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = N.scored(spark, sf_dir, raw=True)
    return union_all([
        E.confusion(pairs, F.col(score) >= tau).select(F.lit(score).alias("score"), "*") for score, tau in TAUS.items()
    ])


def anchor_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two scorers on the pair of each class they disagree about most."""
    pairs = N.scored(spark, sf_dir, raw=True)
    gap = F.round(F.abs(F.col("raw_similarity") - F.col("similarity")), 9)
    anchors = pairs.groupBy("is_same").agg(
        F.max(F.struct(gap.alias("gap"), (-F.col("id_a")).alias("a"), (-F.col("id_b")).alias("b"))).alias("m")
    ).select((-F.col("m.a")).alias("id_a"), (-F.col("m.b")).alias("id_b"))
    return E.compare_on(pairs, anchors, TAUS)


def _estimates(spark: SparkSession, sf_dir: str, sizes: tuple[int, ...] = E.SIZES) -> DataFrame:
    return E.estimates_by_size(N.scored(spark, sf_dir), worded(spread(S.notices(spark, sf_dir))), sizes)


def _signed_and_scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sets = N.signed_notices(spark, sf_dir)
    return sets, N.scored(spark, sf_dir)


def banding_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, pairs = _signed_and_scored(spark, sf_dir)
    return E.banding_grid(pairs, sets)


def retrieval_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, pairs = _signed_and_scored(spark, sf_dir)
    return E.retrieval_curve(pairs, sets)


def cost_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, pairs = _signed_and_scored(spark, sf_dir)
    return E.cost_table(E.with_collisions(pairs, sets), ["bands", "rows"])


def cost_by_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost of three bucket caps over the labelled pairs."""
    sets, pairs = _signed_and_scored(spark, sf_dir)
    hits = banding.smallest_shared(pairs, sets, "portal_id").select(
        "is_same", "similarity", "min_bucket", F.explode(F.array(F.lit(10), F.lit(50), F.lit(150))).alias("cap")
    ).withColumn("retrieved", F.coalesce(F.col("min_bucket") <= F.col("cap"), F.lit(False)))
    return E.cost_table(hits, ["cap"])


def candidate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, pairs = _signed_and_scored(spark, sf_dir)
    return E.candidate_recall(pairs, sets)


def _work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(E.work_per_notice(N.signed_notices(spark, sf_dir)).drop("cap"), "work")


def label_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs, their classes, and whether every end is in the corpus."""
    pairs = N.scored(spark, sf_dir).select("id_a", "id_b", "is_same")
    ends = pairs.select(F.explode(F.array("id_a", "id_b")).alias("notice_id")).distinct()
    unknown = ends.join(S.notices(spark, sf_dir).select("notice_id"), "notice_id", "left_anti")
    return pairs.agg(
        F.count("*").alias("pairs"), F.count_if("is_same").alias("same"), F.count_if(~F.col("is_same")).alias("different")
    ).select(
        "*", (F.col("different") / F.col("same")).alias("imbalance"),
        ends.agg(F.count("*")).scalar().alias("notices"), unknown.agg(F.count("*")).scalar().alias("unknown_notices"),
    )


def cap_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, pairs = _signed_and_scored(spark, sf_dir)
    return E.cap_sweep(sets, pairs)


def _variants(spark: SparkSession, sf_dir: str, wanted: list[tuple[str, bool, str | None]]) -> list[DataFrame]:
    pairs = N.scored(spark, sf_dir)
    signed = {cleaned: N.signatures(spark, sf_dir, cleaned) for cleaned in (True, False)}
    shared = {cleaned: banding.shared_rows(sets, "portal_id") for cleaned, sets in signed.items()}
    return [E.retrieval_summary(name, signed[cleaned], pairs, across, shared=shared[cleaned]) for name, cleaned, across in wanted]


def mitigation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(_variants(spark, sf_dir, [
        ("raw, all pairs", False, None), ("clean, all pairs", True, None),
        ("raw, across portals", False, "portal_id"), ("clean, across portals", True, "portal_id"),
    ]))


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _variants(spark, sf_dir, [("before", False, None), ("after", True, "portal_id")])
    return E.before_after(materialise(before, "before"), materialise(after, "after"), MEASURES)


def quality_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text length as a score for the quality label: areas and best threshold on another target."""
    rows = S.table(spark, sf_dir, "documents").join(S.table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("n_chars").cast("double").alias("n_chars"), (F.col("quality") == 1).alias("is_same")
    )
    stored = materialise(rows, "labelled-docs")
    best = E.best_threshold(stored, "n_chars").select("score", "best_score", "macro_f1")
    return best.join(E.roc_auc(stored, "n_chars"), "score").join(E.pr_auc(stored, "n_chars"), "score")


def partner_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct partners of the notices whose id is divisible by 20, and whether sketches of all notices say about the same."""
    sets = N.signatures(spark, sf_dir)
    degrees = E.partner_degrees(sets, sets.where(F.col("notice_id") % 20 == 0).select(F.col("notice_id").alias("probe_id")))
    off = F.abs(F.col("partners_estimate") - F.col("partners"))
    # own and other portals are taken from one another, so the error is relative to both together
    return degrees.select("probe_id", "comparisons", "partners", (off <= 1 + 0.1 * F.greatest("partners", "comparisons")).alias("estimate_in_bounds"))


QUERIES: dict[str, Query] = {
    "label_check": label_check,
    "threshold_sweep": threshold_sweep,
    "best_threshold": _each_score(E.best_threshold),
    "holdout_threshold": _each_score(lambda p, s: E.holdout_threshold(p, s).select(F.lit(s).alias("score"), "*")),
    "confusion": confusion,
    "roc_auc": _each_score(E.roc_auc),
    "pr_auc": _each_score(E.pr_auc),
    "curve_points": lambda s, d: E.curve_points(N.scored(s, d, raw=True), "raw_similarity"),
    "quality_auc": quality_auc,
    "class_profile": _each_score(E.class_profile),
    "anchor_pairs": anchor_pairs,
    "estimator_error_by_k": lambda s, d: E.estimator_errors(_estimates(s, d)),
    "estimator_disagreements": lambda s, d: E.estimator_disagreements(_estimates(s, d, E.COARSE_SIZES)),
    "banding_grid": banding_grid,
    "retrieval_curve": retrieval_curve,
    "cost_table": cost_table,
    "cost_by_cap": cost_by_cap,
    "candidate_recall": candidate_recall,
    "partner_degree": partner_degree,
    "work_distribution": lambda s, d: E.work_distribution(_work(s, d)),
    "work_top20": lambda s, d: E.most_expensive(_work(s, d)),
    "source_workload": lambda s, d: E.portal_workload(_work(s, d)).orderBy(F.desc("total_work"), "portal_id").limit(15),
    "work_concentration": lambda s, d: E.concentration(_work(s, d), BIG_PORTALS),
    "cap_sweep": cap_sweep,
    "mitigation_matrix": mitigation_matrix,
    "before_after": before_after,
}
