"""The evaluation queries as plain SQL, to check results with another engine."""

from __future__ import annotations

from ledgerloom.operators.evaluation import CAPS, COARSE_SIZES, CONFIGS, RATIOS, SIZES
from ledgerloom.operators.matching import TAU
from ledgerloom.plans.notice_sql import _WORK, _bands, _q, _signatures

_RAW_TAU = 0.4659

_RATES = """
  round(case when tp + fp = 0 then 0 else tp / (tp + fp)::double end, 6) as precision,
  round(case when tp + fn = 0 then 0 else tp / (tp + fn)::double end, 6) as recall,
  round((case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn)::double end
    + case when 2 * tn + fn + fp = 0 then 0 else 2 * tn / (2 * tn + fn + fp)::double end) / 2, 6) as macro_f1"""


def _sweep(source: str, score: str, name: str) -> str:
    return f"""
{name}_v as (select {score} as threshold, count(*) filter (is_same) as pos, count(*) filter (not is_same) as neg from {source} group by 1),
{name}_c as (select *, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p, sum(neg) over () as n
  from {name}_v window w as (order by threshold desc rows unbounded preceding)),
{name} as (select threshold, pos, neg, p, n, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(p - tp as bigint) as fn, cast(n - fp as bigint) as tn,
  (case when 2 * tp + fp + p - tp = 0 then 0 else 2 * tp / (2 * tp + fp + p - tp)::double end
   + case when 2 * (n - fp) + p - tp + fp = 0 then 0 else 2 * (n - fp) / (2 * (n - fp) + p - tp + fp)::double end) / 2 as f1 from {name}_c)"""


_SWEEPS = _sweep("scored", "raw_similarity", "sw_raw") + "," + _sweep("scored", "similarity", "sw_comp")
_BOTH = (("raw_similarity", "sw_raw"), ("similarity", "sw_comp"))
_ROC = "round(sum((neg / n::double) * (2 * tp - pos) / (2 * p)::double), 6)"
_PR = """round(sum((pos / p::double) * (case when tp + fp = 0 then 0 else tp / (tp + fp)::double end
  + case when tp - pos + fp - neg = 0 then 1 else (tp - pos) / (tp - pos + fp - neg)::double end) / 2), 6)"""


def _best(score: str, sweep: str, source: str = "scored") -> str:
    return f"""
select '{score}' as score, round(b, 6) as best_score, round(f, 6) as macro_f1, round(lo, 6) as highest_different, round(hi, 6) as lowest_same,
  round(case when lo < hi then (lo + hi) / 2 else b end, 6) as threshold
from (select min(threshold) as b, max(f1) as f from {sweep} where f1 = (select max(f1) from {sweep})),
  (select max({score}) filter (not is_same) as lo, min({score}) filter (is_same) as hi from {source})"""


def _confusion(score: str, tau: float) -> str:
    return f"""
select '{score}' as score, tp, fp, fn, tn, {_RATES} from (
  select count(*) filter (s and is_same) as tp, count(*) filter (s and not is_same) as fp,
    count(*) filter (not s and is_same) as fn, count(*) filter (not s and not is_same) as tn
  from (select is_same, {score} >= {tau} as s from scored))"""


def _profile(score: str) -> str:
    q = ", ".join(f"round(quantile_cont({score}, {v}), 6) as {k}" for k, v in
                  {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}.items())
    return f"""
select '{score}' as score, is_same, count(*) as pairs, round(min({score}), 6) as min, {q}, round(avg({score}), 6) as mean,
  round(max({score}), 6) as max, round(stddev_pop({score}), 6) as std from scored group by is_same"""


def _held(score: str, short: str, part: int) -> str:
    """The part's pairs judged with the threshold of the other part."""
    return f"""
select '{score}' as score, {part} as part, tp, fp, fn, tn, {_RATES}, round(threshold, 6) as threshold from (
  select threshold, count(*) filter ({score} >= threshold and is_same) as tp, count(*) filter ({score} >= threshold and not is_same) as fp,
    count(*) filter ({score} < threshold and is_same) as fn, count(*) filter ({score} < threshold and not is_same) as tn
  from parted, (select case when lo < hi then (lo + hi) / 2 else b end as threshold
    from (select min(threshold) as b from h{part}_{short} where f1 = (select max(f1) from h{part}_{short})),
      (select max({score}) filter (not is_same) as lo, min({score}) filter (is_same) as hi from others{part}))
  where part = {part} group by threshold)"""


_PARTED = """
parted as materialized (select *, (('0x' || substr(md5(id_a || ':' || id_b), 1, 8))::bigint % 2)::int as part from scored),
others0 as (select * from parted where part <> 0), others1 as (select * from parted where part <> 1)"""
_HOLDOUT = _PARTED + "".join("," + _sweep(f"others{k}", score, f"h{k}_{short}") for k in (0, 1) for score, short in (("raw_similarity", "raw"), ("similarity", "comp")))

_GRIDS = ",".join(_bands("sigs", f"g{b}", b, r) for b, r in CONFIGS)
_HITS = _GRIDS + ",\nhits as materialized (" + " union all ".join(
    f"""select s.*, {b} as bands, {r} as rows, exists (select 1 from g{b} x join g{b} y using (band_id, bucket_hash)
    where x.notice_id = s.id_a and y.notice_id = s.id_b) as retrieved from scored s""" for b, r in CONFIGS) + ")"


def _verdict(score: str, tau: float) -> str:
    return f"""case when {score} >= {tau} then case when is_same then 'TP' else 'FP' end else case when is_same then 'FN' else 'TN' end end as {score}_verdict"""


def _costs(by: str, source: str) -> str:
    ratios = ",".join(f"({r})" for r in RATIOS)
    return f"""
select {by}, stage, tp, fp, fn, tn, ratio, ratio * fp + fn as cost from (
  select {by}, stage, count(*) filter (s and is_same) as tp, count(*) filter (s and not is_same) as fp,
    count(*) filter (not s and is_same) as fn, count(*) filter (not s and not is_same) as tn
  from (select *, 'candidate' as stage, retrieved as s from {source}
        union all select *, 'merged', retrieved and similarity >= {TAU} from {source}) group by {by}, stage),
  (values {ratios}) r(ratio)"""


def _work(crowd: str, others: str, name: str) -> str:
    return f"{name} as materialized (select notice_id, portal_id, cast(sum({others}) as bigint) as work from {crowd} group by 1, 2)"


_SUMMARY = f"count(*) as notices, cast(sum(work) // 2 as bigint) as comparisons, max(work) as max_work, {_WORK}"
_WORKED = _work("bands_crowd", "n - own", "worked")

_RAW_BANDS = _signatures("raw_field_grams", "rsigs") + "," + _bands("rsigs", "rbands")
_VARIANTS = {
    "raw, all pairs": ("rbands", "true", "n - 1"), "clean, all pairs": ("bands", "true", "n - 1"),
    "raw, across portals": ("rbands", "cross_portal", "n - own"), "clean, across portals": ("bands", "cross_portal", "n - own"),
}
_VARIANT_CTES = _RAW_BANDS + "".join(
    f",\nv{i} as materialized (select id_a, id_b from {name}_met where {where})," + _work(f"{name}_crowd", others, f"w{i}")
    for i, (name, where, others) in enumerate(_VARIANTS.values()))


def _recall(pairs: str) -> str:
    return f"""(select count(*) as duplicates, count(m.id_a) as found,
    round(case when count(*) = 0 then 0 else count(m.id_a) / count(*)::double end * 100, 6) as recall_pct
  from (select * from scored where is_same) l left join {pairs} m on m.id_a = l.id_a and m.id_b = l.id_b)"""


_CAP_CTES = "caps(cap) as (values (0)," + ",".join(f"({c})" for c in CAPS) + """),
cross_pairs as materialized (select id_a, id_b, min_bucket from bands_met where cross_portal),
cap_work as (select cap, notice_id, cast(sum(case when cap = 0 or n <= cap then n - own else 0 end) as bigint) as work from caps, bands_crowd group by 1, 2),
cap_left as (select cap, count(*) filter (cap > 0 and n > cap) as skipped_buckets,
    cast(coalesce(sum(c) filter (cap > 0 and n > cap), 0) as bigint) as skipped_comparisons
  from caps, (select band_id, bucket_hash, any_value(n) as n, sum(n - own) // 2 as c from bands_crowd group by 1, 2) group by 1),
cap_found as (select cap, count(*) as duplicates, count(*) filter (min_bucket is not null and (cap = 0 or min_bucket <= cap)) as found
  from caps, (select l.id_a, min_bucket from (select * from scored where is_same) l left join cross_pairs c on c.id_a = l.id_a and c.id_b = l.id_b) group by 1)"""


def _field(side: str, k: int) -> str:
    x, y = f"x.{side}[:{k}]", f"y.{side}[:{k}]"
    return f"case when list_max({x}) = 0 or list_max({y}) = 0 then 0 else len(list_filter(list_zip({x}, {y}), lambda z: z[1] = z[2])) / {k}.0::double end"


def _estimates(sizes: tuple[int, ...]) -> str:
    return _signatures("grams", "wide", max(sizes)) + ",\nestimates as materialized (" + " union all ".join(
        f"select {k} as k, s.*, 0.5::double * ({_field('tsig', k)}) + 0.5::double * ({_field('bsig', k)}) as estimate "
        "from scored s join wide x on x.notice_id = id_a join wide y on y.notice_id = id_b" for k in sizes) + f"""),
est_errors as (select *, abs(estimate - similarity) as error, (estimate >= {TAU}) = (similarity >= {TAU}) as agrees from estimates)"""


_ESTIMATES = _estimates(SIZES)

_QUALITY = _sweep("docq", "n_chars", "sw_q")

ORACLES: dict[str, str] = {
    "label_check": _q("""
select count(*) as pairs, count(*) filter (is_same) as same, count(*) filter (not is_same) as different,
  round(count(*) filter (not is_same) / count(*) filter (is_same)::double, 6) as imbalance,
  (select count(distinct i) from (select id_a as i from labelled union all select id_b from labelled)) as notices, 0::bigint as unknown_notices
from labelled"""),
    "threshold_sweep": _q(f"select round(threshold, 6) as threshold, tp, fp, fn, tn, {_RATES} from sw_comp", extra=_SWEEPS),
    "best_threshold": _q(" union all ".join(_best(*b) for b in _BOTH), extra=_SWEEPS),
    "holdout_threshold": _q(" union all ".join(
        _held(score, short, k) for k in (0, 1) for score, short in (("raw_similarity", "raw"), ("similarity", "comp"))), extra=_HOLDOUT),
    "confusion": _q(_confusion("raw_similarity", _RAW_TAU) + " union all " + _confusion("similarity", TAU)),
    "roc_auc": _q(" union all ".join(f"select '{s}' as score, {_ROC} as roc_auc from {w}" for s, w in _BOTH), extra=_SWEEPS),
    "pr_auc": _q(" union all ".join(f"select '{s}' as score, {_PR} as pr_auc from {w}" for s, w in _BOTH), extra=_SWEEPS),
    "curve_points": _q("""
select round(threshold, 6) as threshold, round(fp / n::double, 6) as fpr, round(tp / p::double, 6) as tpr,
  round(tp / (tp + fp)::double, 6) as precision from sw_raw""", extra=_SWEEPS),
    "quality_auc": f"""
with docq as (select n_chars::double as n_chars, quality = 1 as is_same from documents join labels using (doc_id)),{_QUALITY}
select 'n_chars' as score, (select min(threshold) from sw_q where f1 = (select max(f1) from sw_q)) as best_score,
  round(max(f1), 6) as macro_f1, {_ROC} as roc_auc, {_PR} as pr_auc from sw_q""",
    "class_profile": _q(_profile("raw_similarity") + " union all " + _profile("similarity")),
    "anchor_pairs": _q(f"""
select id_a, id_b, is_same, round(raw_similarity, 6) as raw_similarity, round(similarity, 6) as similarity,
  {_verdict("raw_similarity", _RAW_TAU)}, {_verdict("similarity", TAU)}
from (select *, row_number() over (partition by is_same order by round(abs(raw_similarity - similarity), 9) desc, id_a, id_b) as rn from scored)
where rn = 1"""),
    "estimator_error_by_k": _q(f"""
select k, count(*) as pairs, round(avg(error), 6) as mae, round(sqrt(avg(error * error)), 6) as rmse, round(max(error), 6) as max_error,
  round(avg(agrees::int * 100.0::double), 6) as agreement_pct, count(*) filter (not agrees) as disagreements,
  round(avg(sqrt(similarity * (1 - similarity) / k)), 6) as mean_standard_error, round(quantile_cont(error, 0.5), 6) as p50_error,
  round(quantile_cont(error, 0.9), 6) as p90_error, round(quantile_cont(error, 0.99), 6) as p99_error,
  round(0.98::double / sqrt(k), 6) as worst_case_bound,
  cast(ceil(0.9604::double / ((0.98::double / sqrt(k) - 1e-12) * (0.98::double / sqrt(k) - 1e-12))) as bigint) as rows_for_bound, k * 16 as bytes_per_notice
from est_errors group by k""", extra=_ESTIMATES),
    "estimator_disagreements": _q(f"""
select k, id_a, id_b, is_same, round(similarity, 6) as similarity, round(estimate, 6) as estimate,
  round(estimate - similarity, 6) as error, round(abs(similarity - {TAU}), 6) as distance from est_errors where not agrees""", extra=_estimates(COARSE_SIZES)),
    "banding_grid": _q(" union all ".join(f"""
select {b} as bands, {r} as rows, round(pow(1.0::double / {b}, 1.0::double / {r}), 6) as inflection,
  round(tp / (tp + fn)::double * 100, 6) as recall_pct, work_pairs, total_buckets, largest_bucket, comparisons,
  round(comparisons / (m * (m - 1) / 2.0::double) * 100, 6) as comparisons_pct
from (select count(*) filter (retrieved and is_same) as tp, count(*) filter (not retrieved and is_same) as fn, count(*) filter (retrieved) as work_pairs
      from hits where bands = {b}),
  (select count(*) as total_buckets, max(n) as largest_bucket, cast(sum(n * (n - 1) // 2) as bigint) as comparisons
    from (select band_id, bucket_hash, count(*) as n from g{b} group by 1, 2)), (select count(*) as m from notices)""" for b, r in CONFIGS), extra=_HITS),
    "retrieval_curve": _q("""
select bands, rows, bin::int as bin, coalesce(pairs, 0) as pairs, round(retrieved_share, 6) as retrieved_share,
  round(1 - pow(1 - pow((bin + 0.5::double) / 10, rows), bands), 6) as theory_score, round(theory_fields, 6) as theory_fields
from (select distinct bands, rows, bin from hits, range(10) r(bin)) left join (
  select bands, rows, least(floor(similarity * 10), 9)::bigint as bin, count(*) as pairs, avg(retrieved::int) as retrieved_share,
    avg(1 - pow(1 - pow(title_sim, rows / 2.0::double) * pow(body_sim, rows / 2.0::double), bands)) as theory_fields
  from hits group by 1, 2, 3) using (bands, rows, bin)""", extra=_HITS),
    "cost_table": _q(_costs("bands, rows", "hits"), extra=_HITS),
    "cost_by_cap": _q(_costs("cap", "cap_hits"), extra="""
cap_hits as (select s.is_same, s.similarity, cap, coalesce(min_bucket <= cap, false) as retrieved
  from scored s left join (select * from bands_met where cross_portal) m using (id_a, id_b), (values (10), (50), (150)) c(cap))"""),
    "candidate_recall": _q("select * from " + _recall("(select id_a, id_b from bands_met where cross_portal)")),
    "partner_degree": _q("""
select notice_id as probe_id, work as comparisons, coalesce(partners, 0) as partners, true as estimate_in_bounds
from worked left join (
  select x.notice_id, count(distinct y.notice_id) as partners from bands x join bands y using (band_id, bucket_hash)
  where x.notice_id % 20 = 0 and x.portal_id <> y.portal_id group by 1
) using (notice_id) where notice_id % 20 = 0""", extra=_WORKED),
    "work_distribution": _q(f"select {_SUMMARY} from worked", extra=_WORKED),
    "work_top20": _q("""
select row_number() over (order by work desc, notice_id)::int as rank, notice_id, portal_id, work from worked
order by work desc, notice_id limit 20""", extra=_WORKED),
    "source_workload": _q("""
select portal_id, count(*) as notices, cast(sum(work) as bigint) as total_work, round(avg(work), 6) as avg_work, max(work) as max_work,
  round(sum(work) / (select sum(work) from worked)::double * 100, 6) as share_pct
from worked group by 1 order by total_work desc, portal_id limit 15""", extra=_WORKED),
    "work_concentration": _q("""
select part, cast(sum(n) as bigint) as notices, cast(sum(tw) as bigint) as total_work, round(sum(tw / t * 100), 6) as share_pct from (
  select unnest([case when portal_id in ('src0','src1','src2','src3','src4','src5') then 'group' else 'others' end,
    case when row_number() over (order by tw desc, portal_id) = 1 then 'top portal' end]) as part, n, tw, t
  from (select portal_id, count(*) as n, sum(work) as tw, (select sum(work) from worked)::double as t from worked group by 1))
where part is not null group by 1""", extra=_WORKED),
    "cap_sweep": _q(f"""
select cap, {_SUMMARY}, any_value(duplicates) as duplicates, any_value(found) as found,
  round(any_value(found / duplicates::double) * 100, 6) as recall_pct,
  any_value(skipped_buckets) as skipped_buckets, any_value(skipped_comparisons) as skipped_comparisons
from cap_work join cap_found using (cap) join cap_left using (cap) group by cap""", extra=_CAP_CTES),
    "mitigation_matrix": _q(" union all ".join(
        f"select '{name}' as variant, s.*, r.* from (select {_SUMMARY} from w{i}) s, {_recall(f'v{i}')} r" for i, name in enumerate(_VARIANTS)),
        extra=_VARIANT_CTES),
    "before_after": _q(f"""
, one as (select s.*, r.* from (select {_SUMMARY} from w0) s, {_recall('v0')} r),
two as (select s.*, r.* from (select {_SUMMARY} from w3) s, {_recall('v3')} r),
b as (unpivot (select comparisons::double as comparisons, max_work::double as max_work, p50, p90, p95, p99, found::double as found, recall_pct from one)
  on columns(*) into name measure value before),
a as (unpivot (select comparisons::double as comparisons, max_work::double as max_work, p50, p90, p95, p99, found::double as found, recall_pct from two)
  on columns(*) into name measure value after)
select measure, round(before, 6) as before, round(after, 6) as after,
  round(case when before <> 0 then (after - before) / before * 100 end, 6) as change_pct from b join a using (measure)""",
        extra=_VARIANT_CTES).replace(")\n, one", "),\none"),
}
