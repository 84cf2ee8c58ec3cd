"""The notice queries as plain SQL, to check results with another engine."""

from __future__ import annotations

from ledgerloom.functions import text as T
from ledgerloom.functions.hashing import MODULUS, coefficients
from ledgerloom.operators.matching import SCREEN, TAU

_WRAP = (1 << 64) - 1


def _functions(rows: int) -> str:
    """The hash family as a VALUES list: place, field (0 title, 1 body), multiplier, offset."""
    out = []
    for field, name in enumerate(("title", "body")):
        multipliers, offsets = coefficients(name)
        out += [f"({i},{field},{multipliers[i]}::hugeint,{offsets[i]}::hugeint)" for i in range(rows)]
    return ",".join(out)


def _replace(value: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({value}, '{pattern}', '{by}', 'g')"


def _strip(value: str) -> str:
    return _replace(value, f"^{T.BLANK}+|{T.BLANK}+$")


def _clean_title(value: str) -> str:
    for pattern in (T.TITLE_HEADS, T.BRACKETED, T.TRAILING_PLACE):
        value = _strip(_replace(value, pattern))
    return f"lower({value})"


def _clean_body(value: str) -> str:
    # Without look-around the character before a code or id is matched and put back; ids that share
    # a separator need a second pass.
    for start, end in (T.NATIONAL_PREAMBLE, T.STATE_PREAMBLE):
        value = _replace(value, rf"(?s){start}.*?{end}.*?(?:\n\n|{T.PREAMBLE_RULE}|$)")
    value = _replace(value, "(?is)DISCLAIMER:.*$")
    value = _replace(
        value, rf"(?i)(^|{T.NOT_WORD})(?:{'|'.join(T.REFERENCE_CODE_HEADS)})[\p{{L}}\p{{N}}_/:\-]*{T.WORD}", r"\1"
    )
    for _ in range(2):
        value = _replace(value, rf"(^|{T.NOT_WORD})\p{{Nd}}{{5,8}}($|{T.NOT_WORD})", r"\1\2")
    return f"lower({value})"


def _tokens(value: str) -> str:
    return f"list_filter(string_split_regex(lower({value}), '{T.NOT_WORD}+'), lambda w: regexp_full_match(w, '[a-z0-9]+'))"


def _grams(words: str, n: int) -> str:
    shifted = ", ".join([words, *[f"{words}[{k + 1}:]" for k in range(1, n)], "true"])
    joined = " || ' ' || ".join(f"z[{k + 1}]" for k in range(n))
    run = f"list_distinct(list_transform(list_zip({shifted}), lambda z: {joined}))"
    return f"case when len({words}) >= {n} then {run} when len({words}) > 0 then [array_to_string({words}, ' ')] else [] end"


_TEXT = f"""
notices as materialized (
  select doc_id as notice_id, source as portal_id, lang, n_chars, regexp_extract(text, '{'^[^'}\\n.!?]*', 0) as title,
    substr(text, length(regexp_extract(text, '{'^[^'}\\n.!?]*', 0)) + 1) as body
  from documents),
cleaned as (select notice_id, portal_id, {_clean_title("title")} as title, {_clean_body("body")} as body from notices),
words as (select notice_id, {_tokens("title")} as tw, {_tokens("body")} as bw from cleaned),
grams as materialized (
  select notice_id, {_grams("tw", T.TITLE_GRAM)} as tg, {_grams("bw", T.BODY_GRAM)} as bg from words),
raw_words as (select notice_id, {_tokens("title || ' ' || body")} as w from notices),
raw_grams as materialized (select notice_id, {_grams("w", T.RAW_GRAM)} as g from raw_words),
raw_field_words as (select notice_id, {_tokens("title")} as tw, {_tokens("body")} as bw from notices),
raw_field_grams as materialized (
  select notice_id, {_grams("tw", T.TITLE_GRAM)} as tg, {_grams("bw", T.BODY_GRAM)} as bg from raw_field_words)"""


def _signatures(grams: str, name: str, rows: int = 64) -> str:
    return f"""
{name}_f(i, field, a, b) as (values {_functions(rows)}),
{name}_x as (
  select notice_id, 0 as field, md5_number_upper(unnest(tg)) & {MODULUS}::ubigint as x from {grams}
  union all select notice_id, 1, md5_number_upper(unnest(bg)) & {MODULUS}::ubigint from {grams}),
{name}_h as (select notice_id, field, i, ((a * x::hugeint + b) & {_WRAP}::hugeint)::ubigint as h from {name}_x join {name}_f using (field)),
{name}_m as materialized (
  select notice_id, field, i, cast(min(((h & {MODULUS}::ubigint) + (h >> 61)) % {MODULUS}::ubigint) as bigint) as m from {name}_h group by all),
{name} as materialized (
  select notice_id, list(coalesce(m, 0) order by 2 * i + field) as sig,
    list(coalesce(m, 0) order by i) filter (field = 0) as tsig, list(coalesce(m, 0) order by i) filter (field = 1) as bsig
  from (select notice_id, i, field from notices, {name}_f) left join {name}_m using (notice_id, field, i) group by notice_id)"""


def _bands(signature: str, name: str, bands: int = 32, rows: int = 4) -> str:
    return f"""
{name} as materialized (
  select notice_id, portal_id, cast(band_id as int) as band_id,
    array_to_string(list_transform(sig[band_id * {rows} + 1:band_id * {rows} + {rows}], lambda v: format('{{:016x}}', v)), '_') as bucket_hash
  from {signature} join notices using (notice_id), range({bands}) r(band_id)),
{name}_crowd as materialized (
  select *, count(*) over (partition by band_id, bucket_hash) as n, count(*) over (partition by band_id, bucket_hash, portal_id) as own from {name}),
{name}_sizes as materialized (select band_id, bucket_hash, count(*) as n from {name} group by 1, 2 having count(*) > 1),
{name}_met as materialized (
  select a.notice_id as id_a, b.notice_id as id_b, min(n) as min_bucket, any_value(a.portal_id <> b.portal_id) as cross_portal
  from {name} a join {name}_sizes using (band_id, bucket_hash) join {name} b using (band_id, bucket_hash)
  where a.notice_id < b.notice_id group by 1, 2)"""


def jaccard(a: str, b: str) -> str:
    shared = f"len(list_intersect({a}, {b}))"
    return f"case when len({a}) = 0 or len({b}) = 0 then 0.0::double else {shared} / (len({a}) + len({b}) - {shared})::double end"


_PAIRS = f"""
least_hash as (
  select notice_id, min(md5_number_upper(g) & {MODULUS}::ubigint) as h
  from (select notice_id, unnest(bg) as g from grams) group by 1),
pool as materialized (
  select a.notice_id as id_a, b.notice_id as id_b from notices a join notices b on b.notice_id = a.notice_id + 1
  union select f.id_a, l.notice_id from least_hash l join (select h, min(notice_id) as id_a from least_hash group by 1) f using (h)
  where l.notice_id > f.id_a),
labelled as (
  select id_a, id_b, coalesce(len(list_intersect(a.bg, b.bg)) / nullif(least(len(a.bg), len(b.bg)), 0)::double >= 0.8, false) as is_same
  from pool join grams a on a.notice_id = id_a join grams b on b.notice_id = id_b),
scored as materialized (
  select id_a, id_b, is_same, {jaccard("ra.g", "rb.g")} as raw_similarity, {jaccard("a.tg", "b.tg")} as title_sim,
    {jaccard("a.bg", "b.bg")} as body_sim, 0.5::double * ({jaccard("a.tg", "b.tg")}) + 0.5::double * ({jaccard("a.bg", "b.bg")}) as similarity
  from labelled join grams a on a.notice_id = id_a join grams b on b.notice_id = id_b
  join raw_grams ra on ra.notice_id = id_a join raw_grams rb on rb.notice_id = id_b)"""

_MATCH = f"""
wording as materialized (select notice_id, min(notice_id) over (partition by tw, bw) as representative from words),
agree as (
  select p.id_a, p.id_b, len(list_filter(list_zip(a.sig, b.sig), lambda z: z[1] = z[2])) / 128.0::double as screen_score,
    0.5::double * ({jaccard("ga.tg", "gb.tg")}) + 0.5::double * ({jaccard("ga.bg", "gb.bg")}) as similarity,
    {jaccard("ga.tg", "gb.tg")} as title_sim, {jaccard("ga.bg", "gb.bg")} as body_sim
  from bands_met p join sigs a on a.notice_id = p.id_a join sigs b on b.notice_id = p.id_b
  join grams ga on ga.notice_id = p.id_a join grams gb on gb.notice_id = p.id_b where cross_portal),
verified as materialized (select * from agree where screen_score >= {SCREEN} and similarity >= {TAU}),
class_agree as materialized (
  select least(x.representative, y.representative) as id_a, greatest(x.representative, y.representative) as id_b, any_value(screen_score) as screen_score,
    any_value(title_sim) as title_sim, any_value(body_sim) as body_sim, any_value(similarity) as similarity
  from agree join wording x on x.notice_id = id_a join wording y on y.notice_id = id_b where x.representative <> y.representative group by 1, 2),
class_links as materialized (select * from class_agree where screen_score >= {SCREEN} and similarity >= {TAU}),
edges as (select id_a as u, id_b as v from verified union select id_b, id_a from verified),
reach(u, v) as (select notice_id, notice_id from notices union select r.u, e.v from reach r join edges e on e.u = r.v),
roots as materialized (select u as notice_id, min(v) as root_id from reach group by 1)"""

_SIGS = _signatures("grams", "sigs")
_BANDS = _bands("sigs", "bands")
_ALL = ",".join([_TEXT, _SIGS, _BANDS, _PAIRS, _MATCH])


def _q(select: str, prelude: str = _ALL, extra: str = "") -> str:
    return f"with recursive {prelude.strip()}{',' + extra if extra else ''}\n{select.strip()}"


def _quantiles(column: str, shares: dict[str, float]) -> str:
    return ", ".join(f"round(quantile_cont({column}, {share}), 6) as {name}" for name, share in shares.items())


_WORK = f"round(quantile_cont(work, 0.5), 6) as p50, round(quantile_cont(work, 0.9), 6) as p90, round(quantile_cont(work, 0.95), 6) as p95, round(quantile_cont(work, 0.99), 6) as p99"

_LENGTHS = ", ".join([
    "length(title) as title_chars", f"len(regexp_extract_all(title, '[^{T.BLANKS}]+')) as title_words",
    "length(body) as body_chars", f"len(regexp_extract_all(body, '[^{T.BLANKS}]+')) as body_words",
])

_INCREMENTAL = f"""
first_known as (select distinct doc_id as notice_id from labels),
old_edges as (select id_a as u, id_b as v from verified where id_a in (from first_known) and id_b in (from first_known)),
old_both as (select u, v from old_edges union select v, u from old_edges),
old_reach(u, v) as (select notice_id, notice_id from notices where notice_id in (from first_known)
  union select r.u, e.v from old_reach r join old_both e on e.u = r.v),
old_cards as materialized (select u as notice_id, 'CARD-' || min(v) as card_id from old_reach group by 1),
new_edges as (
  select case when id_a in (from first_known) then '0:' || ca.card_id else '1:' || lpad(id_a::varchar, 20, '0') end as u,
    case when id_b in (from first_known) then '0:' || cb.card_id else '1:' || lpad(id_b::varchar, 20, '0') end as v
  from verified left join old_cards ca on ca.notice_id = id_a left join old_cards cb on cb.notice_id = id_b
  where not (id_a in (from first_known) and id_b in (from first_known))),
new_both as (select u, v from new_edges union select v, u from new_edges),
new_reach(u, v) as (
  select '1:' || lpad(notice_id::varchar, 20, '0'), '1:' || lpad(notice_id::varchar, 20, '0') from notices where notice_id not in (from first_known)
  union select r.u, e.v from new_reach r join new_both e on e.u = r.v),
new_cards as (
  select cast(substr(u, 3) as bigint) as notice_id,
    case when min(v) like '0:%' then substr(min(v), 3) else 'CARD-' || cast(substr(min(v), 3) as bigint) end as card_id
  from new_reach group by u)"""

ORACLES: dict[str, str] = {
    "profile_nulls": _q("""
select column_name, cast(nulls as bigint) as nulls, round(nulls * 100.0::double / n, 6) as null_pct from (
  unpivot (select count(*) - count(notice_id) as notice_id, count(*) - count(portal_id) as portal_id, count(*) - count(lang) as lang,
    count(*) - count(n_chars) as n_chars, count(*) - count(title) as title, count(*) - count(body) as body from notices)
  on columns(*) into name column_name value nulls), (select count(*) as n from notices)""", _TEXT),
    "profile_unique": """
select 'doc_id' as column_name, count(*) as row_count, count(distinct doc_id) as distinct_values, count(*) = count(distinct doc_id) as is_unique from documents
union all select 'text', count(*), count(distinct text), count(*) = count(distinct text) from documents
union all select 'source', count(*), count(distinct source), count(*) = count(distinct source) from documents""",
    "profile_lengths": _q(f"""
select measure, min(v) as min, {_quantiles("v", {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99})},
  round(avg(v), 6) as mean, max(v) as max, round(stddev_samp(v), 6) as std
from (unpivot (select {_LENGTHS} from notices) on columns(*) into name measure value v) group by 1""", _TEXT),
    "profile_length_sketches": _q(f"""
select measure, share, count(v) as row_count, true as in_bounds
from (unpivot (select {_LENGTHS} from notices) on columns(*) into name measure value v),
  (values ('p01'), ('p05'), ('p25'), ('p50'), ('p75'), ('p95'), ('p99')) s(share) group by 1, 2""", _TEXT),
    "source_share": """
with c as (select source as value, count(*) as row_count from documents group by 1),
ranked as (select *, row_number() over (order by row_count desc, value) as rank, sum(row_count) over () as total,
  sum(row_count) over (order by row_count desc, value rows unbounded preceding) as running from c)
select rank, value, row_count, round(row_count * 100.0::double / total, 6) as share_pct, round(running * 100.0::double / total, 6) as cumulative_pct
from ranked where rank <= 15""",
    "common_prefix": """
with ranked as (select source, doc_id, text, row_number() over (partition by source order by doc_id) as rn, count(*) over (partition by source) as n from documents),
two as (select a.source as portal_id, a.n as notices, a.doc_id as first_id, b.doc_id as second_id, a.text as ta, b.text as tb
  from ranked a join ranked b on a.source = b.source and a.rn = 1 and b.rn = 2)
select portal_id, notices, first_id, second_id,
  coalesce((select min(i) - 1 from range(1, least(length(ta), length(tb)) + 1) r(i) where substr(ta, i, 1) <> substr(tb, i, 1)),
    least(length(ta), length(tb)))::int as shared_prefix
from two""",
    "attr_agreement": _q("""
select is_same, count(*) as pairs, count(*) filter (a.lang = b.lang) as lang_agree, count(*) filter (a.portal_id = b.portal_id) as portal_id_agree,
  count(*) filter (a.n_chars = b.n_chars) as n_chars_agree, round(count(*) filter (a.lang = b.lang) * 100.0::double / count(*), 6) as lang_pct,
  round(count(*) filter (a.portal_id = b.portal_id) * 100.0::double / count(*), 6) as portal_id_pct,
  round(count(*) filter (a.n_chars = b.n_chars) * 100.0::double / count(*), 6) as n_chars_pct
from labelled join notices a on a.notice_id = id_a join notices b on b.notice_id = id_b group by 1"""),
    "clean_text": _q(f"""
select notice_id, title as clean_title, length({_strip("body")})::int as body_chars, md5({_strip("body")}) as body_md5 from cleaned""", _TEXT),
    "shingles_raw": _q("select notice_id, len(g)::int as raw_grams, md5(array_to_string(list_sort(g), '|')) as raw_md5 from raw_grams", _TEXT),
    "shingles_clean": _q("""
select notice_id, len(tg)::int as title_grams, md5(array_to_string(list_sort(tg), '|')) as title_md5,
  len(bg)::int as body_grams, md5(array_to_string(list_sort(bg), '|')) as body_md5 from grams""", _TEXT),
    "jaccard_raw": _q("select id_a, id_b, is_same, round(raw_similarity, 6) as raw_similarity from scored"),
    "jaccard_composite": _q("select id_a, id_b, is_same, round(title_sim, 6) as title_sim, round(body_sim, 6) as body_sim, round(similarity, 6) as similarity from scored"),
    "minhash_signature": _q("""
select notice_id, sig[1] as first_row, sig[128] as last_row, md5(array_to_string(sig, ',')) as signature_md5 from sigs"""),
    "minhash_estimate": _q("""
select id_a, id_b, round(t, 6) as title_estimate, round(b, 6) as body_estimate, round(0.5::double * t + 0.5::double * b, 6) as estimate from (
  select id_a, id_b,
    case when list_max(x.tsig) = 0 or list_max(y.tsig) = 0 then 0 else len(list_filter(list_zip(x.tsig, y.tsig), lambda z: z[1] = z[2])) / 64.0::double end as t,
    case when list_max(x.bsig) = 0 or list_max(y.bsig) = 0 then 0 else len(list_filter(list_zip(x.bsig, y.bsig), lambda z: z[1] = z[2])) / 64.0::double end as b
  from pool join sigs x on x.notice_id = id_a join sigs y on y.notice_id = id_b)"""),
    "lsh_bands": _q("select band_id, bucket_hash, notice_id from bands"),
    "bucket_sizes": _q("""
select band_id, count(*) as buckets, count(*) filter (n > 1) as shared_buckets, max(n) as largest, cast(sum(n * (n - 1) // 2) as bigint) as comparisons
from (select band_id, bucket_hash, count(*) as n from bands group by 1, 2) group by 1"""),
    "lsh_candidates_all": _q("""
select b.band_id, b.bucket_hash, any_value(n) as notices, count(distinct representative) as wordings, count(distinct portal_id) as portals,
  any_value(n) * (any_value(n) - 1) // 2 as comparisons, cast(sum(n - own) // 2 as bigint) as cross_portal, coalesce(any_value(verified_links), 0) as verified_links
from bands_crowd b join wording using (notice_id) left join (
  select x.band_id, x.bucket_hash, count(*) as verified_links from class_links join bands x on x.notice_id = id_a
  join bands y on y.notice_id = id_b and y.band_id = x.band_id and y.bucket_hash = x.bucket_hash group by 1, 2
) l on l.band_id = b.band_id and l.bucket_hash = b.bucket_hash
where n > 1 group by 1, 2"""),
    "lsh_candidates_capped": _q("select id_a, id_b from bands_met where cross_portal and min_bucket <= 10"),
    "pair_collision": _q("""
select id_a, id_b, exists (select 1 from bands x join bands y using (band_id, bucket_hash) where x.notice_id = id_a and y.notice_id = id_b) as collides
from pool"""),
    "bucket_lookup": _q("""
select band_id, bucket_hash, notice_id from bands semi join (select band_id, bucket_hash from bands where notice_id % 20 = 0) using (band_id, bucket_hash)"""),
    "probe_expansion": _q("""
select distinct x.notice_id as probe_id, y.notice_id as candidate_id from bands x join bands y using (band_id, bucket_hash)
where x.notice_id <> y.notice_id"""),
    "class_membership": _q("select representative, notice_id from wording"),
    "screen_pairs": _q(f"select id_a, id_b, round(screen_score, 6) as screen_score from class_agree where screen_score >= {SCREEN}"),
    "verify_pairs": _q("""
select id_a, id_b, round(title_sim, 6) as title_sim, round(body_sim, 6) as body_sim, round(similarity, 6) as similarity from class_links"""),
    "stage_counts": _q(f"""
select 'notices' as stage, count(*) as row_count from notices
union all select 'shingles', cast(sum(len(tg) + len(bg)) as bigint) from grams
union all select 'wordings', count(distinct representative) from wording
union all select 'buckets', count(*) from (select distinct band_id, bucket_hash from bands)
union all select 'comparisons', cast(coalesce(sum(n - own) // 2, 0) as bigint) from bands_crowd
union all select 'screened_links', count(*) from class_agree where screen_score >= {SCREEN}
union all select 'verified_links', count(*) from class_links
union all select 'cards', count(distinct root_id) from roots
union all select 'cards_with_duplicates', count(*) from (select root_id from roots group by 1 having count(*) > 1)"""),
    "components": _q("select notice_id, portal_id, root_id from roots join notices using (notice_id)"),
    "cards": _q("""
select 'CARD-' || root_id as card_id, root_id as canonical_notice_id, member_count, portal_count, title, lang from (
  select root_id, count(*) as member_count, count(distinct portal_id) as portal_count from roots join notices using (notice_id) group by 1) r
join notices n on n.notice_id = root_id"""),
    "card_members": _q("select 'CARD-' || root_id as card_id, notice_id from roots"),
    "card_portals": _q("""
select 'CARD-' || root_id as card_id, portal_id, count(*) as members from roots join notices using (notice_id) group by 1, 2"""),
    "incremental_batch": _q("""
select notice_id, card_id, false as arrived from old_cards union all select notice_id, card_id, true from new_cards""", extra=_INCREMENTAL),
    "incremental_stream": _q("select notice_id, card_id from old_cards union all select notice_id, card_id from new_cards", extra=_INCREMENTAL),
    "in_text_money": """
with o as (select cast(o_totalprice as decimal(18,2)) as t from orders)
select notation, count(*) as amounts, count(*) filter (notation <> 'words' or t = floor(t)) as exact,
  cast(sum(case when notation = 'words' then floor(t) else t end) as double) as value_sum
from o, (values ('plain'), ('rupees'), ('lakh'), ('crore'), ('words')) n(notation) group by 1""",
}
