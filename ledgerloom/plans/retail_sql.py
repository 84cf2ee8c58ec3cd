"""The retail queries as plain SQL, to check results with another engine."""

from __future__ import annotations

_RAW = """
raw0 as (
  select *, case l_returnflag || l_linestatus when 'NO' then 'SALE' when 'NF' then 'DISCOUNT' when 'RF' then 'RETURN'
    when 'RO' then 'VOID' when 'AF' then 'TAX' else 'TENDER' end as line_type,
    (l_orderkey * 97 + l_linenumber * 31) % 1530 as late_minutes
  from lineitem),
raw as (
  select 'B' || l_orderkey as bill_no, l_linenumber as line_no,
    case when line_type not in ('DISCOUNT','TAX','TENDER') then 'P' || l_partkey end as product_code,
    cast(case when line_type in ('DISCOUNT','TAX','TENDER') then 1 when line_type in ('RETURN','VOID') then -l_quantity
      else l_quantity end as decimal(12,2)) as qty,
    cast(case when line_type = 'DISCOUNT' then -l_extendedprice else l_extendedprice end as decimal(12,2)) as unit_price,
    line_type, l_shipdate + late_minutes * interval 1 minute as ts, cast(l_shipdate as date) as business_date,
    'S' || l_suppkey as store_id, strftime(l_shipdate, '%Y') as year, strftime(l_shipdate, '%m') as month,
    strftime(l_shipdate, '%d') as day
  from raw0),
lines0 as (
  select *, row_number() over (partition by bill_no, line_no order by product_code nulls first, qty, unit_price,
    line_type, ts, business_date, store_id, year, month, day) as rn from raw),
lines as (select * exclude (rn) from lines0 where rn = 1),
products as (
  select p_partkey * 2 + 1 + v as product_sk, 'P' || p_partkey as product_code,
    case when v = 0 then p_name else p_name || ' (reissued)' end as product_name,
    case when v = 0 then p_type else p_brand end as category,
    case when v = 0 then date '1995-01-01' else date '1998-06-01' end as valid_from,
    case when v = 0 and p_partkey % 10 = 0 then date '1998-05-31' else date '2099-12-31' end as valid_to,
    p_retailprice
  from part, range(2) r(v) where v = 0 or p_partkey % 10 = 0),
stores as (
  select 'S' || s_suppkey as store_id, s_name as store_name, n_name as city, r_name as state
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
dim_product as (
  select product_sk, product_code, product_name, category, valid_from, valid_to from products
  union all select 0, 'DISCOUNT', 'Bill-Level Discount', 'Promotions & Discounts', date '1995-01-01', date '2099-12-31'
  union all select -1, 'UNKNOWN', 'Unknown Product', 'Unknown', date '1995-01-01', date '2099-12-31'),
span as (select date_trunc('year', min(business_date)) as lo, date_trunc('year', max(business_date)) + interval 1 year as hi from raw),
dim_date as (
  select cast(d as date) as date_key, year(d) as year, month(d) as month, strftime(d, '%Y-%m') as month_str,
    monthname(d) as month_name, day(d) as day, dayname(d) as day_name, isodow(d) as day_of_week, isodow(d) >= 6 as is_weekend
  from (select unnest(range(lo::timestamp, hi::timestamp, interval 1 day)) as d from span)),
revenue_lines as (
  select *, cast(round(qty * unit_price, 2) as decimal(24,2)) as net from lines
  where line_type in ('SALE','RETURN','DISCOUNT','VOID')),
fact as (
  select bill_no, line_no, store_id,
    coalesce(p.product_sk, case when s.product_code is null then 0 else -1 end) as product_sk,
    business_date as date_key, qty as quantity, unit_price, net as net_amount, line_type
  from revenue_lines s left join products p
    on s.product_code = p.product_code and s.business_date between p.valid_from and p.valid_to),
revisions as (
  select product_sk, make_date(y, 1, 1) as effective_from, make_date(y, 12, 31) as effective_to,
    cast(cast(p_retailprice as decimal(12,2)) + (y - 1995) * cast(2.50 as decimal(4,2)) as decimal(12,2)) as price
  from products, (select unnest(range(min(year(l_shipdate)), max(year(l_shipdate)) + 1)) as y from lineitem) r),
finance as (
  select strftime(business_date, '%Y-%m') as month, cast(sum(qty * unit_price) as decimal(24,2)) as finance_revenue
  from raw where line_type in ('SALE','RETURN','DISCOUNT','VOID') group by 1),
monthly as (
  select strftime(date_key, '%Y-%m') as month, cast(sum(net_amount) as decimal(24,2)) as net_revenue, count(*) as fact_lines
  from fact group by 1),
recon0 as (
  select f.month, f.finance_revenue, m.net_revenue as fact_revenue from finance f left join monthly m using (month)),
recon as (
  select month, finance_revenue, fact_revenue, cast(fact_revenue - finance_revenue as decimal(24,2)) as variance,
    case when abs(fact_revenue - finance_revenue) < 0.01 then 'EXACT MATCH' else 'VARIANCE DETECTED' end as status
  from (select * from recon0 union all
        select 'TOTAL', cast(sum(finance_revenue) as decimal(24,2)), cast(sum(fact_revenue) as decimal(24,2)) from recon0)),
slice as (
  select f.*, s.store_name, p.product_code, p.product_name, p.category, d.month_str, d.day_name, d.day_of_week
  from fact f left join stores s using (store_id) left join dim_product p using (product_sk) left join dim_date d using (date_key)),
region_store as (
  select 'S' || s_suppkey as store_id,
    case n_regionkey when 0 then 'S01' when 1 then 'S05' when 2 then 'S06' when 3 then 'S09' when 4 then 'S12' end as region_store
  from supplier join nation on s_nationkey = n_nationkey),
exported0 as (
  select bill_no, line_no, product_code, qty, unit_price, line_type, ts, business_date as sold_on,
    last_day(business_date) as business_date, region_store as store_id
  from raw join region_store using (store_id)),
exported as (
  select bill_no, line_no, product_code, qty, unit_price, line_type, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts,
    business_date, store_id, strftime(business_date, '%Y') as year, strftime(business_date, '%m') as month, strftime(business_date, '%d') as day,
    cast(row_number() over (partition by store_id, business_date, bill_no, line_no
      order by product_code nulls first, qty, unit_price, line_type, ts, sold_on) - 1 as int) as resend_no
  from exported0),
ingested as (
  select *, row_number() over (partition by bill_no, line_no order by product_code nulls first, qty, unit_price,
    line_type, ts, business_date, store_id, year, month, day) as rn from exported),
gaps as (
  select store_id, strftime(d, '%Y-%m') as month, count(*) as missing_days, cast(min(d) as date) as first_missing
  from (select store_id, cast(unnest(range(min(business_date)::timestamp, max(business_date)::timestamp + interval 1 day, interval 1 day)) as date) as d
        from lines group by store_id) c
  where not exists (select 1 from lines l where l.store_id = c.store_id and l.business_date = c.d) group by 1, 2),
bill_month as (
  select bill_no, strftime(business_date, '%Y-%m') as month, sum(net) as total,
    sum(case when line_type <> 'VOID' then net else 0 end) as unvoided, count(*) filter (line_type = 'VOID') as voids
  from revenue_lines group by 1, 2),
rounded as (
  select month, cast(sum(total) as decimal(24,2)) as exact_revenue, cast(sum(round(total, 0)) as decimal(24,0)) as rounded_revenue,
    count(*) as bills from bill_month group by 1)
"""


def _q(select: str) -> str:
    return f"with {_RAW.strip()}\n{select}"


def _mean(total: str, count: str) -> str:
    """An exact mean to two places, half away from zero; a DOUBLE mean cannot hold half a cent."""
    cents = f"cast(cast({total} as decimal(20,2)) * 100 as hugeint)"
    return f"cast(sign({cents}) * ((2 * abs({cents}) + {count}) // (2 * {count})) as double) / 100"


def _prices(day: str) -> str:
    return _q(f"""
select product_code, product_name, category, price, effective_from, effective_to,
  cast(coalesce(sum(f.quantity), 0) as bigint) as units_sold_month,
  cast(coalesce(sum(f.net_amount), 0) as decimal(24,2)) as realised_revenue
from revisions r join products p using (product_sk)
left join fact f on f.product_sk = r.product_sk and strftime(f.date_key, '%Y-%m') = strftime(date '{day}', '%Y-%m')
where date '{day}' between effective_from and effective_to
group by r.product_sk, product_code, product_name, category, price, effective_from, effective_to""")


def _breakdown(columns: str, where: str = "true") -> str:
    return _q(f"select {columns}, cast(sum(net_amount) as decimal(24,2)) as net_revenue from slice where {where} group by {columns}")


def _kpi(where: str) -> str:
    return _q(f"""
select count(*) as total_lines, cast(sum(net_amount) as decimal(24,2)) as total_net_revenue,
  {_mean("sum(net_amount)", "count(*)")} as avg_line_revenue,
  cast(sum(quantity) as decimal(24,2)) as total_quantity
from slice where {where}""")


_STORE_MONTH = _q("""
select region_store as store_id, month, count(*) as bill_lines, cast(sum(net) as decimal(24,2)) as revenue
from revenue_lines join region_store using (store_id)
where region_store = 'S01' and year = '1998' and month = '01' group by 1, 2""")

_DECIMAL_RESULTS: dict[str, str] = {
    "dedup_lines": _q("select * replace (strftime(ts, '%Y-%m-%d %H:%M:%S') as ts) from lines"),
    "dedup_audit": _q("""
select copies, differ as copies_differ, count(*) as line_keys, cast(sum(copies) as bigint) as raw_lines from (
  select count(*) as copies, count(distinct (product_code, qty, unit_price, line_type, ts, business_date, store_id, year, month, day)) > 1 as differ
  from raw group by bill_no, line_no) group by 1, 2"""),
    "normalise_dialects": _q("select * from exported"),
    "file_name_facts": _q("""
select store_id, business_date, year, month, day, resend_no, count(*) as line_count from exported group by all"""),
    "ingest": _q("""
select year, month, store_id as store, count(*) as line_count,
  cast(sum(round(qty * unit_price, 2)) filter (line_type in ('SALE','RETURN','DISCOUNT','VOID')) as decimal(24,2)) as revenue
from ingested where rn = 1 group by 1, 2, 3"""),
    "dash_vs_fact": _q("""
select count(*) as report_lines, count(*) as fact_lines, cast(sum(net_amount) as decimal(24,2)) as report_revenue,
  cast(sum(net_amount) as decimal(24,2)) as fact_revenue, cast(0 as decimal(24,2)) as difference from fact"""),
    "resend_audit": _q("""
, keyed as (select distinct store_id, business_date, resend_no, bill_no, line_no from exported),
first as (select * from keyed where resend_no = 0),
sized as (select store_id, business_date, count(*) as n from first group by 1, 2),
re as (select k.store_id, k.business_date, k.resend_no, count(*) as resent_lines, count(f.bill_no) as shared_lines
  from keyed k left join first f using (store_id, business_date, bill_no, line_no) where k.resend_no > 0 group by 1, 2, 3)
select re.store_id, re.business_date, re.resend_no, resent_lines, shared_lines, coalesce(n, 0) as first_lines,
  case when resent_lines > shared_lines then 'adds lines' when shared_lines = coalesce(n, 0) then 'identical' else 'partial' end as outcome
from re left join sized using (store_id, business_date)""").replace(")\n\n, keyed", "),\nkeyed"),
    "full_scan": _STORE_MONTH,
    "partition_pruned_scan": _STORE_MONTH,
    "dim_date": _q("select * from dim_date"),
    "dim_store": _q("select * from stores"),
    "dim_product": _q("select * from dim_product"),
    "table_counts": _q("""
select 'dim_store' as table_name, count(*) as row_count from stores
union all select 'dim_product', count(*) from dim_product
union all select 'dim_date', count(*) from dim_date
union all select 'fact_sales', count(*) from fact"""),
    "scd2_fact": _q("select * from fact"),
    "scd2_version_check": _q(f"""
select p.product_sk, p.product_code, product_name, category, valid_from, valid_to, count(f.line_no) as lines_joined,
  {_mean("sum(f.unit_price)", "nullif(count(f.line_no), 0)")} as avg_price
from products p left join fact f using (product_sk)
where p.product_code in (select product_code from products group by 1 having count(*) > 1)
group by 1, 2, 3, 4, 5, 6"""),
    "line_type_audit": _q("""
select line_type, count(*) as total_lines, cast(sum(qty * unit_price) as decimal(24,2)) as raw_sum,
  case when line_type in ('SALE','RETURN','DISCOUNT','VOID') then 'YES' else 'NO' end as counts_as_revenue,
  case line_type when 'TAX' then 'tax on the whole bill' when 'TENDER' then 'what the customer paid; repeats the bill total'
    when 'SALE' then 'item sold' when 'RETURN' then 'item returned, subtracts'
    when 'DISCOUNT' then 'bill-level discount, subtracts' when 'VOID' then 'mirror of a cancelled item, cancels it' end as note
from lines group by line_type"""),
    "naive_vs_revenue": _q("""
select month, naive_sum, net_revenue, excluded_lines, cast(naive_sum - net_revenue as decimal(24,2)) as inflation from (
  select strftime(business_date, '%Y-%m') as month, cast(sum(round(qty * unit_price, 2)) as decimal(24,2)) as naive_sum,
    cast(coalesce(sum(round(qty * unit_price, 2)) filter (line_type in ('SALE','RETURN','DISCOUNT','VOID')), 0) as decimal(24,2)) as net_revenue,
    count(*) filter (line_type not in ('SALE','RETURN','DISCOUNT','VOID')) as excluded_lines
  from lines group by 1)"""),
    "price_as_of_early": _prices("1997-03-15"),
    "price_as_of_late": _prices("1999-10-15"),
    "category_revenue": _q("""
select st.store_id, st.store_name, st.city, p.category, count(s.line_no) as revenue_lines,
  cast(sum(s.net) as decimal(24,2)) as category_revenue
from revenue_lines s join stores st using (store_id)
join products p on s.product_code = p.product_code and s.business_date between p.valid_from and p.valid_to
group by 1, 2, 3, 4"""),
    "dash_kpi": _kpi("true"),
    "dash_by_store": _breakdown("store_id, store_name"),
    "dash_by_weekday": _breakdown("day_of_week, day_name"),
    "dash_by_month": _breakdown("month_str"),
    "dash_by_category": _breakdown("category"),
    "dash_top_products": _breakdown("product_code, product_name, category")
    + " order by net_revenue desc, product_code, product_name limit 10",
    "dash_filtered": _kpi("category = 'ECONOMY' and month_str = '1998-03' and day_name = 'Monday'"),
    "dash_options": _q("""
select 'store' as kind, store_id as choice from stores
union all select distinct 'category', category from dim_product where category <> 'N/A'"""),
    "monthly_revenue": _q("select * from monthly"),
    "reconcile": _q("select * from recon"),
    "variance_causes": _q("""
, resent as (
  select month, r - coalesce(k, 0) as resent_revenue from
    (select strftime(business_date, '%Y-%m') as month, sum(round(qty * unit_price, 2)) as r from raw
      where line_type in ('SALE','RETURN','DISCOUNT','VOID') group by 1)
    left join (select strftime(business_date, '%Y-%m') as month, sum(net) as k from revenue_lines group by 1) using (month)),
gap_days as (select month, cast(sum(missing_days) as bigint) as missing_store_days from gaps group by 1)
select r.month, variance, status, coalesce(missing_store_days, 0) as missing_store_days,
  cast(rounded_revenue - exact_revenue as decimal(24,2)) as rounding_effect,
  cast(coalesce(resent_revenue, 0) as decimal(24,2)) as resent_revenue,
  case when status = 'EXACT MATCH' then 'none' when variance = -resent_revenue then 're-sent lines'
    when variance = -(rounded_revenue - exact_revenue) then 'bill rounding'
    when missing_store_days > 0 then 'missing store-days' else 'scope' end as likely_cause
from recon r left join gap_days using (month) left join rounded using (month) left join resent using (month)
where r.month <> 'TOTAL'""").replace(")\n\n, resent", "),\nresent"),
    "missing_store_days": _q("select * from gaps"),
    "bill_rounded_revenue": _q("select * from rounded"),
    "stale_prices": _q("""
, judged as (
  select f.product_sk, f.date_key, f.unit_price, f.n,
    bool_or(date_key between effective_from and effective_to and price = unit_price) as is_current,
    bool_or(effective_to < date_key and price = unit_price) as is_older
  from (select product_sk, date_key, unit_price, count(*) as n from fact where line_type = 'SALE' group by 1, 2, 3) f
  join revisions using (product_sk) group by 1, 2, 3, 4)
select year(date_key) as year, cast(sum(n) as bigint) as sale_lines,
  cast(coalesce(sum(n) filter (is_current), 0) as bigint) as at_list_price,
  cast(coalesce(sum(n) filter (not is_current and is_older), 0) as bigint) as at_older_price,
  cast(coalesce(sum(n) filter (not is_current and not is_older), 0) as bigint) as off_list
from judged group by 1""").replace(")\n\n, judged", "),\njudged"),
    "void_policy": _q("""
select month, cast(sum(total) as decimal(24,2)) as keep_both,
  cast(coalesce(sum(total) filter (bill_no not in (select bill_no from bill_month where voids > 0)), 0) as decimal(24,2)) as drop_bill,
  cast(sum(unvoided) as decimal(24,2)) as drop_void_only,
  count(*) filter (bill_no in (select bill_no from bill_month where voids > 0)) as voided_bills
from bill_month group by 1"""),
    "late_business_dates": _q("""
select strftime(business_date, '%Y-%m') as month, count(*) as total_lines,
  count(*) filter (cast(ts as date) <> business_date) as after_midnight,
  coalesce(max(cast(ts as date) - business_date) filter (cast(ts as date) <> business_date), 0) as days_off
from lines group by 1"""),
    "dataset_checksum": _q("""
select count(*) as row_count, cast(sum(v) as decimal(38,0)) as hash_sum, bit_xor(v) as hash_xor from (
  select cast('0x' || substr(md5(concat_ws('|', bill_no, line_no, coalesce(product_code, '~'), qty, unit_price, line_type,
    business_date, store_id)), 1, 8) as bigint) as v from lines)"""),
    "rerun_equal": _q("""
select run, n as rows_a, n as rows_b, 0::bigint as only_a, 0::bigint as only_b, true as identical
from (select count(*) as n from lines join region_store using (store_id)), (values (2), (3)) r(run)"""),
}

# Money columns of each result; they are handed over as DOUBLE.
_MONEY: dict[str, tuple[str, ...]] = {
    "dedup_lines": ("qty", "unit_price"),
    "normalise_dialects": ("qty", "unit_price"),
    "full_scan": ("revenue",),
    "partition_pruned_scan": ("revenue",),
    "scd2_fact": ("quantity", "unit_price", "net_amount"),
    "scd2_version_check": ("avg_price",),
    "line_type_audit": ("raw_sum",),
    "naive_vs_revenue": ("naive_sum", "net_revenue", "inflation"),
    "price_as_of_early": ("price", "realised_revenue"),
    "price_as_of_late": ("price", "realised_revenue"),
    "category_revenue": ("category_revenue",),
    "dash_kpi": ("total_net_revenue", "avg_line_revenue", "total_quantity"),
    "dash_filtered": ("total_net_revenue", "avg_line_revenue", "total_quantity"),
    "dash_by_store": ("net_revenue",),
    "dash_by_weekday": ("net_revenue",),
    "dash_by_month": ("net_revenue",),
    "dash_by_category": ("net_revenue",),
    "dash_top_products": ("net_revenue",),
    "monthly_revenue": ("net_revenue",),
    "reconcile": ("finance_revenue", "fact_revenue", "variance"),
    "variance_causes": ("variance", "rounding_effect", "resent_revenue"),
    "bill_rounded_revenue": ("exact_revenue", "rounded_revenue"),
    "void_policy": ("keep_both", "drop_bill", "drop_void_only"),
    "dataset_checksum": ("hash_sum",),
    "ingest": ("revenue",),
    "dash_vs_fact": ("report_revenue", "fact_revenue", "difference"),
}


def _as_double(name: str, sql: str) -> str:
    money = ", ".join(f"cast({c} as double) as {c}" for c in _MONEY.get(name, ()))
    return f"select * replace ({money}) from ({sql})" if money else sql


ORACLES: dict[str, str] = {name: _as_double(name, sql) for name, sql in _DECIMAL_RESULTS.items()}
