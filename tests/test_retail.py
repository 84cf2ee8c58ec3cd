import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lines as L
from ledgerloom.operators import profile, reporting, star
from ledgerloom.plans import retail
from ledgerloom.sources import lake, pos_exports, relations, tables
from ledgerloom.sources.tables import DISCOUNT_KEY, UNKNOWN_KEY

LINE = (
    "bill_no string, line_no int, product_code string, qty decimal(12,2), unit_price decimal(12,2), line_type string, "
    "ts timestamp, business_date date, store_id string, year string, month string, day string"
)


def line(bill, no, code, qty, price, kind, day="2024-06-01", store="S01", stamp=None):
    date = dt.date.fromisoformat(day)
    at = dt.datetime.fromisoformat(stamp or f"{day}T10:00:00")
    return (bill, no, code, D(qty), D(price), kind, at, date, store, day[:4], day[5:7], day[8:])


def frame(spark, rows):
    return spark.createDataFrame(rows, LINE)


@pytest.fixture(scope="module")
def products(spark):
    rows = [
        (1, "P1", "old", "Food", dt.date(2024, 1, 1), dt.date(2024, 5, 31)),
        (2, "P1", "new", "Care", dt.date(2024, 6, 1), dt.date(2099, 12, 31)),
        (3, "P2", "only", "Food", dt.date(2024, 1, 1), dt.date(2099, 12, 31)),
    ]
    return spark.createDataFrame(
        rows, "product_sk bigint, product_code string, product_name string, category string, valid_from date, valid_to date"
    )


def test_dedup_is_independent_of_order(spark):
    rows = [line("B1", 1, "P1", "2", "10", "SALE"), line("B1", 1, "P1", "2", "10", "SALE"),
            line("B1", 1, "P1", "1", "10", "SALE"), line("B1", 2, None, "1", "-1", "DISCOUNT")]
    forward = L.dedup_lines(frame(spark, rows)).orderBy("line_no").collect()
    backward = L.dedup_lines(frame(spark, rows[::-1])).orderBy("line_no").collect()
    assert forward == backward and len(forward) == 2 and forward[0]["qty"] == D("1.00")


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = frame(spark, [line("B1", 1, "P1", "2", "10", "SALE")])
    plan = L.dedup_lines(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") == 2 and "Window" not in plan


def test_version_join_takes_the_valid_version_once(spark, products):
    rows = [
        line("B1", 1, "P1", "1", "5", "SALE", "2024-05-31"), line("B2", 1, "P1", "1", "5", "SALE", "2024-06-01"),
        line("B3", 1, "P9", "1", "5", "SALE"), line("B4", 1, None, "1", "-2", "DISCOUNT"),
        line("B5", 1, None, "1", "9", "TAX"), line("B6", 1, "P2", "-1", "5", "VOID"),
    ]
    fact = {r["bill_no"]: r["product_sk"] for r in star.fact_sales(frame(spark, rows), products).collect()}
    assert fact == {"B1": 1, "B2": 2, "B3": UNKNOWN_KEY, "B4": DISCOUNT_KEY, "B6": 3}
    merged = star.fact_sales(frame(spark, rows), products, unknown_as_discount=True)
    assert merged.where("bill_no = 'B3'").first()["product_sk"] == DISCOUNT_KEY


def test_sentinel_is_added_once(products):
    twice = star.dim_product(star.dim_product(products))
    assert twice.where(F.col("product_sk") == DISCOUNT_KEY).count() == 1 and twice.count() == 5


def test_calendar(spark):
    days = star.dim_date(spark, "2024-01-01", "2024-12-31")
    assert days.count() == 366
    row = days.where("date_key = date'2024-02-24'").first()
    assert (row["day_name"], row["day_of_week"], row["is_weekend"], row["month_name"]) == ("Saturday", 6, True, "February")


def test_void_rules(spark):
    rows = [line("B1", 1, "P1", "1", "10", "SALE"), line("B1", 1, "P1", "-1", "10", "VOID"),
            line("B2", 1, "P1", "1", "7", "SALE")]
    row = L.void_policies(frame(spark, rows)).first()
    assert (row["keep_both"], row["drop_bill"], row["drop_void_only"], row["voided_bills"]) == (7, 7, 17, 1)


def test_revenue_excludes_tax_and_tender(spark):
    rows = [line("B1", 1, "P1", "2", "10", "SALE"), line("B1", 2, None, "1", "3", "TAX"), line("B1", 3, None, "1", "23", "TENDER")]
    row = L.naive_vs_revenue(frame(spark, rows)).first()
    assert (row["naive_sum"], row["net_revenue"], row["excluded_lines"]) == (46, 20, 2)


def test_half_cents_round_away_from_zero(spark):
    rows = [line("B1", 1, "P1", "0.50", "0.57", "SALE"), line("B1", 2, "P1", "-0.50", "0.57", "RETURN")]
    values = [r["net"] for r in frame(spark, rows).select(L.net_amount().alias("net")).collect()]
    assert values == [D("0.29"), D("-0.29")]


def test_missing_days_and_late_stamps(spark):
    rows = [line("B1", 1, "P1", "1", "1", "SALE", "2024-07-08"), line("B2", 1, "P1", "1", "1", "SALE", "2024-07-12"),
            line("B3", 1, "P1", "1", "1", "SALE", "2024-07-08", "S02", "2024-07-09T00:30:00")]
    gap = L.store_day_gaps(frame(spark, rows)).collect()
    assert [(g["store_id"], g["missing_days"], str(g["first_missing"])) for g in gap] == [("S01", 3, "2024-07-09")]
    assert L.late_business_dates(frame(spark, rows)).first()["after_midnight"] == 1


def test_bill_rounding(spark):
    rows = [line("B1", 1, "P1", "1", "10.40", "SALE"), line("B2", 1, "P1", "1", "10.60", "SALE")]
    row = L.bill_rounded_revenue(frame(spark, rows)).first()
    assert (row["exact_revenue"], row["rounded_revenue"], row["bills"]) == (D("21.00"), 21, 2)


def test_reconcile_tolerance_and_missing_month(spark):
    finance = spark.createDataFrame(
        [("2024-01", D("10.00")), ("2024-02", D("10.00")), ("2024-03", D("5.00"))], "month string, finance_revenue decimal(24,2)")
    monthly = spark.createDataFrame(
        [("2024-01", D("10.00")), ("2024-02", D("10.01")), ("2024-04", D("1.00"))], "month string, net_revenue decimal(24,2)")
    report = {r["month"]: r for r in reporting.reconcile(finance, monthly).collect()}
    assert set(report) == {"2024-01", "2024-02", "2024-03", "TOTAL"}
    assert report["2024-01"]["status"] == "EXACT MATCH" and report["2024-02"]["status"] == "VARIANCE DETECTED"
    assert report["2024-03"]["variance"] is None and report["2024-03"]["status"] == "VARIANCE DETECTED"
    assert report["TOTAL"]["variance"] == D("-4.99")


def test_prices_keep_products_without_sales(spark, products):
    revisions = spark.createDataFrame(
        [(2, dt.date(2024, 6, 1), dt.date(2024, 12, 31), D("9.00")), (3, dt.date(2024, 1, 1), dt.date(2024, 6, 30), D("4.00")),
         (3, dt.date(2024, 7, 1), dt.date(2024, 12, 31), D("5.00"))],
        "product_sk bigint, effective_from date, effective_to date, price decimal(12,2)")
    fact = star.fact_sales(frame(spark, [line("B1", 1, "P1", "3", "9", "SALE", "2024-06-20")]), products)
    rows = {r["product_code"]: r for r in reporting.prices_as_of(revisions, products, fact, "2024-06-30").collect()}
    assert (rows["P1"]["units_sold_month"], rows["P1"]["price"]) == (3, D("9.00"))
    assert (rows["P2"]["units_sold_month"], rows["P2"]["realised_revenue"], rows["P2"]["price"]) == (0, 0, D("4.00"))
    assert reporting.prices_as_of(revisions, products, fact, "2024-06-30", ["P2"]).count() == 1


def test_slices_compose(spark, products):
    stores = spark.createDataFrame([("S01", "one"), ("S02", "two")], "store_id string, store_name string")
    sold = frame(spark, [line("B1", 1, "P1", "1", "5", "SALE", "2024-06-03"), line("B2", 1, "P2", "2", "5", "SALE", "2024-06-04"),
                         line("B3", 1, "P2", "1", "4", "SALE", "2024-07-01", "S02")])
    dates = star.dim_date(spark, "2024-01-01", "2024-12-31")

    def kpi(**where):
        return reporting.kpis(reporting.sliced(star.fact_sales(sold, products), stores, star.dim_product(products), dates,
                                               reporting.Slice(**where))).first()

    assert kpi()["total_net_revenue"] == 19 and kpi(store_id="S02")["total_lines"] == 1
    assert kpi(category="Food", month="2024-06")["total_net_revenue"] == 10
    assert kpi(weekday="Monday")["total_net_revenue"] == 9 and kpi(month="2023-01")["total_net_revenue"] is None


def test_reports_keep_unknown_codes_and_days(spark, products):
    stores = spark.createDataFrame([("S01", "one")], "store_id string, store_name string")
    sold = frame(spark, [line("B1", 1, "P1", "1", "5", "SALE"), line("B2", 1, "P9", "2", "5", "SALE"), line("B3", 1, "P2", "1", "4", "SALE", "2003-07-01"),
                         line("B4", 1, None, "1", "-1", "DISCOUNT"), line("B5", 1, "P2", "1", "3", "SALE", store="S99")])
    fact = star.fact_sales(sold, products)
    rows = reporting.sliced(fact, stores, star.dim_product(products), star.dim_date_for(sold), reporting.Slice())
    assert reporting.kpis(rows).first()["total_lines"] == 5
    gap = reporting.kpi_gap(rows, fact).first()
    assert gap["report_lines"] == gap["fact_lines"] == 5 and gap["difference"] == 0
    assert {r["category"]: r["net_revenue"] for r in reporting.breakdown(rows, "category").collect()}["Unknown"] == 14


def test_every_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "SALES_S01_20241014.csv").write_text(
        "bill_no,line_no,product_code,qty,unit_price,line_type,ts\nB1,1,P1,2,10.50,SALE,2024-10-14T13:45:02\n")
    (tmp_path / "SALES_S02_20241014.csv").write_text(
        "line_no,bill_no,till,unit_price,qty,line_type,ts,product_code\n7,B2,t1,99.00,3,SALE,2024-10-14T13:45:02,P2\n")
    rows = {r["bill_no"]: r for r in pos_exports.read_exports(spark, str(tmp_path)).collect()}
    assert (rows["B2"]["line_no"], rows["B2"]["qty"], rows["B2"]["unit_price"], rows["B2"]["product_code"]) == (7, 3, 99, "P2")
    assert (rows["B1"]["line_no"], rows["B1"]["qty"], rows["B1"]["unit_price"]) == (1, 2, D("10.50")) and len(rows) == 2
    (tmp_path / "SALES_S03_20241014.csv").write_text("B3,1,P1,2,10.50,SALE,2024-10-14T13:45:02\n")
    with pytest.raises(Exception, match="no header in"):
        pos_exports.read_exports(spark, str(tmp_path)).collect()


def test_dialects_names_and_resends(spark, tmp_path):
    (tmp_path / "SALES_S01_20241014.csv").write_text(
        "bill_no,line_no,product_code,qty,unit_price,line_type,ts\nB1,1,P1,2,10.50,SALE,2024-10-14T13:45:02\n"
        "B2,1,P2,1,4.00,SALE,2024-10-15T00:30:00\n")
    (tmp_path / "SALES_S01_20241014__R1.csv").write_text(
        "bill_no,line_no,product_code,qty,unit_price,line_type,ts\nB1,1,P1,2,10.50,SALE,2024-10-14T13:45:02\n")
    (tmp_path / "SALES_S07_20241014.csv").write_text(
        "bill_no;line_no;item_code;quantity;rate;type;txn_time\nB3;1;P3;1;3.00;SALE;14-10-2024 09:00:00\n")
    (tmp_path / "SALES_S11_20241014.csv").write_bytes(
        b"\xef\xbb\xbfts,line_type,unit_price,qty,product_code,line_no,bill_no\n1728896402,DISCOUNT,-1.00,1,,2,B4\n")
    rows = {(r["bill_no"], r["resend_no"]): r for r in pos_exports.read_exports(spark, str(tmp_path)).collect()}
    assert len(rows) == 5
    assert rows["B4", 0]["ts"] == dt.datetime(2024, 10, 14, 9, 0, 2) and rows["B4", 0]["product_code"] is None
    assert rows["B3", 0]["ts"] == dt.datetime(2024, 10, 14, 9) and rows["B3", 0]["store_id"] == "S07"
    assert rows["B2", 0]["business_date"] == dt.date(2024, 10, 14) and rows["B2", 0]["month"] == "10"
    audit = L.resend_audit(pos_exports.read_exports(spark, str(tmp_path))).collect()
    assert [(a["resent_lines"], a["first_lines"], a["outcome"]) for a in audit] == [(1, 2, "partial")]


def test_parquet_days_join_the_csv_days(spark, tmp_path):
    (tmp_path / "SALES_S02_20241014.csv").write_text(
        "bill_no,line_no,product_code,qty,unit_price,line_type,ts\nB1,1,P1,2,10.50,SALE,2024-10-14T13:45:02\n")
    day = frame(spark, [line("B9", 1, "P1", "1", "2", "SALE", "2024-10-15", "S02")]).select(*pos_exports.LINE_COLUMNS)
    day.write.parquet(str(tmp_path / "SALES_S02_20241015.parquet"))
    rows = pos_exports.read_exports(spark, str(tmp_path), parquet_days=True)
    assert {(r["bill_no"], str(r["business_date"])) for r in rows.collect()} == {("B1", "2024-10-14"), ("B9", "2024-10-15")}


def test_lake_rerun_and_pruning(spark, tmp_path):
    base = str(tmp_path / "lake")
    rows = frame(spark, [line("B1", 1, "P1", "1", "5", "SALE", "2024-01-05"), line("B2", 1, "P1", "1", "5", "SALE", "2024-02-05", "S02")])
    lake.land(rows, base)
    first = profile.checksum(lake.scan(spark, base)).first()
    lake.land(rows, base)
    assert profile.checksum(lake.scan(spark, base)).first() == first and first["row_count"] == 2
    pruned = lake.scan(spark, base).where("year = '2024' and month = '01' and store = 'S01'")
    assert lake.files_read(pruned).first()["files"] == 1 and lake.files_read(lake.scan(spark, base)).first()["files"] == 2
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()
    listed = lake.listing_summary(spark, base).orderBy("month").collect()
    assert [(r["month"], r["store"], r["files"]) for r in listed] == [("01", "S01", 1), ("02", "S02", 1)]


def test_same_rows_sees_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    row = profile.same_rows(a, b).first()
    assert (row["only_a"], row["only_b"], row["identical"]) == (1, 1, False)
    assert profile.same_rows(a, a).first()["identical"]


def test_readers(spark, tmp_path):
    (tmp_path / "part-1.csv").write_text(
        'notice_id,portal_id,published_at,title,body,estimated_value,closing_date\nN1,P001,2024-01-01,T,"two\nlines, ""quoted""",100,2024-02-01\n')
    (tmp_path / "book.csv").write_text("month,closed_on,revenue_inr,signed_off_by\n2024-01,2024-02-09,10.50,X\n")
    (tmp_path / "pairs.csv").write_text("notice_id_a,notice_id_b,label\nN2,N1,same\nN1,N3,different\n")
    notice = relations.read_notices(spark, str(tmp_path / "part-*.csv")).first()
    assert notice["body"] == 'two\nlines, "quoted"' and notice["estimated_value"] == 100
    assert relations.read_finance_book(spark, str(tmp_path / "book.csv")).first()["finance_revenue"] == D("10.50")
    pairs = {(r["id_a"], r["id_b"]): r["is_same"] for r in relations.read_labelled_pairs(spark, str(tmp_path / "pairs.csv")).collect()}
    assert pairs == {("N1", "N2"): True, ("N1", "N3"): False}
    with pytest.raises(ValueError):
        relations.relation(spark, "stores")


def test_landed_tables_follow_their_files(spark, tmp_path):
    source, made = tmp_path / "documents.parquet", []

    def put(rows, mode):
        spark.createDataFrame(rows, "k int, v string").write.mode(mode).parquet(str(source))

    def build():
        made.append(1)
        return spark.read.parquet(str(source)).groupBy("k").agg(F.max("v").alias("v"))

    ask = lambda: {(r["k"], r["v"]) for r in lake.once(spark, "t", [str(source)], ["k"], build).select(F.col("k").cast("int"), "v").collect()}
    put([(1, "a"), (2, "b")], "overwrite")
    assert ask() == ask() == {(1, "a"), (2, "b")} and len(made) == 1
    before = lake.once(spark, "t", [str(source)], ["k"], build)
    put([(1, "c")], "append")
    assert ask() == {(1, "c"), (2, "b")} and len(made) == 2
    assert {r["v"] for r in before.collect()} == {"a", "b"}
    put([(3, "d")], "overwrite")
    assert ask() == ask() == {(3, "d")} and len(made) == 3


def test_versions_are_searched_inside_a_code(spark):
    day = lambda k: dt.date(2020, 1, 1) + dt.timedelta(days=k)
    versions = [("many", 10_000 + k, day(3 * k), day(3 * k + 1)) for k in range(1000)]  # every third day has none
    versions += [("twice", 1, day(0), day(10)), ("twice", 2, day(5), day(20)), ("open", 3, day(4), None), ("once", 4, day(7), day(7))]
    products = spark.createDataFrame(versions, "product_code string, product_sk long, valid_from date, valid_to date")
    asked = [(code, k) for code, days in (("many", range(-2, 3004)), ("twice", range(-1, 23)), ("open", range(8)), ("once", range(5, 9)), ("none", [1]), (None, [1])) for k in days]
    lines = spark.createDataFrame([(f"b{i}", 1, code, day(k)) for i, (code, k) in enumerate(asked)], "bill_no string, line_no int, product_code string, business_date date")
    want = {}
    for i, (code, k) in enumerate(asked):
        want[f"b{i}"] = sorted(sk for c, sk, a, b in versions if c == code and b is not None and a <= day(k) <= b) or [None]
    got = {}
    for r in star.join_version(lines, products).collect():
        got.setdefault(r["bill_no"], []).append(r["product_sk"])
    assert {k: sorted(v, key=str) for k, v in got.items()} == want
    inner = star.join_version(lines, products, "inner").collect()
    assert sorted((r["bill_no"], r["product_sk"]) for r in inner) == sorted((k, s) for k, v in want.items() for s in v if s is not None)


def test_quantile_sketches_keep_their_bound(spark):
    rows = spark.range(0, 50_000, 1, 7).select(
        F.concat(F.lit("p"), F.least(F.col("id") % 13, F.lit(5))).alias("portal_id"), (F.col("id") * F.col("id") % 65_521).alias("a"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("b"), F.lit(None).cast("long").alias("c"),
    )
    measures = {"a": F.col("a"), "b": F.col("b")}
    for k in (64, 200):
        checked = profile.sketch_check(rows, measures, "portal_id", k=k).collect()
        assert len(checked) == 14 and all(r["in_bounds"] and r["row_count"] == 50_000 for r in checked)
    merged = profile.merged_sketches(profile.quantile_sketches(rows, measures, ["portal_id"]), ["a", "b"])
    exact = {r["measure"]: r for r in profile.distribution(rows, measures).collect()}
    read = {r["measure"]: r for r in profile.sketched_quantiles(merged, ["a", "b"], profile.LENGTH_SHARES).collect()}
    assert abs(read["a"]["p50"] - exact["a"]["p50"]) < 65_521 * 0.03 and read["b"]["p25"] == 7


def test_dates_in_parts_are_not_carried_through_the_deduplication(spark, tmp_path):
    rows = [(1 + k % 3, 1 + k % 2, 7, 5, float(1 + k % 4), 10.0 * (k % 5), "RNA"[k % 3], "OF"[k % 2], None if k == 11 else f"199{k % 6}-0{1 + k % 9}-1{k % 9}") for k in range(40)]
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, day string"
    table = spark.createDataFrame(rows, columns).withColumn("l_shipdate", F.to_timestamp("day")).drop("day")
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = retail.deduplicated(spark, str(tmp_path))
    stated = L.dedup_lines(tables.raw_sales_lines(spark, str(tmp_path)))
    assert found.columns == stated.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, stated.collect())) and found.count() == 6
    struct = next(x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x)
    assert "business_date" in struct and "year" not in struct


def test_rows_are_compared_by_group_digests_and_counted_where_these_differ(spark):
    a = spark.range(2000).selectExpr("id % 700 as x", "if(id % 5 = 0, null, string(id % 3)) as y")
    b = a.union(spark.createDataFrame([(5, None), (9000, "z")], "x bigint, y string")).where("x <> 11")
    want_a, want_b = (Counter(map(tuple, rows.collect())) for rows in (a, b))
    row = profile.same_rows(a, b, groups=16).first()
    assert (row["rows_a"], row["rows_b"]) == (sum(want_a.values()), sum(want_b.values()))
    assert (row["only_a"], row["only_b"], row["identical"]) == (sum((want_a - want_b).values()), sum((want_b - want_a).values()), False)
    shuffled = profile.same_rows(a.repartition(5, "y"), a, groups=16)
    assert shuffled.first()["identical"] and "group" in shuffled._jdf.queryExecution().optimizedPlan().toString()
    nothing = profile.same_rows(a.limit(0), a.limit(0)).first()
    assert (nothing["rows_a"], nothing["identical"]) == (None, None)


def test_lines_are_shuffled_without_what_follows_from_them(spark, tmp_path):
    rows = [(k % 7 if k % 9 else None, 1 + k % 2, k % 5, 1 + k % 3, float(k), 2.0 * k, "RNA"[k % 3], "OF"[k % 2], dt.datetime(1995, 1 + k % 3, 2, k % 24, 30)) for k in range(60)]
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    stated = L.dedup_lines(tables.raw_sales_lines(spark, str(tmp_path)))
    assert sorted(map(str, retail.deduplicated(spark, str(tmp_path)).collect())) == sorted(map(str, stated.collect()))
    lake.land(retail.deduplicated_facts(spark, str(tmp_path)), str(tmp_path / "lake"), slot=retail.store_month_slot(), finish=tables.sales_lines)
    landed = lake.scan(spark, str(tmp_path / "lake")).select(*stated.columns)
    assert profile.same_rows(stated, landed).first()["identical"]
    plan = retail.deduplicated(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    struct = next(x for x in plan.splitlines() if "Aggregate" in x)
    assert "clock" in struct and "ts" not in struct.replace("structs", "") and "bill_no" not in struct


def test_a_large_export_is_written_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(retail, "EXPORT_LINES", 10)
    lines = [(1 + k % 30, 1, k % 5, 1 + k % 2, 1.0, 2.0 + k % 3, "N", "O", dt.datetime(1995, 1, 2)) for k in range(90)]
    columns = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 0), (2, 1)], "s_suppkey bigint, s_nationkey bigint").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(0, 0), (1, 1)], "n_nationkey bigint, n_regionkey bigint").write.parquet(str(tmp_path / "nation.parquet"))
    found = retail.exports(spark, str(tmp_path)).groupBy("bill_no", "resend_no").count().collect()
    assert sorted((r["bill_no"], r["resend_no"], r["count"]) for r in found) == sorted((f"B{k}", n, 1) for k in range(1, 31) for n in range(3))
