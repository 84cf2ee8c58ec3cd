"""Named retail queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import lines as L
from ledgerloom.operators import profile, reporting, star
from ledgerloom.operators.ordered import union_all
from ledgerloom.session import materialise, scratch_path
from ledgerloom.sources import lake, pos_exports
from ledgerloom.sources import tables as S

Query = Callable[[SparkSession, str], DataFrame]
# Regions stand for stores where a query needs few files: they span all three dialects.
REGION_STORES = ("S01", "S05", "S06", "S09", "S12")
EARLY, LATE = "1997-03-15", "1999-10-15"


MONTHS = ["year", "month"]
#: Lines of an export from which on it is written in pieces.
EXPORT_LINES = 1_000_000


def _sources(sf_dir: str, *names: str) -> list[str]:
    return [S.location(sf_dir, name) for name in names]


def deduplicated_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines as ``sales_facts``: what follows from these is not sorted and shuffled with them."""
    return L.dedup_lines(S.sales_facts(spark, sf_dir), ["order_key", "line_no"])


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines."""
    return S.sales_lines(deduplicated_facts(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines, landed by month, again when their files change, and read from there."""
    columns = S.raw_sales_lines(spark, sf_dir).columns
    return lake.once(spark, "lines", _sources(sf_dir, "lineitem"), MONTHS, lambda: deduplicated(spark, sf_dir)).select(*columns)


def fact(spark: SparkSession, sf_dir: str, month: str | None = None) -> DataFrame:
    """The fact table, landed likewise; with ``month`` (``yyyy-MM``) only that month's folder is read."""
    def build() -> DataFrame:
        rows = star.fact_sales(lines(spark, sf_dir), S.products(spark, sf_dir))
        return rows.withColumns({"year": F.date_format("date_key", "yyyy"), "month": F.date_format("date_key", "MM")})

    rows = lake.once(spark, "fact", _sources(sf_dir, "lineitem", "part"), MONTHS, build)
    if month is not None:
        rows = rows.where((F.col("year") == month[:4]) & (F.col("month") == month[5:7]))
    return rows.drop(*MONTHS)


def region_lines(spark: SparkSession, sf_dir: str, raw: DataFrame) -> DataFrame:
    """Lines with the store replaced by a store of the supplier's region; these are stored, so that their size is known."""
    code = F.lit(None).cast("string")
    for key, store in enumerate(REGION_STORES):
        code = F.when(F.col("n_regionkey") == key, store).otherwise(code)
    by_supplier = (
        S.table(spark, sf_dir, "supplier")
        .join(S.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(S.store_code(F.col("s_suppkey")).alias("store_id"), code.alias("region_store"))
    )
    return raw.join(materialise(by_supplier, "region-stores"), "store_id").select(
        *[F.col("region_store").alias("store_id") if c == "store_id" else F.col(c) for c in raw.columns]
    )


def exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales lines written as export files of the three dialects and read back through the dialect readers.

    A till exports a month at a time, under its last day; later copies of a line key come in re-sends.
    """
    facts = region_lines(spark, sf_dir, S.sales_facts(spark, sf_dir)).withColumn("closed", F.last_day("business_date"))
    export = ["store_id", "closed"]
    crowded = materialise(
        facts.groupBy(*export).agg(F.ceil(F.count("*") / EXPORT_LINES).cast("int").alias("pieces")).where("pieces > 1"), "crowded"
    )
    piece = F.coalesce(F.pmod(F.xxhash64("order_key", "line_no"), "pieces"), F.lit(0)).cast("int")
    order = [F.asc_nulls_first("product_code"), *[F.col(c) for c in ("qty", "unit_price", "kind", "business_date", "clock")]]
    copy = F.row_number().over(Window.partitionBy(*export, "piece", "order_key", "line_no").orderBy(*order))
    root = scratch_path(spark, "exports")
    for dialect in pos_exports.DIALECTS:
        own = facts.where(F.col("store_id").isin(*dialect.stores)).join(crowded, export, "left").withColumn("piece", piece)
        # an export or its piece is in one place, for the numbers of its copies and for its files
        numbered = own.repartition(*export, "piece").withColumn("resend_no", copy - 1)
        monthly = S.sales_lines(numbered, ["closed", "resend_no"])
        pos_exports.write_exports(
            monthly.select(*pos_exports.LINE_COLUMNS, "store_id", F.col("closed").alias("business_date"), "resend_no"), root, dialect, dealt=True
        )
    return union_all([
        pos_exports.read_csv_dialect(spark, f"{root}/{d.name}", d.__class__(
            d.name, tuple(s for s in d.stores if s in REGION_STORES), d.separator, d.stamp, d.renames, d.bom))
        for d in pos_exports.DIALECTS
    ])


def store_month_slot() -> Column:
    """The place of a line in the lake, from what it has before its partition columns are there."""
    return F.hash(F.date_format("business_date", "yyyyMM"), "store_id")


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export files to the lake: read in their dialects, deduplicated over re-sends, landed, and counted by partition."""
    base = scratch_path(spark, "ingested")
    read = exports(spark, sf_dir).drop("resend_no")
    parts = ["year", "month", "day"]  # follow from the business date

    def whole(rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: F.date_format("business_date", form) for name, form in zip(parts, ("yyyy", "MM", "dd"), strict=True)}).select(*read.columns)

    lake.land(L.dedup_lines(read.drop(*parts)), base, slot=store_month_slot(), finish=whole)
    return lake.scan(spark, base).groupBy("year", "month", "store").agg(
        F.count("*").alias("line_count"), F.sum(F.when(L.is_revenue(), L.net_amount())).cast("decimal(24,2)").alias("revenue")
    )


def export_columns(df: DataFrame) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("ts", stamp)


def landed(spark: SparkSession, sf_dir: str) -> str:
    """The lake of deduplicated lines by year, month and region store, landed once for its files; its folder."""
    rows = lambda: region_lines(spark, sf_dir, deduplicated(spark, sf_dir)).withColumn("store", F.col("store_id"))
    return lake.once_path(spark, "lake", _sources(sf_dir, "lineitem", "supplier", "nation"), lake.PARTITIONS, rows)


def store_month(rows: DataFrame) -> DataFrame:
    return rows.where(L.is_revenue()).groupBy("store_id", "month").agg(
        F.count("*").alias("bill_lines"), F.sum(L.net_amount()).cast("decimal(24,2)").alias("revenue")
    )


def full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store-month found by the column inside the files: every file is opened."""
    rows = lake.scan(spark, landed(spark, sf_dir))
    return store_month(rows.where((F.col("store_id") == "S01") & (F.date_format("business_date", "yyyy-MM") == "1998-01")))


def pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store-month by partition columns: one folder is opened."""
    rows = lake.scan(spark, landed(spark, sf_dir))
    return store_month(rows.where("year = '1998' and month = '01' and store = 'S01'"))


def pruning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, bytes and rows behind the scan with and without partition filters."""
    rows = lake.scan(spark, landed(spark, sf_dir))
    pruned = rows.where("year = '1998' and month = '01' and store = 'S01'")
    return union_all([
        lake.files_read(df).select(F.lit(name).alias("scan"), "files", "bytes", "row_count")
        for name, df in (("full", rows), ("pruned", pruned))
    ])


def slice_rows(where: reporting.Slice) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reporting.sliced(
            fact(spark, sf_dir, where.month), star.dim_store(S.stores(spark, sf_dir)),
            star.dim_product(S.products(spark, sf_dir)), star.dim_date_for(S.raw_sales_lines(spark, sf_dir)), where,
        )

    return run


ALL = slice_rows(reporting.Slice())
SOME = slice_rows(reporting.Slice(category="ECONOMY", month="1998-03", weekday="Monday"))


def dash_vs_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.kpi_gap(ALL(spark, sf_dir), fact(spark, sf_dir))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.reconcile(S.finance_book(spark, sf_dir), reporting.monthly_revenue(fact(spark, sf_dir)))


def variance_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = S.raw_sales_lines(spark, sf_dir)
    kept = lines(spark, sf_dir)
    month = F.date_format("business_date", "yyyy-MM").alias("month")
    revenue = lambda df, name: df.where(L.is_revenue()).groupBy(month).agg(F.sum(L.net_amount()).alias(name))
    resent = revenue(raw, "r").join(revenue(kept, "k"), "month", "left").select(
        "month", (F.col("r") - F.coalesce("k", F.lit(0))).alias("resent_revenue")
    )
    report = reporting.reconcile(S.finance_book(spark, sf_dir), reporting.monthly_revenue(fact(spark, sf_dir)))
    return reporting.variance_causes(report, L.store_day_gaps(kept), L.bill_rounded_revenue(kept), resent)


def rerun_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the lake three times from scratch into the same place and compare the later results with the first."""
    base = scratch_path(spark, "rerun")

    def land() -> None:
        lake.land(region_lines(spark, sf_dir, deduplicated_facts(spark, sf_dir)), base, slot=store_month_slot(), finish=S.sales_lines)

    land()
    first = materialise(lake.scan(spark, base), "first-run")
    compared = []
    for run in (2, 3):
        land()
        compared.append(materialise(profile.same_rows(first, lake.scan(spark, base)), "rerun").select(F.lit(run).alias("run"), "*"))
    return union_all(compared)


CHECKSUM_COLUMNS = ["bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "business_date", "store_id"]

QUERIES: dict[str, Query] = {
    "dedup_lines": lambda s, d: export_columns(deduplicated(s, d)),
    "dedup_audit": lambda s, d: L.dedup_audit(S.raw_sales_lines(s, d)),
    "normalise_dialects": lambda s, d: export_columns(exports(s, d)),
    "file_name_facts": lambda s, d: exports(s, d).groupBy(
        "store_id", "business_date", "year", "month", "day", "resend_no").agg(F.count("*").alias("line_count")),
    "ingest": ingest,
    "resend_audit": lambda s, d: L.resend_audit(exports(s, d)),
    "lake_partition_listing": lambda s, d: lake.listing_summary(s, landed(s, d)),
    "full_scan": full_scan,
    "partition_pruned_scan": pruned_scan,
    "pruning_report": pruning_report,
    "dim_date": lambda s, d: star.dim_date_for(S.raw_sales_lines(s, d)),
    "dim_store": lambda s, d: star.dim_store(S.stores(s, d)),
    "dim_product": lambda s, d: star.dim_product(S.products(s, d)),
    "table_counts": lambda s, d: star.table_counts(
        dim_store=star.dim_store(S.stores(s, d)), dim_product=star.dim_product(S.products(s, d)),
        dim_date=star.dim_date_for(S.raw_sales_lines(s, d)), fact_sales=fact(s, d)),
    "scd2_fact": fact,
    "scd2_version_check": lambda s, d: star.version_check(fact(s, d), S.products(s, d)),
    "line_type_audit": lambda s, d: L.line_type_audit(lines(s, d)),
    "naive_vs_revenue": lambda s, d: L.naive_vs_revenue(lines(s, d)),
    "price_as_of_early": lambda s, d: reporting.prices_as_of(S.price_revisions(s, d), S.products(s, d), fact(s, d, EARLY[:7]), EARLY),
    "price_as_of_late": lambda s, d: reporting.prices_as_of(S.price_revisions(s, d), S.products(s, d), fact(s, d, LATE[:7]), LATE),
    "category_revenue": lambda s, d: star.category_revenue(lines(s, d), S.stores(s, d), S.products(s, d)),
    "dash_kpi": lambda s, d: reporting.kpis(ALL(s, d)),
    "dash_by_store": lambda s, d: reporting.breakdown(ALL(s, d), "store_id", "store_name"),
    "dash_by_weekday": lambda s, d: reporting.breakdown(ALL(s, d), "day_of_week", "day_name"),
    "dash_by_month": lambda s, d: reporting.breakdown(ALL(s, d), "month_str"),
    "dash_by_category": lambda s, d: reporting.breakdown(ALL(s, d), "category"),
    "dash_top_products": lambda s, d: reporting.top_products(ALL(s, d)),
    "dash_filtered": lambda s, d: reporting.kpis(SOME(s, d)),
    "dash_vs_fact": dash_vs_fact,
    "dash_options": lambda s, d: reporting.filter_options(S.stores(s, d), star.dim_product(S.products(s, d))),
    "monthly_revenue": lambda s, d: reporting.monthly_revenue(fact(s, d)),
    "reconcile": reconcile,
    "variance_causes": variance_causes,
    "missing_store_days": lambda s, d: L.store_day_gaps(lines(s, d)),
    "bill_rounded_revenue": lambda s, d: L.bill_rounded_revenue(lines(s, d)),
    "stale_prices": lambda s, d: reporting.stale_prices(fact(s, d), S.price_revisions(s, d)),
    "void_policy": lambda s, d: L.void_policies(lines(s, d)),
    "late_business_dates": lambda s, d: L.late_business_dates(lines(s, d)),
    "dataset_checksum": lambda s, d: profile.portable_checksum(lines(s, d), CHECKSUM_COLUMNS),
    "rerun_equal": rerun_equal,
}
