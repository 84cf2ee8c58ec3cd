"""Named queries that write the given tables in the formats of sources and sinks and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import reporting, star
from ledgerloom.plans import notice_inputs as N
from ledgerloom.plans import retail
from ledgerloom.plans.notice_sql import _TEXT, _q as _notice_q
from ledgerloom.plans.retail_sql import _as_double, _q
from ledgerloom.session import materialise, scratch_path
from ledgerloom.sources import lake, pos_exports, relations
from ledgerloom.sources import tables as S


def notice_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices written as CSV parts, line breaks and quotes included, and read back."""
    path = scratch_path(spark, "notice-csv")
    text = lambda value: F.lit(value).cast("string")
    rows = S.notices(spark, sf_dir).select(
        F.col("notice_id").cast("string").alias("notice_id"), "portal_id", text(None).alias("published_at"), "title", "body",
        F.col("n_chars").alias("estimated_value"), text(None).alias("closing_date"),
    )
    (
        rows.write.option("header", True).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    body = F.coalesce("body", F.lit(""))
    return relations.read_notices(spark, path).select(
        F.col("notice_id").cast("bigint").alias("notice_id"), "portal_id", F.col("estimated_value").alias("n_chars"),
        F.coalesce("title", F.lit("")).alias("title"), F.length(body).alias("body_chars"), F.md5(body).alias("body_md5"),
    )


def finance_book_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book written as its CSV file, read back, and reconciled with the fact table."""
    path = scratch_path(spark, "finance-csv")
    book = S.finance_book(spark, sf_dir).select(
        "month", F.last_day(F.to_date(F.concat("month", F.lit("-01")))).alias("closed_on"), F.col("finance_revenue").alias("revenue_inr"), F.lit("X").alias("signed_off_by")
    )
    book.write.option("header", True).csv(path)
    read = relations.read_finance_book(spark, path).select("month", F.col("finance_revenue").cast("decimal(24,2)").alias("finance_revenue"))
    return reporting.reconcile(read, reporting.monthly_revenue(retail.fact(spark, sf_dir)))


def label_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pairs written with either id first, and read back with the smaller one first."""
    path = scratch_path(spark, "label-csv")
    pairs = N.labelled(materialise(N.hashed(S.notices(spark, sf_dir)), "sets"))
    turned = F.col("id_a") % 2 == 0
    pairs.select(
        F.when(turned, F.col("id_b")).otherwise(F.col("id_a")).cast("string").alias("notice_id_a"),
        F.when(turned, F.col("id_a")).otherwise(F.col("id_b")).cast("string").alias("notice_id_b"),
        F.when(F.col("is_same"), "same").otherwise("different").alias("label"),
    ).write.option("header", True).csv(path)
    return relations.read_labelled_pairs(spark, path)


def parquet_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of all stores written as Parquet, one folder a store and day, and read back by their names."""
    path = scratch_path(spark, "parquet-days")
    raw = retail.region_lines(spark, sf_dir, S.raw_sales_lines(spark, sf_dir))
    stem = F.concat(F.lit("SALES_"), "store_id", F.lit("_"), F.date_format(F.last_day("business_date"), "yyyyMMdd"))
    out = raw.select(stem.alias("export"), *pos_exports.LINE_COLUMNS)
    out.hint("rebalance", "export").write.partitionBy("export").parquet(path)
    return pos_exports.read_parquet_days(spark, path).groupBy("store_id", "business_date").agg(
        F.count("*").alias("line_count"), F.sum("qty").cast("decimal(24,2)").alias("quantity")
    )


def stored_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star schema replaced as tables of the catalogue, and counted from there; the entries go once they are read."""
    fact = retail.fact(spark, sf_dir)
    tables = {
        "dim_store": star.dim_store(S.stores(spark, sf_dir)), "dim_product": star.dim_product(S.products(spark, sf_dir)),
        "dim_date": star.dim_date_for(S.raw_sales_lines(spark, sf_dir)), "fact_sales": fact,
    }
    run, stored = uuid.uuid4().hex, {}
    for name, df in tables.items():
        relations.replace_table(df, f"star_{name}_{run}", scratch_path(spark, name))
        stored[name] = spark.table(f"star_{name}_{run}")
        spark.sql(f"DROP TABLE star_{name}_{run}")
    return star.table_counts(**stored)


def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and revenue by type, written as a metrics file and read back."""
    path = scratch_path(spark, "metrics")
    lines = retail.lines(spark, sf_dir).groupBy("line_type").agg(F.count("*").alias("line_count"), F.sum("qty").cast("double").alias("quantity"))
    lake.write_metrics(lines, path)
    return spark.read.schema("line_type string, line_count bigint, quantity double").json(path)


QUERIES: dict[str, retail.Query] = {
    "notice_files": notice_files, "finance_book_file": finance_book_file, "label_file": label_file, "parquet_days": parquet_days,
    "stored_star": stored_star, "metric_report": metric_report,
}

ORACLES: dict[str, str] = {
    "notice_files": _notice_q("""
select notice_id, portal_id, n_chars, title, length(body)::int as body_chars, md5(body) as body_md5 from notices""", _TEXT),
    "finance_book_file": _as_double("reconcile", _q("select * from recon")),
    "label_file": _notice_q("""
select least(id_a::varchar, id_b::varchar) as id_a, greatest(id_a::varchar, id_b::varchar) as id_b, is_same from labelled"""),
    "parquet_days": _q("""
select store_id, last_day(business_date) as business_date, count(*) as line_count, cast(sum(qty) as double) as quantity
from (select r.* exclude (store_id), region_store as store_id from raw r join region_store using (store_id)) group by 1, 2"""),
    "stored_star": _q("""
select 'dim_store' as table_name, count(*) as row_count from stores union all select 'dim_product', count(*) from dim_product
union all select 'dim_date', count(*) from dim_date union all select 'fact_sales', count(*) from fact"""),
    "metric_report": _q("select line_type, count(*) as line_count, cast(sum(qty) as double) as quantity from lines group by 1"),
}
