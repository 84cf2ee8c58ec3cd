"""Sliced revenue reports, point-in-time prices and reconciliation with a finance book."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(24,2)"
TOLERANCE = "0.01"


@dataclass(frozen=True)
class Slice:
    """Optional filters of a report; unset ones do not filter."""

    store_id: str | None = None
    category: str | None = None
    month: str | None = None
    weekday: str | None = None

    def predicate(self) -> Column:
        wanted = {
            "store_id": self.store_id,
            "category": self.category,
            "month_str": self.month,
            "day_name": self.weekday,
        }
        out = F.lit(True)
        for column, value in wanted.items():
            if value is not None:
                out = out & (F.col(column) == F.lit(value))
        return out


def sliced(fact: DataFrame, stores: DataFrame, products: DataFrame, dates: DataFrame, where: Slice) -> DataFrame:
    """Fact rows summed per store, product and day, joined to the three dimensions and filtered.

    A row without a match in a dimension stays, without that dimension's fields.
    """
    daily = fact.groupBy("store_id", "product_sk", "date_key").agg(
        F.count("*").alias("n"), F.sum("net_amount").alias("net"), F.sum("quantity").alias("qty")
    )
    return (
        daily.join(stores.select("store_id", "store_name"), "store_id", "left")
        .join(products.select("product_sk", "product_code", "product_name", "category"), "product_sk", "left")
        .join(dates.select("date_key", "month_str", "day_name", "day_of_week"), "date_key", "left")
        .where(where.predicate())
    )


def kpis(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_lines"),
        F.sum("net").cast(AMOUNT).alias("total_net_revenue"),
        F.round(F.sum("net") / F.sum("n"), 2).cast(AMOUNT).alias("avg_line_revenue"),
        F.sum("qty").cast(AMOUNT).alias("total_quantity"),
    )


def kpi_gap(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines and revenue of a report against the fact table; an unfiltered report has no difference."""
    total = fact.agg(F.count("*").alias("fact_lines"), F.sum("net_amount").cast(AMOUNT).alias("fact_revenue"))
    shown = kpis(rows)
    return total.select(
        shown.select("total_lines").scalar().alias("report_lines"), "fact_lines",
        shown.select("total_net_revenue").scalar().alias("report_revenue"), "fact_revenue",
    ).withColumn("difference", (F.col("report_revenue") - F.col("fact_revenue")).cast(AMOUNT))


def breakdown(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("net").cast(AMOUNT).alias("net_revenue"))


def top_products(rows: DataFrame, n: int = 10) -> DataFrame:
    """The best-selling product versions; ties go to the smaller code and name."""
    totals = breakdown(rows, "product_code", "product_name", "category")
    return totals.orderBy(F.desc("net_revenue"), "product_code", "product_name").limit(n)


def filter_options(stores: DataFrame, products: DataFrame) -> DataFrame:
    """Choices a report offers: every store and every distinct category."""
    store_rows = stores.select(F.lit("store").alias("kind"), F.col("store_id").alias("choice"))
    category = products.where(F.col("category") != "N/A").select(
        F.lit("category").alias("kind"), F.col("category").alias("choice")
    )
    return store_rows.unionByName(category.distinct()).orderBy("kind", "choice")


def prices_as_of(
    revisions: DataFrame, products: DataFrame, fact: DataFrame, as_of: str, codes: list[str] | None = None
) -> DataFrame:
    """List price in force on a day, with the units and revenue of that day's month.

    Products without a sale in the month stay, with zeros.  The month's sales are summed per product
    first, so the join carries at most one row per product.
    """
    day = F.lit(as_of).cast("date")
    month_start = F.trunc(day, "MM")
    sold = (
        fact.where(F.col("date_key").between(month_start, F.last_day(day)))
        .groupBy("product_sk")
        .agg(F.sum("quantity").alias("units"), F.sum("net_amount").alias("net"))
    )
    in_force = revisions.where(day.between(F.col("effective_from"), F.col("effective_to")))
    named = products if codes is None else products.where(F.col("product_code").isin(codes))
    return (
        in_force.join(named.select("product_sk", "product_code", "product_name", "category"), "product_sk")
        .join(sold, "product_sk", "left")
        .select(
            "product_code", "product_name", "category", "price", "effective_from", "effective_to",
            F.coalesce("units", F.lit(0)).cast("bigint").alias("units_sold_month"),
            F.coalesce("net", F.lit(0)).cast(AMOUNT).alias("realised_revenue"),
        )
    )


def stale_prices(fact: DataFrame, revisions: DataFrame) -> DataFrame:
    """Printed prices against the list, per year: right, equal to an older list price, or neither.

    Sales are first counted per product, day and printed price.  A product's list is one array, looked through in the
    row, so neither sales nor revisions are multiplied.
    """
    sales = fact.where(F.col("line_type") == "SALE").groupBy("product_sk", "date_key", "unit_price").agg(
        F.count("*").alias("n")
    )
    lists = revisions.groupBy("product_sk").agg(F.collect_list(F.struct("effective_from", "effective_to", "price")).alias("list"))
    day, printed = F.col("date_key"), F.col("unit_price")
    current = F.exists("list", lambda r: F.coalesce(day.between(r["effective_from"], r["effective_to"]) & (r["price"] == printed), F.lit(False)))
    older = F.exists("list", lambda r: F.coalesce((r["effective_to"] < day) & (r["price"] == printed), F.lit(False)))
    judged = sales.join(lists, "product_sk").select("date_key", "n", current.alias("is_current"), older.alias("is_older"))
    count = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    return judged.groupBy(F.year("date_key").alias("year")).agg(
        F.sum("n").alias("sale_lines"),
        count(F.col("is_current")).alias("at_list_price"),
        count(~F.col("is_current") & F.col("is_older")).alias("at_older_price"),
        count(~F.col("is_current") & ~F.col("is_older")).alias("off_list"),
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.date_format("date_key", "yyyy-MM").alias("month")).agg(
        F.sum("net_amount").cast(AMOUNT).alias("net_revenue"), F.count("*").alias("fact_lines")
    )


def reconcile(finance: DataFrame, monthly: DataFrame) -> DataFrame:
    """Finance book against the fact table by month, with a grand-total row.

    A finance month without sales has no variance and is reported as one.
    """
    joined = finance.select("month", "finance_revenue").join(
        monthly.select("month", F.col("net_revenue").alias("fact_revenue")), "month", "left"
    )
    totals = joined.groupBy().agg(
        F.lit("TOTAL").alias("month"),
        F.sum("finance_revenue").alias("finance_revenue"),
        F.sum("fact_revenue").alias("fact_revenue"),
    )
    variance = F.col("fact_revenue") - F.col("finance_revenue")
    exact = F.abs(variance) < F.lit(TOLERANCE).cast("decimal(4,2)")
    return joined.unionByName(totals).select(
        "month",
        F.col("finance_revenue").cast(AMOUNT).alias("finance_revenue"),
        F.col("fact_revenue").cast(AMOUNT).alias("fact_revenue"),
        variance.cast(AMOUNT).alias("variance"),
        F.when(exact, "EXACT MATCH").otherwise("VARIANCE DETECTED").alias("status"),
    )


def variance_causes(
    report: DataFrame, gaps: DataFrame, rounded: DataFrame, resent: DataFrame
) -> DataFrame:
    """Evidence beside each monthly variance: missing store-days, bill rounding, re-sent lines."""
    gap_days = gaps.groupBy("month").agg(F.sum("missing_days").alias("missing_store_days"))
    rounding = rounded.select(
        "month", (F.col("rounded_revenue") - F.col("exact_revenue")).cast(AMOUNT).alias("rounding_effect")
    )
    return (
        report.where(F.col("month") != "TOTAL")
        .join(gap_days, "month", "left")
        .join(rounding, "month", "left")
        .join(resent, "month", "left")
        .select(
            "month", "variance", "status",
            F.coalesce("missing_store_days", F.lit(0)).alias("missing_store_days"),
            "rounding_effect",
            F.coalesce("resent_revenue", F.lit(0)).cast(AMOUNT).alias("resent_revenue"),
            F.when(F.col("status") == "EXACT MATCH", "none")
            .when(F.col("variance") == -F.col("resent_revenue"), "re-sent lines")
            .when(F.col("variance") == -F.col("rounding_effect"), "bill rounding")
            .when(F.col("missing_store_days") > 0, "missing store-days")
            .otherwise("scope")
            .alias("likely_cause"),
        )
    )
