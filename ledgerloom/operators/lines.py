"""Sales-line operators: deduplication, audits and line-level checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE_KEY = ["bill_no", "line_no"]
# What counts as revenue.
REVENUE_TYPES = ["SALE", "RETURN", "DISCOUNT", "VOID"]
LINE_TYPE_NOTES = {
    "TAX": "tax on the whole bill",
    "TENDER": "what the customer paid; repeats the bill total",
    "SALE": "item sold",
    "RETURN": "item returned, subtracts",
    "DISCOUNT": "bill-level discount, subtracts",
    "VOID": "mirror of a cancelled item, cancels it",
}


def is_revenue() -> Column:
    return F.col("line_type").isin(REVENUE_TYPES)


def net_amount() -> Column:
    return F.round(F.col("qty") * F.col("unit_price"), 2).cast("decimal(24,2)")


def dedup_lines(lines: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Keep one line per key: the smallest under the total order of all other columns.

    A plain minimum, so copies are reduced before the shuffle and a key with very many copies never
    gathers in one task; the survivor does not depend on file or row order.
    """
    key = key or LINE_KEY
    rest = [c for c in lines.columns if c not in key]
    kept = lines.groupBy(*key).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*key, "kept.*").select(*lines.columns)


def dedup_audit(lines: DataFrame, key: list[str] | None = None) -> DataFrame:
    """How many keys occur how often, and whether their copies agree in every column."""
    key = key or LINE_KEY
    rest = F.struct(*[c for c in lines.columns if c not in key])
    per_key = lines.groupBy(*key).agg(
        F.count("*").alias("copies"), (F.min(rest) != F.max(rest)).alias("copies_differ")
    )
    return per_key.groupBy("copies", "copies_differ").agg(
        F.count("*").alias("line_keys"), F.sum("copies").alias("raw_lines")
    )


def resend_audit(lines: DataFrame) -> DataFrame:
    """Per re-sent file: is it the same set of lines as the first export, a part of it, or more.

    Expects ``store_id, business_date, resend_no`` beside the line columns; 0 is the first export.
    """
    day = ["store_id", "business_date"]
    keyed = lines.groupBy(*day, "resend_no", *LINE_KEY).agg(F.count("*").alias("n"))
    first = keyed.where("resend_no = 0").select(*day, *LINE_KEY, F.lit(1).alias("in_first"))
    first_size = first.groupBy(*day).agg(F.count("*").alias("first_lines"))
    resent = (
        keyed.where("resend_no > 0")
        .join(first, [*day, *LINE_KEY], "left")
        .groupBy(*day, "resend_no")
        .agg(F.count("*").alias("resent_lines"), F.count("in_first").alias("shared_lines"))
        .join(first_size, day, "left")
        .withColumn("first_lines", F.coalesce("first_lines", F.lit(0)))
    )
    complete = F.col("shared_lines") == F.col("first_lines")
    return resent.withColumn(
        "outcome",
        F.when(F.col("resent_lines") > F.col("shared_lines"), "adds lines")
        .when(complete, "identical")
        .otherwise("partial"),
    )


def line_type_audit(lines: DataFrame) -> DataFrame:
    """Lines and raw sum per line type, with its standing as revenue."""
    note = F.lit(None).cast("string")
    for line_type, text in LINE_TYPE_NOTES.items():
        note = F.when(F.col("line_type") == line_type, text).otherwise(note)
    totals = lines.groupBy("line_type").agg(
        F.count("*").alias("total_lines"),
        F.sum(F.col("qty") * F.col("unit_price")).cast("decimal(24,2)").alias("raw_sum"),
    )
    return totals.select(
        "*", F.when(is_revenue(), "YES").otherwise("NO").alias("counts_as_revenue"), note.alias("note")
    )


def naive_vs_revenue(lines: DataFrame) -> DataFrame:
    """Per month: the sum over every line against the sum over revenue lines."""
    amount = net_amount()
    return (
        lines.groupBy(F.date_format("business_date", "yyyy-MM").alias("month"))
        .agg(
            F.sum(amount).cast("decimal(24,2)").alias("naive_sum"),
            F.coalesce(F.sum(F.when(is_revenue(), amount)), F.lit(0)).cast("decimal(24,2)").alias("net_revenue"),
            F.count_if(~is_revenue()).alias("excluded_lines"),
        )
        .withColumn("inflation", (F.col("naive_sum") - F.col("net_revenue")).cast("decimal(24,2)"))
    )


def void_policies(lines: DataFrame) -> DataFrame:
    """Monthly revenue under the three ways to treat cancelled bills.

    ``keep_both`` and ``drop_bill`` are the sound ones; ``drop_void_only`` shows the usual mistake.
    Lines are reduced to one row per bill and month before bills are compared.
    """
    void = F.col("line_type") == "VOID"
    per_bill = (
        lines.where(is_revenue())
        .groupBy("bill_no", F.date_format("business_date", "yyyy-MM").alias("month"))
        .agg(
            F.sum(net_amount()).alias("all_net"),
            F.coalesce(F.sum(F.when(~void, net_amount())), F.lit(0)).alias("unvoided_net"),
            F.count_if(void).alias("voids"),
        )
    )
    voided = per_bill.groupBy("bill_no").agg(F.sum("voids").alias("bill_voids")).where("bill_voids > 0")
    marked = per_bill.join(voided, "bill_no", "left")
    kept = F.when(F.col("bill_voids").isNull(), F.col("all_net"))
    return marked.groupBy("month").agg(
        F.sum("all_net").cast("decimal(24,2)").alias("keep_both"),
        F.coalesce(F.sum(kept), F.lit(0)).cast("decimal(24,2)").alias("drop_bill"),
        F.sum("unvoided_net").cast("decimal(24,2)").alias("drop_void_only"),
        F.count("bill_voids").alias("voided_bills"),
    )


def bill_rounded_revenue(lines: DataFrame) -> DataFrame:
    """Monthly revenue with each bill rounded to a whole unit, beside the exact sum."""
    per_bill = (
        lines.where(is_revenue())
        .groupBy("bill_no", F.date_format("business_date", "yyyy-MM").alias("month"))
        .agg(F.sum(net_amount()).alias("bill_total"))
    )
    return per_bill.groupBy("month").agg(
        F.sum("bill_total").cast("decimal(24,2)").alias("exact_revenue"),
        F.sum(F.round("bill_total", 0)).cast("decimal(24,0)").alias("rounded_revenue"),
        F.count("*").alias("bills"),
    )


def late_business_dates(lines: DataFrame) -> DataFrame:
    """Lines stamped after midnight: the calendar date of ``ts`` is not the business date."""
    late = F.to_date("ts") != F.col("business_date")
    return lines.groupBy(F.date_format("business_date", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("total_lines"),
        F.count_if(late).alias("after_midnight"),
        F.coalesce(F.max(F.when(late, F.datediff(F.to_date("ts"), "business_date"))), F.lit(0)).alias("days_off"),
    )


def missing_store_days(lines: DataFrame) -> DataFrame:
    """Runs of trading days on which a store delivered no line.

    Each store's calendar spans its own first to last day and is made by expanding a sequence.
    """
    present = lines.select("store_id", "business_date").distinct()
    spans = lines.groupBy("store_id").agg(F.min("business_date").alias("lo"), F.max("business_date").alias("hi"))
    calendar = spans.select("store_id", F.explode(F.sequence("lo", "hi")).alias("business_date"))
    return calendar.join(present, ["store_id", "business_date"], "left_anti")


def store_day_gaps(lines: DataFrame) -> DataFrame:
    """Missing trading days counted per store and month."""
    return missing_store_days(lines).groupBy(
        "store_id", F.date_format("business_date", "yyyy-MM").alias("month")
    ).agg(F.count("*").alias("missing_days"), F.min("business_date").alias("first_missing"))
