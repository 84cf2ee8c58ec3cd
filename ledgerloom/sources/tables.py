"""The given Parquet tables, re-read as the relations the analytics need.

Money is DECIMAL throughout: binary rounding of half cents differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN_END = "2099-12-31"
REISSUE_DATE = "1998-06-01"
FIRST_DAY = "1995-01-01"
MONEY = "decimal(12,2)"
DISCOUNT_CODE = "DISCOUNT"
DISCOUNT_KEY = 0
UNKNOWN_CODE = "UNKNOWN"
UNKNOWN_KEY = -1
TITLE_PART = r"^[^\n.!?]*"


def location(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(location(sf_dir, name))


def product_code(partkey: Column) -> Column:
    return F.concat(F.lit("P"), partkey.cast("string"))


def store_code(suppkey: Column) -> Column:
    return F.concat(F.lit("S"), suppkey.cast("string"))


# In their own order, so that the place of a type in the list stands for it.
LINE_TYPES = ["DISCOUNT", "RETURN", "SALE", "TAX", "TENDER", "VOID"]


def _line_type() -> Column:
    flags = F.concat("l_returnflag", "l_linestatus")
    return (
        F.when(flags == "NO", "SALE")
        .when(flags == "NF", "DISCOUNT")
        .when(flags == "RF", "RETURN")
        .when(flags == "RO", "VOID")
        .when(flags == "AF", "TAX")
        .otherwise("TENDER")
    )


def _minutes(order_key: str, line_no: str) -> Column:
    return F.pmod(F.col(order_key) * 97 + F.col(line_no) * 31, F.lit(1530))


def sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``raw_sales_lines`` says of each line in few bytes, for steps that sort and shuffle whole lines.

    ``kind`` is the line type's place in ``LINE_TYPES``, ``clock`` the second of the day that the till stamp counts from, null
    where there is no stamp.  Facts of one key sort as their lines do.
    """
    lines = table(spark, sf_dir, "lineitem").withColumn("line_type", _line_type())
    single = F.col("line_type").isin("DISCOUNT", "TAX", "TENDER")
    negative = F.col("line_type").isin("RETURN", "VOID")
    qty = F.col("l_quantity").cast(MONEY)
    price = F.col("l_extendedprice").cast(MONEY)
    day = F.to_date("l_shipdate")
    clock = F.unix_timestamp("l_shipdate") - F.unix_timestamp(day.cast("timestamp"))
    return lines.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_no"),
        F.when(~single, product_code(F.col("l_partkey"))).alias("product_code"),
        F.when(single, F.lit(1).cast(MONEY)).when(negative, -qty).otherwise(qty).cast(MONEY).alias("qty"),
        F.when(F.col("line_type") == "DISCOUNT", -price).otherwise(price).cast(MONEY).alias("unit_price"),
        (F.array_position(F.array(*map(F.lit, LINE_TYPES)), F.col("line_type")) - 1).cast("tinyint").alias("kind"),
        day.alias("business_date"),
        F.when(_minutes("l_orderkey", "l_linenumber").isNotNull(), clock).cast("int").alias("clock"),
        store_code(F.col("l_suppkey")).alias("store_id"),
    )


def sales_lines(facts: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The lines that ``sales_facts`` stand for, and the columns of ``keep``."""
    started = F.unix_timestamp(F.col("business_date").cast("timestamp")) + F.col("clock")
    return facts.select(
        F.concat(F.lit("B"), F.col("order_key").cast("string")).alias("bill_no"),
        "line_no", "product_code", "qty", "unit_price",
        F.get(F.array(*map(F.lit, LINE_TYPES)), F.col("kind").cast("int")).alias("line_type"),
        F.timestamp_seconds(started + _minutes("order_key", "line_no") * 60).alias("ts"),
        "business_date", "store_id",
        *[F.date_format("business_date", form).alias(name) for name, form in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))],
        *keep,
    )


def raw_sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale lines with repeated ``(bill_no, line_no)`` keys, from ``lineitem``.

    The till stamp lies up to an hour and a half past midnight of the business date's end, as tills
    that close late write it; the business date itself stays ``l_shipdate``.
    """
    return sales_lines(sales_facts(spark, sf_dir))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store master data from ``supplier``, ``nation`` and ``region``."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            store_code(F.col("s_suppkey")).alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned product master from ``part``; every tenth code was reissued to another product."""
    part = table(spark, sf_dir, "part")
    reissued = F.col("p_partkey") % 10 == 0
    versions = F.when(reissued, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    first = F.col("version") == 0
    return part.select("*", F.explode(versions).alias("version")).select(
        (F.col("p_partkey") * 2 + 1 + F.col("version")).alias("product_sk"),
        product_code(F.col("p_partkey")).alias("product_code"),
        F.when(first, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" (reissued)"))).alias("product_name"),
        F.when(first, F.col("p_type")).otherwise(F.col("p_brand")).alias("category"),
        F.when(first, F.to_date(F.lit(FIRST_DAY))).otherwise(F.to_date(F.lit(REISSUE_DATE))).alias("valid_from"),
        F.when(first & reissued, F.date_sub(F.to_date(F.lit(REISSUE_DATE)), 1))
        .otherwise(F.to_date(F.lit(OPEN_END)))
        .alias("valid_to"),
    )


def price_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list price per product version and calendar year, for the years in which lines were sold."""
    price = F.col("p_retailprice").cast(MONEY)
    base = products(spark, sf_dir).join(
        table(spark, sf_dir, "part").select(product_code(F.col("p_partkey")).alias("product_code"), "p_retailprice"),
        "product_code",
    )
    sold = table(spark, sf_dir, "lineitem").agg(F.year(F.min("l_shipdate")).alias("lo"), F.year(F.max("l_shipdate")).alias("hi"))
    years = F.sequence(sold.select("lo").scalar(), sold.select("hi").scalar())
    return base.select("product_sk", "p_retailprice", F.explode(years).alias("y")).select(
        "product_sk",
        F.make_date("y", F.lit(1), F.lit(1)).alias("effective_from"),
        F.make_date("y", F.lit(12), F.lit(31)).alias("effective_to"),
        (price + (F.col("y") - 1995) * F.lit("2.50").cast("decimal(4,2)")).cast(MONEY).alias("price"),
    )


def finance_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A signed-off monthly book kept apart from the fact table.

    Taken from the revenue lines as the tills sent them, before deduplication, so that it differs
    from the fact table exactly where lines were re-sent.
    """
    return (
        raw_sales_lines(spark, sf_dir)
        .where(F.col("line_type").isin("SALE", "RETURN", "DISCOUNT", "VOID"))
        .groupBy(F.date_format("business_date", "yyyy-MM").alias("month"))
        .agg(F.sum(F.col("qty") * F.col("unit_price")).cast("decimal(24,2)").alias("finance_revenue"))
    )


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices from ``documents``: the title is the first sentence or line, the body is the rest."""
    docs = table(spark, sf_dir, "documents")
    title = F.regexp_extract("text", TITLE_PART, 0)
    return docs.select(
        F.col("doc_id").alias("notice_id"),
        F.col("source").alias("portal_id"),
        "lang",
        "n_chars",
        title.alias("title"),
        F.expr("substring(text, length(regexp_extract(text, '^[^\\\\n.!?]*', 0)) + 1)").alias("body"),
    )
