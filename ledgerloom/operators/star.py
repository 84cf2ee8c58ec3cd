"""Star schema: dimensions, the versioned-product join, and checks on it.

No join here forces a broadcast.  Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (statically or through adaptive execution) and otherwise
shuffles both sides, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.lines import is_revenue, net_amount
from ledgerloom.sources.tables import DISCOUNT_CODE, DISCOUNT_KEY, FIRST_DAY, OPEN_END, UNKNOWN_CODE, UNKNOWN_KEY

SPREAD = 4096


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "store_name", "city", "state")


def dim_product(products: DataFrame) -> DataFrame:
    """Product versions plus a row for bill-level discounts and one for codes without a valid version; safe to run again."""
    key = products.schema["product_sk"].dataType
    special = F.array(*[
        F.struct(F.lit(sk).cast(key).alias("product_sk"), F.lit(code).alias("product_code"), F.lit(name).alias("product_name"), F.lit(category).alias("category"))
        for sk, code, name, category in (
            (DISCOUNT_KEY, DISCOUNT_CODE, "Bill-Level Discount", "Promotions & Discounts"), (UNKNOWN_KEY, UNKNOWN_CODE, "Unknown Product", "Unknown"),
        )
    ])
    sentinels = products.sparkSession.range(1).select(F.inline(special)).withColumns(
        {"valid_from": F.to_date(F.lit(FIRST_DAY)), "valid_to": F.to_date(F.lit(OPEN_END))}
    )
    kept = products.where(~F.col("product_sk").isin(DISCOUNT_KEY, UNKNOWN_KEY))
    return kept.select(*sentinels.columns).unionByName(sentinels)


def calendar_columns(day: Column) -> list[Column]:
    weekday = F.weekday(day)
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("month_str"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.day(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday + 1).alias("day_of_week"),
        (weekday >= 5).alias("is_weekend"),
    ]


def dim_date(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day of a closed range."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d")
    )
    return days.select(*calendar_columns(F.col("d")))


def dim_date_for(lines: DataFrame) -> DataFrame:
    """The calendar of whole years that covers the business dates of ``lines``."""
    span = lines.agg(
        F.trunc(F.min("business_date"), "YEAR").alias("lo"),
        F.last_day(F.add_months(F.trunc(F.max("business_date"), "YEAR"), 11)).alias("hi"),
    )
    return span.select(F.explode(F.sequence("lo", "hi")).alias("d")).select(*calendar_columns(F.col("d")))


def intervals(versions: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """One row a key: its ``versions`` as an array of structs in the order of their start, and whether any two ``overlap``."""
    others = [c for c in versions.columns if c not in (key, start, end)]
    rows = versions.select(key, F.struct(F.col(start).alias("start"), F.col(end).alias("end"), *others).alias("v")).where("v.start IS NOT NULL")
    per_key = rows.groupBy(key).agg(F.array_sort(F.collect_list("v")).alias("versions"))
    v = F.col("versions")
    following = F.slice(v, F.lit(2), F.size(v))
    meet = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), following, lambda x, y: x["end"] >= y["start"])
    return per_key.withColumn("overlap", F.exists(meet, lambda m: F.coalesce(m, F.lit(False))))


def valid_on(versions: Column, overlap: Column, day: Column) -> Column:
    """The versions of an array from ``intervals`` that hold on a day, both ends inclusive: one, none, or several that overlap.

    The last version that started by then is found by bisection, in as many steps as the number of versions has bits.
    """
    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        started = F.get(versions, middle)["start"] <= day
        inside = state["low"] < state["high"]
        return F.struct(
            F.when(inside & started, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(inside & ~started, middle).otherwise(state["high"]).alias("high"),
        )

    bits = F.ceil(F.log2(F.size(versions) + 1)).cast("int")
    state = F.struct(F.lit(0).alias("low"), F.size(versions).alias("high"))
    started = F.aggregate(F.sequence(F.lit(1), F.greatest(bits, F.lit(1))), state, step, lambda s: s["low"])
    last = F.get(versions, started - 1)
    holds = lambda v: (v["start"] <= day) & (day <= v["end"])
    return F.when(overlap, F.filter(versions, holds)).otherwise(F.filter(F.array(last), lambda v: F.coalesce(day <= v["end"], F.lit(False))))


def join_version(lines: DataFrame, versions: DataFrame, how: str = "left") -> DataFrame:
    """Attach the product version valid on the business date (both ends inclusive).

    A code's versions are one row, searched inside it, so a code with many versions multiplies no lines.  Lines without a
    code would all meet in one shuffle partition; they get scattered keys that no product can have.
    """
    scattered = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("bill_no", "line_no"), F.lit(SPREAD)).cast("string"))
    keyed = lines.withColumn("join_code", F.coalesce("product_code", scattered))
    per_code = intervals(versions, "product_code", "valid_from", "valid_to").withColumnRenamed("product_code", "join_code")
    others = [c for c in versions.columns if c not in ("product_code", "valid_from", "valid_to")]
    joined = keyed.join(per_code, "join_code", how)
    explode = F.explode if how == "inner" else F.explode_outer
    found = joined.withColumn("valid", explode(valid_on(F.col("versions"), F.col("overlap"), F.col("business_date"))))
    return found.select(*lines.columns, *[F.col(f"valid.{c}").alias(c) for c in others])


def fact_sales(lines: DataFrame, products: DataFrame, unknown_as_discount: bool = False) -> DataFrame:
    """Revenue lines with the surrogate key of the product version that was valid.

    A discount gets the sentinel key.  A code without a valid version gets the unknown key, or the
    sentinel too when ``unknown_as_discount`` is set.
    """
    versions = products.select("product_code", "product_sk", "valid_from", "valid_to")
    no_version = F.lit(DISCOUNT_KEY)
    if not unknown_as_discount:
        no_version = F.when(F.col("product_code").isNull(), DISCOUNT_KEY).otherwise(UNKNOWN_KEY)
    return join_version(lines.where(is_revenue()), versions).select(
        "bill_no",
        "line_no",
        "store_id",
        F.coalesce("product_sk", no_version.cast("bigint")).alias("product_sk"),
        F.col("business_date").alias("date_key"),
        F.col("qty").alias("quantity"),
        "unit_price",
        net_amount().alias("net_amount"),
        "line_type",
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """One row per named table with its row count."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def version_check(fact: DataFrame, products: DataFrame) -> DataFrame:
    """For every code with more than one version: lines and mean price that landed on each."""
    sold = fact.groupBy("product_sk").agg(
        F.count("line_no").alias("lines_joined"), F.sum("unit_price").alias("price_sum")
    )
    reissued = products.groupBy("product_code").agg(F.count("*").alias("versions")).where("versions > 1")
    return (
        products.join(reissued, "product_code", "left_semi")
        .join(sold, "product_sk", "left")
        .select(
            "product_sk", "product_code", "product_name", "category", "valid_from", "valid_to",
            F.coalesce("lines_joined", F.lit(0)).alias("lines_joined"),
            F.round(F.col("price_sum") / F.col("lines_joined"), 2).cast("decimal(24,2)").alias("avg_price"),
        )
    )


def category_revenue(lines: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per store and product category over lake files and master data in one query.

    Lines are summed per store, code and day before they meet the master data.
    """
    daily = (
        lines.where(is_revenue() & F.col("product_code").isNotNull())
        .groupBy("store_id", "product_code", "business_date")
        .agg(F.count("line_no").alias("n"), F.sum(net_amount()).alias("net"))
    )
    p = products.select(F.col("product_code").alias("code"), "category", "valid_from", "valid_to")
    return (
        daily.join(
            p, (F.col("product_code") == F.col("code")) & F.col("business_date").between(F.col("valid_from"), F.col("valid_to"))
        )
        .groupBy("store_id", "category")
        .agg(F.sum("n").alias("revenue_lines"), F.sum("net").cast("decimal(24,2)").alias("category_revenue"))
        .join(stores.select("store_id", "store_name", "city"), "store_id")
        .select("store_id", "store_name", "city", "category", "revenue_lines", "category_revenue")
    )
