"""Master-data relations and notice files from outside the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOTICE_SCHEMA = (
    "notice_id STRING, portal_id STRING, published_at STRING, title STRING, body STRING, "
    "estimated_value BIGINT, closing_date STRING"
)


def relation(spark: SparkSession, name: str, jdbc: dict[str, str] | None = None, parquet: str | None = None,
             split_by: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A relational table over JDBC (filters and columns are pushed down) or its Parquet stand-in.

    ``split_by`` is (numeric column, lowest, highest, parts) and reads a large table in parallel.
    """
    if jdbc is None:
        if parquet is None:
            raise ValueError("give jdbc options or a parquet folder")
        return spark.read.parquet(f"{parquet.rstrip('/')}/{name}.parquet")
    reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", name)
    if split_by:
        column, low, high, parts = split_by
        reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """CREATE OR REPLACE TABLE ... AS SELECT, in the warehouse or in a folder of its own."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def read_notices(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Notice CSV parts; bodies span lines and may hold quotes."""
    text = ", ".join(f"{c.split()[0]} STRING" for c in NOTICE_SCHEMA.split(", "))
    rows = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("enforceSchema", False).schema(text).csv(paths)
    )
    return rows.withColumn("estimated_value", F.col("estimated_value").try_cast("bigint"))


def read_finance_book(spark: SparkSession, path: str) -> DataFrame:
    """Signed-off monthly revenue: ``month, closed_on, revenue_inr, signed_off_by``."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        "month",
        F.col("closed_on").try_cast("date").alias("closed_on"),
        F.col("revenue_inr").try_cast("decimal(18,2)").alias("finance_revenue"),
        "signed_off_by",
    )


def read_labelled_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Adjudicated pairs with the smaller id first."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(
        F.least("notice_id_a", "notice_id_b").alias("id_a"),
        F.greatest("notice_id_a", "notice_id_b").alias("id_b"),
        (F.col("label") == "same").alias("is_same"),
    )
