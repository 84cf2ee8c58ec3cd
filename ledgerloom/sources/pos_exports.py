"""Point-of-sale export files: three CSV dialects and Parquet days, read into one schema.

Cells are read as text and found through the header of their own file: the CSV reader itself takes one
header for all files and the rest by position.  A byte-order mark is dropped by the reader.  Store, business date and re-send number come from the file's name, never from its content.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import materialise

# Fixed value: the naming contract of the exports.
FILE_NAME = r"SALES_(S[0-9]+)_([0-9]{4})([0-9]{2})([0-9]{2})(?:__R([0-9]+))?"
MONEY = "decimal(12,2)"
MOST_COLUMNS = 24
LINE_COLUMNS = ["bill_no", "line_no", "product_code", "qty", "unit_price", "line_type", "ts"]


@dataclass(frozen=True)
class Dialect:
    """How one till generation writes its files."""

    name: str
    stores: tuple[str, ...]
    separator: str
    stamp: str
    renames: dict[str, str] = field(default_factory=dict)
    bom: bool = False

    def parse_stamp(self, text: Column) -> Column:
        if self.stamp == "epoch":
            return F.timestamp_seconds(text.cast("bigint"))
        return F.try_to_timestamp(text, F.lit(self.stamp))


DIALECTS = (
    Dialect("A", ("S01", "S02", "S03", "S04", "S05"), ",", "yyyy-MM-dd'T'HH:mm:ss"),
    Dialect(
        "B", ("S06", "S07", "S08", "S09"), ";", "dd-MM-yyyy HH:mm:ss",
        {"item_code": "product_code", "quantity": "qty", "rate": "unit_price", "type": "line_type", "txn_time": "ts"},
    ),
    Dialect("C", ("S10", "S11", "S12"), ",", "epoch", bom=True),
)


def file_facts(path: Column) -> dict[str, Column]:
    """Store, date parts, business date and re-send number from a file path."""
    part = lambda group: F.regexp_extract(path, FILE_NAME, group)
    resend = part(5)
    return {
        "store_id": part(1),
        "year": part(2),
        "month": part(3),
        "day": part(4),
        "business_date": F.try_to_date(F.concat(part(2), part(3), part(4)), "yyyyMMdd"),
        "resend_no": F.when(resend == "", 0).otherwise(F.try_to_number(resend, F.lit("999999"))).cast("int"),
    }


def _typed(rows: DataFrame, stamp: Column) -> DataFrame:
    facts = file_facts(F.col("file_path"))
    return rows.select(
        F.col("bill_no").cast("string").alias("bill_no"),
        F.col("line_no").try_cast("int").alias("line_no"),
        F.when(F.col("product_code") != "", F.col("product_code")).alias("product_code"),
        F.col("qty").try_cast(MONEY).alias("qty"),
        F.col("unit_price").try_cast(MONEY).alias("unit_price"),
        F.col("line_type").cast("string").alias("line_type"),
        stamp.alias("ts"),
        *[facts[name].alias(name) for name in ("business_date", "store_id", "year", "month", "day", "resend_no")],
    )


def read_csv_dialect(spark: SparkSession, root: str, dialect: Dialect) -> DataFrame:
    """All CSV exports of one dialect under ``root``; files may order their columns differently and hold further ones.

    A header is the line that names all columns; a file without one is an error.
    """
    paths = [f"{root}/*SALES_{store}_*" for store in dialect.stores]
    cells = [f"c{k}" for k in range(MOST_COLUMNS)]
    lines = (
        spark.read.schema(", ".join(f"{c} string" for c in cells))
        .option("sep", dialect.separator)
        .option("pathGlobFilter", "*.csv")
        .option("ignoreMissingFiles", True)
        .csv(existing(spark, paths))
        .select(F.array(*cells).alias("cells"), F.col("_metadata.file_path").alias("file_path"))
    )
    own = {new: old for old, new in dialect.renames.items()}
    place = {c: F.array_position("cells", own.get(c, c)) for c in LINE_COLUMNS}
    header = F.lit(True)
    for at in place.values():
        header = header & (at > 0)
    # a row for every file, stored so that its size is known
    headers = materialise(lines.where(header).groupBy("file_path").agg(*[F.min(at).alias(f"at_{c}") for c, at in place.items()]), "headers")
    met = lines.where(~header).join(headers, "file_path", "left")

    def cell(name: str) -> Column:
        missing = F.raise_error(F.concat(F.lit("no header in "), F.col("file_path")))
        return F.when(F.col(f"at_{name}").isNull(), missing).otherwise(F.get("cells", F.col(f"at_{name}") - 1)).alias(name)

    return _typed(met.select(*[cell(c) for c in LINE_COLUMNS], "file_path"), dialect.parse_stamp(F.col("ts")))


def read_parquet_days(spark: SparkSession, root: str) -> DataFrame:
    """Export days that were written as Parquet, of any store; ``ts`` is a timestamp there."""
    rows = (
        spark.read.option("pathGlobFilter", "*.parquet")
        .parquet(*existing(spark, [f"{root}/*SALES_*"]))
        .select(*LINE_COLUMNS, F.col("_metadata.file_path").alias("file_path"))
    )
    return _typed(rows, F.col("ts").cast("timestamp"))


def existing(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Those glob patterns that match something; a reader refuses one that does not."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        hits = path.getFileSystem(conf).globStatus(path)
        if hits is not None and len(hits) > 0:
            found.append(pattern)
    return found


def read_exports(spark: SparkSession, root: str, parquet_days: bool = False) -> DataFrame:
    """Every export under ``root`` in the normalised schema, all dialects together."""
    parts = [
        read_csv_dialect(spark, root, dialect)
        for dialect in DIALECTS
        if existing(spark, [f"{root}/*SALES_{store}_*" for store in dialect.stores])
    ]
    if parquet_days:
        parts.append(read_parquet_days(spark, root))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_exports(lines: DataFrame, root: str, dialect: Dialect, dealt: bool = False) -> None:
    """Write normalised lines of one dialect's stores as its till software would.

    One folder per export carries the file name's stem, since Spark names the files inside.  Lines that are ``dealt`` to
    tasks by export stay where they are.
    """
    stem = F.concat(
        F.lit("SALES_"), "store_id", F.lit("_"), F.date_format("business_date", "yyyyMMdd"),
        F.when(F.col("resend_no") > 0, F.concat(F.lit("__R"), F.col("resend_no").cast("string"))).otherwise(""),
    )
    if dialect.stamp == "epoch":
        stamp = F.unix_timestamp("ts").cast("string")
    else:
        stamp = F.date_format("ts", dialect.stamp)
    back = {new: old for old, new in dialect.renames.items()}
    order = list(reversed(LINE_COLUMNS)) if dialect.bom else LINE_COLUMNS
    values = lines.where(F.col("store_id").isin(*dialect.stores)).withColumn("ts", stamp)
    out = values.select(stem.alias("export"), *[F.col(c).cast("string").alias(back.get(c, c)) for c in order])
    (
        (out if dealt else out.hint("rebalance", "export"))
        .write.mode("append")
        .option("header", True)
        .option("sep", dialect.separator)
        .partitionBy("export")
        .csv(f"{root}/{dialect.name}")
    )
