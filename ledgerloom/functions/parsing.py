"""Dates and amounts as they are written inside notice texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the notations in use ------------------------------------------------------
DATE_FORMATS = ("dd-MM-yyyy", "dd/MM/yyyy", "dd.MM.yyyy", "yyyy-MM-dd", "d MMM yyyy", "MMM d, yyyy", "d-MMM-yy")
DATE_SHAPES = (
    r"[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4}",
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    r"[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}",
    r"[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}",
    r"[0-9]{1,2}-[A-Z][a-z]{2}-[0-9]{2}",
)
LAKH, CRORE = 100_000, 10_000_000
# ---------------------------------------------------------------------------------------------
DATE_MENTION = rf"(?<![0-9A-Za-z])(?:{'|'.join(DATE_SHAPES)})(?![0-9A-Za-z])"
AMOUNT = r"([0-9][0-9,]*(?:\.[0-9]+)?)"


def date_mentions(text: Column) -> Column:
    """Everything in a text that is shaped like one of the date notations."""
    return F.regexp_extract_all(text, F.lit(DATE_MENTION), F.lit(0))


def parse_date(mention: Column) -> Column:
    """The date a mention stands for, in the first notation that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(mention, F.lit(fmt)).cast("date") for fmt in DATE_FORMATS])


def parse_money(written: Column) -> Column:
    """An amount with currency words, Indian digit grouping and lakh or crore units, as DECIMAL."""
    number = F.regexp_replace(F.regexp_extract(written, AMOUNT, 1), ",", "").try_cast("decimal(30,9)")
    unit = (
        F.when(written.rlike(r"(?i)\b(?:lakhs?|lacs?)\b"), F.lit(LAKH))
        .when(written.rlike(r"(?i)\b(?:cr|crores?)\b"), F.lit(CRORE))
        .otherwise(F.lit(1))
    )
    return F.round(number * unit, 2).cast("decimal(24,2)")
