"""Set and signature similarity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALPHA = 0.5


def jaccard(a: Column, b: Column) -> Column:
    """Exact Jaccard of two distinct-valued arrays; 0 when either is empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / union)


def composite(title: Column, body: Column, alpha: float = ALPHA) -> Column:
    return F.lit(alpha) * title + F.lit(1.0 - alpha) * body


def matching_rows(a: Column, b: Column) -> Column:
    """How many positions of two equally long signatures agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def estimated_jaccard(a: Column, b: Column) -> Column:
    """Share of equal rows; 0 when either signature is the all-zero one of an empty set."""
    empty = (F.array_max(a) == 0) | (F.array_max(b) == 0)
    return F.when(empty, F.lit(0.0)).otherwise(matching_rows(a, b) / F.size(a))


def s_curve(similarity: Column, bands: Column, rows: Column) -> Column:
    """Chance that a pair of this similarity shares at least one of ``bands`` buckets."""
    return 1.0 - F.pow(1.0 - F.pow(similarity, rows), bands)


def inflection(bands: Column, rows: Column) -> Column:
    return F.pow(1.0 / bands, 1.0 / rows)


def standard_error(similarity: Column, rows: Column) -> Column:
    """Standard error of the MinHash estimate from ``rows`` independent functions."""
    return F.sqrt(similarity * (1.0 - similarity) / rows)


def rows_for_error(epsilon: Column) -> Column:
    """Fewest functions that keep the worst-case error under ``epsilon`` with 95 % confidence."""
    return F.ceil(F.lit(0.9604) / (epsilon * epsilon))
