"""Cumulative sums and exact percentiles over a global order, without a one-task window.

Rows are first folded to one per distinct value.  Values are then cut into ranges at quantile
estimates; ranges get their offsets from a table of at most ``ranges`` rows per group, and the
window runs inside each range.  The cut points only balance the work, they never affect results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.session import materialise

RANGES = 256


def _cut_points(df: DataFrame, value: str, ranges: int) -> list:
    """At most ``ranges`` quantile estimates of one column; the only values that reach the driver."""
    shares = [i / ranges for i in range(1, ranges)]
    row = df.agg(F.percentile_approx(value, shares, 1000).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def _range_of(value: str, cuts: list) -> Column:
    if not cuts:
        return F.lit(0)
    edges = F.array(*[F.lit(c) for c in cuts])
    return F.size(F.filter(edges, lambda edge: edge <= F.col(value)))


def folded_by_value(df: DataFrame, value: str, sums: dict[str, Column], by: list[str] = ()) -> DataFrame:
    """One row per distinct value (and group) with the sums over its rows, as a stored table."""
    folded = df.groupBy(*by, value).agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
    return materialise(folded, "by-value")


def cumulative(
    folded: DataFrame, value: str, sums: list[str], descending: bool = True, by: list[str] = (), ranges: int = RANGES
) -> DataFrame:
    """Running totals ``cum_<name>`` of each sum in value order, inclusive of the row's own value.

    ``folded`` must hold each value at most once per group (see ``folded_by_value``) and is read three
    times, so it should be a stored table.
    """
    by = list(by)
    ranged = folded.withColumn("rng", _range_of(value, _cut_points(folded, value, ranges)))
    order = F.desc if descending else F.asc
    per_range = ranged.groupBy(*by, "rng").agg(*[F.sum(s).alias(f"t_{s}") for s in sums])
    before = W.partitionBy(*by).orderBy(order("rng")).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_range.select(
        *by, "rng", *[F.coalesce(F.sum(f"t_{s}").over(before), F.lit(0)).alias(f"o_{s}") for s in sums]
    )
    inside = W.partitionBy(*by, "rng").orderBy(order(value)).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = ranged.join(offsets, [*by, "rng"])
    return joined.select(
        *folded.columns, *[(F.col(f"o_{s}") + F.sum(s).over(inside)).alias(f"cum_{s}") for s in sums]
    )


def percentiles(
    df: DataFrame, value: str, shares: dict[str, float], by: list[str] = (), ranges: int = RANGES
) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group.

    Only the rows around each wanted rank are looked at after the running counts are known.
    """
    by = list(by)
    clean = df.where(F.col(value).isNotNull())
    folded = folded_by_value(clean, value, {"n": F.lit(1)}, by)
    placed = cumulative(folded, value, ["n"], descending=False, by=by, ranges=ranges)
    totals = folded.groupBy(*by).agg(F.sum("n").alias("total"))
    placed = placed.join(totals, by) if by else placed.withColumn("total", totals.scalar())
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    picks = []
    for name, share in shares.items():
        rank = F.lit(share) * (F.col("total") - 1)
        lower, upper = F.floor(rank), F.ceil(rank)
        picks += [
            F.max(F.when((first <= lower) & (lower <= last), F.col(value))).alias(f"lo_{name}"),
            F.max(F.when((first <= upper) & (upper <= last), F.col(value))).alias(f"hi_{name}"),
            F.max(rank - lower).alias(f"w_{name}"),
        ]
    found = placed.groupBy(*by).agg(*picks)
    lo = lambda n: F.col(f"lo_{n}").cast("double")
    hi = lambda n: F.col(f"hi_{n}").cast("double")
    return found.select(*by, *[(lo(n) + (hi(n) - lo(n)) * F.col(f"w_{n}")).alias(n) for n in shares])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
