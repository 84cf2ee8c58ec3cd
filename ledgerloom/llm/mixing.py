"""Mixing sources to target weights by temperature; DataFrame operations only.

A source with token share ``p`` gets weight ``p**a / sum(p**a)``.  The exponent ``a`` between 0 (all sources alike)
and 1 (as they are) is bisected until the mix meets its target: the flattest mix in which no source is repeated more
than ``repetitions`` times, or the one whose entropy is ``entropy`` bits.  Weights become token budgets per source.
A source's budget is realised as a sequence of blocks, each a permutation of the whole source: full blocks as often as
the budget holds them, then the beginning of one more permutation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import running, whole
from ledgerloom.session import materialise

#: The exponent is rounded up to this many places, towards the mix as it is.
PLACES = 4
#: Bisection steps; as many as STEPS_A_JOB are taken from one pass over the sources.
STEPS, STEPS_A_JOB = 24, 4


@dataclass(frozen=True)
class Target:
    """Either bound may be given.  Without a budget, the mix is the smallest that holds every source at least once."""

    repetitions: float | None = 2.0
    entropy: float | None = None
    budget: int | None = None


def n_tokens(text: Column | str) -> Column:
    """Words between white space; a text without any counts as one, so that it has a place in the mix."""
    return F.greatest(F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def source_totals(rows: DataFrame) -> DataFrame:
    """``unnamed, source, tokens, share, most``; rows without a source are one of their own."""
    totals = materialise(rows.groupBy("unnamed", "source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    mix = totals.agg(F.sum("tokens").cast("double").alias("n"), F.max("tokens").cast("double").alias("most")).first()
    return totals.select("*", F.lit(mix["most"]).alias("most"), (F.col("tokens") / F.lit(mix["n"])).alias("share"))


def exponent(totals: DataFrame, target: Target) -> float:
    """The smallest exponent in [0, 1] that meets the target, 1 if none does.

    Both tests fail below the exponent sought and hold from there on, so the interval is halved; one pass over the
    sources evaluates all midpoints that the next few steps can ask for.
    """
    lo, hi = 0.0, 1.0

    def holds(points: list[float]) -> list[bool]:
        power = [F.pow("share", F.lit(a)) for a in points]
        if target.entropy is not None:  # H = log2(sum p^a) - a * sum(p^a log2 p) / sum(p^a), falls as a grows
            value = [F.log2(F.sum(w)) - a * F.sum(w * F.log2("share")) / F.sum(w) for a, w in zip(points, power, strict=True)]
            limit = target.entropy
        elif target.budget is not None:
            value = [F.max(w / F.col("tokens")) / F.sum(w) * target.budget for w in power]
            limit = target.repetitions
        else:
            value = [F.max(w / F.col("share")) / F.min(w / F.col("share")) for w in power]
            limit = target.repetitions
        row = totals.agg(*[v.alias(f"v{k}") for k, v in enumerate(value)]).first()
        return [v is None or v <= limit for v in row]

    if holds([0.0])[0]:
        return 0.0
    for _ in range(STEPS // STEPS_A_JOB):
        n = 1 << STEPS_A_JOB
        points = [lo + (hi - lo) * k / n for k in range(1, n)]
        held = holds(points)
        first = next((k for k, ok in enumerate(held) if ok), None)
        lo, hi = (points[-1], hi) if first is None else (points[first - 1] if first else lo, points[first])
    scale = 10**PLACES
    return min(1.0, -(-hi * scale // 1) / scale)


def weighted(totals: DataFrame, a: float, target: Target) -> DataFrame:
    """``unnamed, source, tokens, weight, quota``: shares of the mix and token budgets, which are what is realised."""
    power = totals.select("*", F.pow("share", F.lit(a)).alias("_p"))
    total = power.agg(F.sum("_p").alias("n")).first()["n"]
    out = power.withColumn("weight", F.col("_p") / F.lit(total))
    if target.budget is None:
        quota = F.round(F.col("tokens") * F.pow(F.col("most") / F.col("tokens"), F.lit(1 - a)))
    else:
        quota = F.round(F.col("weight") * target.budget)
    return out.select("unnamed", "source", "tokens", "weight", quota.cast("long").alias("quota"))


def _key(seed: int, block: Column, row_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block.cast("string"), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"))


def _thin(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    source = F.col(source_col)
    return docs.select(
        F.col(id_col).alias("id"), source.isNull().alias("unnamed"), F.coalesce(source, F.lit("")).alias("source"), n_tokens(text_col).alias("tokens")
    )


def mixed(
    docs: DataFrame, target: Target = Target(), seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``id, unnamed, source, tokens, block, key, start, quota``: a row for each time a row of ``docs`` is taken.

    ``start`` counts the tokens that its source's blocks give before it; a row is taken while that is under the quota.
    Ordered by ``start / quota``, sources alternate at their weights from the first row on.  Null ids and repeated rows
    take part like any other; their order among equal keys does not show.  An empty table gives no rows.
    """
    rows = materialise(_thin(docs, id_col, text_col, source_col), "mix-rows")
    totals = source_totals(rows)
    weights = weighted(totals, exponent(totals, target), target).select("unnamed", "source", F.col("tokens").alias("_all"), "quota")
    blocks = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("quota") / F.col("_all")) - 1).cast("int")))
    taken = rows.join(weights, ["unnamed", "source"]).where("quota > 0").withColumn("block", blocks).withColumn("key", _key(seed, F.col("block"), F.col("id")))
    placed = running(taken, ["unnamed", "source", "block"], F.substring("key", 1, 3), [F.col("key"), F.col("tokens")], F.col("tokens"), "_inside")
    return placed.withColumn("start", F.col("_inside") + F.col("block") * F.col("_all")).where("start < quota").drop("_inside", "_all")


def realised(
    docs: DataFrame, target: Target = Target(), seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``docs`` as the mix takes them: all columns, a row as often as it is taken; a null source is a source of its own.

    The beginning of a permutation is every row up to a key, so texts only meet the small table of last keys per source.
    """
    picks = mixed(docs, target, seed, id_col, text_col, source_col)
    last = materialise(
        picks.groupBy("unnamed", "source", "block").agg(F.max("key").alias("last")).groupBy("unnamed", "source").agg(F.max_by("last", "block").alias("last"), F.max("block").alias("blocks")),
        "mix-last-keys",
    ).select(F.col("unnamed").alias("_unnamed"), F.col("source").alias("_source"), F.col("last").alias("_last"), F.col("blocks").alias("_blocks"))
    source = docs[f"`{source_col}`"]
    held = docs.join(last, (source.isNull() == last["_unnamed"]) & (F.coalesce(source, F.lit("")) == last["_source"]))
    times = last["_blocks"] + F.when(_key(seed, last["_blocks"], docs[f"`{id_col}`"]) <= last["_last"], 1).otherwise(0)
    columns = [docs[f"`{c}`"] for c in docs.columns]
    return held.where(times > 0).select(F.struct(*columns).alias("doc"), F.explode(F.sequence(F.lit(1), times))).select("doc.*")
