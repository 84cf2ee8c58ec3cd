"""Connected components with the smallest id as the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise

MAX_ROUNDS = 100


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    near = _both_ways(edges)
    lowest = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("low"))
    return (
        near.where(F.col("v") > F.col("u")).join(lowest, "u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; edges run from high to low."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("low"))
    joined = down.join(lowest, "u")
    hung = joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return hung.unionByName(lowest.select("u", F.col("low").alias("v"))).where(F.col("u") != F.col("v"))


def min_labels(links: DataFrame) -> DataFrame:
    """``notice_id, label`` for every end of ``links`` (``id_a, id_b``).

    Alternates the two star steps until no edge changes.  Every round only takes minima per node and
    joins them back, so no neighbourhood is ever collected; each round is written to the shared
    scratch folder, which keeps the lineage one round long.
    """
    edges = materialise(
        links.select(F.greatest("id_a", "id_b").alias("u"), F.least("id_a", "id_b").alias("v"))
        .where("u <> v").distinct(),
        "edges",
    )
    state = None
    for _ in range(MAX_ROUNDS):
        fingerprint = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == fingerprint:
            break
        state = fingerprint
        if fingerprint["n"] == 0:
            break
        edges = materialise(_small_star(_large_star(edges).distinct()).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    children = edges.select(F.col("u").alias("notice_id"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("notice_id"), F.col("v").alias("label")).distinct()
    return children.unionByName(roots)
