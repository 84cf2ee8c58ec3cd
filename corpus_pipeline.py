"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import stages
from ledgerloom.session import materialise

STAGES = [
    ("toxicity", stages.without_toxic),
    ("exact dedup", stages.without_copies),
    ("SimHash near-dedup", stages.one_of_each_group),
    ("temperature mixing", stages.mixed),
    ("vector packing", stages.packed),
]

#: Scores and token ids have no SQL counterpart; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again, so lineage ends with the stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
