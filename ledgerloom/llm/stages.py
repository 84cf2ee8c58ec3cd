"""Stages of the corpus pipeline; each takes ``(spark, docs, sf_dir)`` and returns the documents it keeps."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import packed_columns


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 by a model learned from ``labels``."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: the one with the largest id."""
    return exact_dedup.without_copies(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of SimHash near-duplicates."""
    return simhash.one_of_each(docs, shingle=3, distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the temperature mix takes them: each at least once, those of small sources up to 1.5 times on average."""
    return mixing.realised(docs, mixing.Target(repetitions=1.5))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return packed_columns(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))
