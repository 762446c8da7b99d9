"""The corpus pipeline: rules, two dedups, mixing and encoding, each on what the last one kept."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tidewater.llm import exact_dedup, minhash_dedup, mixing, quality_rules, sentencepiece_codec  # noqa: E402
from tidewater.llm.common import keep  # noqa: E402
from tidewater.llm.queries import PIECES, TOKENIZERS, table  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; cutoffs come from the labels."""
    return quality_rules.passing(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, letter case of A-Z aside: that with the largest id."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return minhash_dedup.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document, as often as the mix took it."""
    return sentencepiece_codec.encode(docs, f"{TOKENIZERS}/{PIECES}")


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("minhash_dedup", near), ("mixing", mix), ("sentencepiece", encode)]

#: Near duplicates and pieces are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
