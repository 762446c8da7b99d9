"""The registered queries of this package on the given tables, each with its SQL if there is one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    chat_snapshots,
    exact_dedup,
    html_extraction,
    lexical_search,
    license_scan,
    minhash_dedup,
    mixing,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    sharding,
    source_divergence,
    suffix_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Where the vocabulary files lie, and the model the corpus is coded with.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PIECES = "piece_bpe_32k.model"


def query(sql: str | None = None):
    def register(plan):
        QUERIES[plan.__name__] = plan
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(minhash_dedup.SQL)
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near duplicates of each document."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of each document, learnt from the labels."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(suffix_dedup.SQL)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without passages that start earlier too."""
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(license_scan.SQL)
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses each document names."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of each document's text, and the text decoded from them."""
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{PIECES}")


@query(quality_rules.SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the verdict on each document; strata are the languages."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(F.col("id").alias("doc_id"), *counts)


@query()
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


@query(chat_snapshots.SQL)
def op8_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered conversations that no longer one begins with."""
    return chat_snapshots.format_chats(table(spark, sf_dir, "conversations"))


@query(exact_dedup.SQL)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for each document's text, letter case of A-Z aside."""
    return exact_dedup.equal_texts(table(spark, sf_dir, "documents"))


@query(mixing.SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query(source_divergence.SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language lie apart, and the terms that set each off."""
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


@query(lexical_search.SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that score highest for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


@query()
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document and its place there."""
    return sharding.shards(table(spark, sf_dir, "documents"))
