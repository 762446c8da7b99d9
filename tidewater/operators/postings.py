"""Whole-word search through stored posting lists instead of a scan of all texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import tokens

#: Buckets of terms, and blocks a term's documents are dealt to: a list is no longer than a block.
BUCKETS, BLOCKS = 64, 256


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_postings(docs: DataFrame, doc_id: str, texts: Sequence[Column], path: str, buckets: int = BUCKETS, blocks: int = BLOCKS) -> None:
    """``bucket=b`` folders of ``term, block, docs``: the sorted ids of the documents of a block that hold a term.

    The block is a hash of the id, so the lists of all terms are cut alike and a term found everywhere is many
    lists; take more blocks for more documents. Ids are combined by term before they are shuffled. Null texts hold nothing.
    """
    terms = docs.select(F.col(doc_id).alias("doc"), F.explode(F.array_distinct(tokens(*texts))).alias("term"))
    block = F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int")
    lists = (
        terms.filter("term <> '' and doc is not null")
        .groupBy("term", block.alias("block")).agg(F.array_sort(F.collect_set("doc")).alias("docs"))
        .withColumn("bucket", _bucket(F.col("term"), buckets))
    )
    lists.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(path)


def with_all_terms(postings: DataFrame, terms: Sequence[str], doc_id: str, buckets: int = BUCKETS) -> DataFrame:
    """Ids of the documents that hold every term as a whole word; ``postings`` is what ``write_postings`` has written.

    Only the terms' buckets are read, and of their files only the row groups that may hold the terms. Lists of
    one block meet and are intersected, the shortest first.
    """
    wanted = sorted({t.lower() for t in terms})
    if not wanted or not all(t.isalnum() for t in wanted):
        raise ValueError(f"terms are words of letters and digits: {list(terms)!r}")
    here = F.lit(False)
    for term in wanted:
        here = here | ((F.col("bucket") == _bucket(F.lit(term), buckets)) & (F.col("term") == term))
    lists = postings.filter(here).select("block", F.struct(F.size("docs").alias("n"), "docs").alias("list"))
    together = lists.groupBy("block").agg(F.sort_array(F.collect_list("list")).alias("lists"))
    full = together.filter(F.size("lists") == len(wanted)).select(F.transform("lists", lambda x: x["docs"]).alias("lists"))
    both = F.aggregate(F.slice("lists", 2, len(wanted)), F.get("lists", 0), F.array_intersect)
    return full.select(F.explode(both).alias(doc_id))
