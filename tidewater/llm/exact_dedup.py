"""Exact dedup by skew-safe combining."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep, lower_ascii

SALTS = 16


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def equal_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lower_ascii,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
    whole: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``, and the row itself as a struct ``row``
    if ``whole``. Texts are equal if their normalised
    contents are; of equal texts the row with the largest id stays.

    1. Each map task combines its own rows by (digest, salt, content), the salt being the task's
       number modulo ``salts``. A group of a third of all rows leaves a task as one row.
    2. The salted groups are merged, at most ``salts`` rows of a content remain.
    3. The salt winners are combined over all salts.

    The content is a grouping key in each step, so it is compared in full. The last result keeps
    digests only, with the number of contents they stand for: rows find their group by digest where
    that number is one, else by digest and content.

    A null text counts as empty. A null id loses against any other; if a text has none but null ids,
    its rows all stay. Rows that repeat an id and its text stay or go alike. Other columns are not
    read. An empty table gives an empty one.
    """
    content = normalise(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    row = [F.struct("*").alias("row")] if whole else []
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), content.alias("content"), *row)
    rows = rows.withColumn("digest", digest(F.col("content")))

    def winners(of: DataFrame) -> DataFrame:
        salted = of.withColumn("salt", F.spark_partition_id() % salts)
        merged = salted.groupBy("digest", "salt", "content").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        return merged.groupBy("digest", "content").agg(
            F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        )

    groups = keep(
        winners(rows)
        .groupBy("digest")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("contents")),
        "equal-texts",
    )
    shared = groups.where("contents > 1").select("digest")
    alone = groups.where("contents = 1").drop("contents")
    if digest is sha256:
        found = rows.withColumnRenamed("digest", "text_sha256").withColumn("digest", F.col("text_sha256"))
    else:
        found = rows.withColumn("text_sha256", sha256(F.col("content")))
    matched = found.drop("content").join(alone, "digest")
    if not shared.isEmpty():
        hard = found.join(shared, "digest", "left_semi")
        matched = matched.unionByName(
            hard.join(winners(rows.join(shared, "digest", "left_semi")), ["digest", "content"]).drop("content")
        )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return matched.select("doc_id", "keep_id", "group_size", kept, "text_sha256", *(["row"] if whole else []))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each text, of those that :func:`equal_texts` keeps; all columns as they are.

    Rows that repeat both the text and the id that stays, null or not, are looked for by digest and
    id alone; only where there are any they are combined by content, in each map task first. Which
    of them stays is open if their other columns differ.
    """
    content = lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    names = docs.select(sha256(content).alias("repeated"), F.col(f"`{id_col}`").alias("repeated_id"))
    repeated = keep(names.groupBy("repeated", "repeated_id").count().where("count > 1").drop("count"), "repeated-rows")
    kept = equal_texts(docs, id_col, text_col, whole=True).where("kept")
    if repeated.isEmpty():
        return kept.select("row.*")
    again = (F.col("text_sha256") == F.col("repeated")) & F.col("doc_id").eqNullSafe(F.col("repeated_id"))
    by_content = lower_ascii(F.coalesce(F.col("row")[text_col], F.lit("")))
    one = kept.join(repeated, again, "left_semi").groupBy("text_sha256", "doc_id", by_content.alias("content")).agg(F.any_value("row").alias("row"))
    return kept.join(repeated, again, "left_anti").select("row.*").unionByName(one.select("row.*"))


SQL = """
WITH d AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
