"""Mixing sources to target weights by whole copies and Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, keep

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix"


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":" + seed))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """Shares of the whole for each source: ``source, source_size`` plus ``target``.

    Sources by code point, null last, get the weights in turn. A target stops at ``most`` times its
    source's size; what is above goes to the others by weight until none is above. In order of size
    over weight the stopped sources come first, so the level is found by running sums. The table
    has a row per source; its running sums are one ordered pass over those rows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("stopped_before", F.sum("limit").over(filling) - F.col("limit"))
        .withColumn("weight_before", F.sum("weight").over(filling) - F.col("weight"))
        .withColumn("whole", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("level", (F.col("whole") - F.col("stopped_before")) / (F.col("weights") - F.col("weight_before")))
        .withColumn("stopped", F.col("level") * F.col("weight") > F.col("limit"))
    )
    # the first level that stops nothing, in filling order
    level = F.min_by(F.when(~F.col("stopped"), F.col("level")), F.when(~F.col("stopped"), F.col("weight_before"))).over(everything)
    target = F.when(F.col("stopped"), F.col("limit").cast("double")).otherwise(level * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MAX_COPIES,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_too: bool = False,
) -> DataFrame:
    """How often each document is taken: ``doc_id, size, source_size, target, taken, copies``, and the row itself as ``row`` if ``rows_too``.

    ``target / source_size`` is the expected number of copies of a document. Its whole part is
    certain; the rest is its inclusion probability p in a sample of fixed size in words. Documents
    are ranked by (u / (1 - u)) / (p / (1 - p)) with a repeatable uniform u; those are taken whose
    middle word, in that order, lies within what the source still lacks.

    A source may hold a third of all rows, so its ranking is not one window: ranks are cut into
    about sqrt(n) bins, their sizes summed and cumulated, and only the bin in which the source's
    sample ends is ordered document by document.

    A null text has size 0; a null source is a source of its own; a null id gets the number of an
    empty one. Equal ids are ordered by size; repeated rows are taken as separate rows. A source
    without words takes nothing. Other columns are not read. An empty table gives an empty one.
    """
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    row = [F.struct("*").alias("row")] if rows_too else []
    sized = keep(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"),
            uniform(F.col(f"`{id_col}`"), seed).alias("u"), *row,
        ),
        "sizes",
    )
    totals = keep(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources")
    shares = targets(totals.select("source", "source_size"), weights, most)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    lacking = F.col("target") - F.col("certain") * F.col("source_size")
    plan = keep(
        shares.join(totals.select(F.col("source").alias("named"), F.ceil(F.sqrt("n")).alias("bins")), F.col("source").eqNullSafe(F.col("named")))
        .drop("named")
        .withColumn("certain", copies.cast("long"))
        .withColumn("lacking", lacking)
        .withColumn("p", F.when(F.col("source_size") > 0, lacking / F.col("source_size")).otherwise(0.0)),
        "targets",
    )

    def planned(plan: DataFrame) -> DataFrame:
        """Spark broadcasts the plan if its files are small, else it joins by shuffle."""
        named = plan.withColumnRenamed("source", "named")
        return sized.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named").withColumn("bin", F.floor(F.col("u") * F.col("bins")))

    in_bin = planned(plan.where("lacking > 0")).groupBy("source", "lacking", "bin").agg(F.sum("size").alias("bin_size"))
    running = Window.partitionBy("source").orderBy("bin")
    ends = (
        in_bin.withColumn("up_to", F.sum("bin_size").over(running))
        .withColumn("before", F.col("up_to") - F.col("bin_size"))
        .where("before <= lacking and up_to > lacking")
        .select(F.col("source").alias("ends_in"), F.col("bin").alias("last_bin"), "before")
    )
    plan = keep(
        plan.join(ends, F.col("source").eqNullSafe(F.col("ends_in")), "left").drop("ends_in"),
        "mix-plan",
    )
    rows = planned(plan)
    whole = rows.where("last_bin is null or bin <> last_bin").withColumn(
        "more", F.coalesce(F.col("bin") < F.col("last_bin"), F.lit(False)).cast("long")
    )
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    last = (
        rows.where("bin = last_bin")
        .withColumn("rank", odds)
        .withColumn("middle", F.col("before") + F.sum("size").over(ranked.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2)
        .withColumn("more", (F.col("middle") <= F.col("lacking")).cast("long"))
        .drop("rank", "middle")
    )
    return whole.unionByName(last).select(
        "doc_id", "size", "source_size", "target", ((F.col("certain") + F.col("more")) * F.col("size")).alias("taken"),
        (F.col("certain") + F.col("more")).alias("copies"), *(["row"] if rows_too else []),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them, all columns as they are."""
    taken = mix(docs, id_col=id_col, rows_too=True, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


SQL = """
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
           (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE AS u
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight, source_size * 3 AS lim FROM s
), f AS (
    SELECT *, sum(lim) OVER o - lim AS stopped_before, sum(weight) OVER o - weight AS weight_before,
           sum(source_size) OVER () AS whole, sum(weight) OVER () AS weights
    FROM w WINDOW o AS (ORDER BY lim / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING)
), l AS (
    SELECT *, CAST(whole - stopped_before AS BIGINT) / CAST(weights - weight_before AS BIGINT) AS lvl FROM f
), g AS (
    SELECT min_by(lvl, weight_before) AS fill FROM l WHERE NOT lvl * weight > lim
), t AS (
    SELECT source, source_size, CASE WHEN lvl * weight > lim THEN CAST(lim AS DOUBLE) ELSE fill * weight END AS target FROM l, g
), c AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS certain FROM t
), p AS (
    SELECT *, target - certain * source_size AS lacking,
           CASE WHEN source_size > 0 THEN (target - certain * source_size) / source_size ELSE 0.0 END AS p FROM c
), r AS (
    SELECT d.*, p.* EXCLUDE (source),
           sum(size) OVER (PARTITION BY d.source
                           ORDER BY CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE u END, doc_id, size
                           ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       CAST((certain + CASE WHEN lacking > 0 AND middle <= lacking THEN 1 ELSE 0 END) * size AS BIGINT) AS taken,
       CAST(certain + CASE WHEN lacking > 0 AND middle <= lacking THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM r
"""
