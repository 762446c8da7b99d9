"""Chat formatting of logged conversations, snapshots of longer ones left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import keep

#: Turns that are rendered into one row; longer conversations get several, numbered from 0.
TURNS = 64
BEGIN, END = "<|im_start|>", "<|im_end|>"


def render(role: Column, text: Column) -> Column:
    """A turn between its marks; marks inside the text are broken up, so they stay text."""
    said = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit(BEGIN), F.coalesce(role, F.lit("unknown")), F.lit("\n"), said, F.lit(END + "\n"))


def prefixes(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Each turn with its place ``pos``, the number ``n`` of turns, and two hashes of all up to it; and the turns.

    A hash of a prefix is the exclusive or of the hashes of (place, role, text) in it. Places and
    hashes run over ranges of the ordered turns and then over the ranges of a conversation, so a
    conversation with a third of all rows is spread over many tasks.
    """
    read = turns.select(
        F.struct(F.col(f"`{conv_col}`").alias("conv_id")).alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"), F.monotonically_increasing_id().alias("tie"),
    )
    # rows that are alike in all else may go to either of two ranges
    ranged = read.repartitionByRange("conv", "turn", "role", "text", "tie").drop("tie").withColumn("part", F.spark_partition_id())
    ranged = keep(ranged, "turns")
    inside = Window.partitionBy("conv", "part").orderBy("turn", "role", "text")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv", "part").agg(F.count("*").alias("rows"))
    counts = counts.select(
        "conv", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier"), F.sum("rows").over(Window.partitionBy("conv")).alias("n")
    )
    placed = ranged.withColumn("own", F.row_number().over(inside)).join(counts, ["conv", "part"])
    placed = placed.withColumn("pos", F.col("earlier") + F.col("own"))
    content = [F.col("pos"), F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull()]
    placed = placed.withColumn("h1", F.xxhash64(F.lit(1), *content)).withColumn("h2", F.xxhash64(F.lit(2), *content))
    placed = keep(placed.select("conv", "part", "pos", "n", "role", "text", "h1", "h2"), "placed-turns")
    upto = Window.partitionBy("conv", "part").orderBy("pos")
    sums = placed.groupBy("conv", "part").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    sums = sums.select("conv", "part", *[F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    running = placed.select("conv", "part", "pos", "n", *[F.bit_xor(f"h{i}").over(upto).alias(f"x{i}") for i in (1, 2)])
    hashed = running.join(sums, ["conv", "part"]).select(
        "conv", "pos", "n", *[F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")).alias(f"h{i}") for i in (1, 2)]
    )
    return keep(hashed, "prefixes"), placed


def maximal(hashed: DataFrame) -> DataFrame:
    """``conv, n, copies`` of the conversations that are no proper prefix of another.

    Of equal conversations the one with the smallest id stands for all. Both sides of the anti-join
    hold each prefix once, so a first turn that a third of all conversations share meets once.
    """
    whole = hashed.where("pos = n").groupBy("pos", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    proper = hashed.where("pos < n").select("pos", "h1", "h2").distinct()
    return whole.join(proper, ["pos", "h1", "h2"], "left_anti").select("conv", F.col("pos").alias("n"), "copies")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, part, n_turns, copies, text``: the rendered turns of the maximal conversations.

    Turns are ordered by number, then role and text; null numbers come first. Turns are the same if
    role and text are, nulls included. A conversation that another one continues is left out; of
    equal ones that with the smallest id stays and ``copies`` counts them. Every TURNS turns make a
    row. A null id is a conversation of its own and the smallest; a null role is rendered as
    "unknown", a null text as empty. A row that is repeated is a turn that is repeated. Other columns
    are not read. An empty table gives an empty one.
    """
    hashed, placed = prefixes(turns, conv_col, turn_col, role_col, text_col)
    stay = keep(maximal(hashed), "maximal")
    said = placed.select("conv", "pos", render(F.col("role"), F.col("text")).alias("piece")).join(stay, "conv")
    rows = said.groupBy("conv", "n", "copies", F.floor((F.col("pos") - 1) / TURNS).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("pieces")
    )
    text = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return rows.select("conv.conv_id", "part", F.col("n").alias("n_turns"), "copies", text.alias("text"))


SQL = f"""
WITH t AS (
    SELECT conv_id, role, text, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
), p AS (
    SELECT conv_id, pos, n, sha256(string_agg(sha256(coalesce('r' || role, '')) || sha256(coalesce('t' || text, '')), '') OVER (
        PARTITION BY conv_id ORDER BY pos)) AS h FROM t
), m AS (
    SELECT pos AS n, h, min(conv_id) AS least, bool_or(conv_id IS NULL) AS unnamed, count(*) AS copies FROM p WHERE pos = n GROUP BY pos, h
), k AS (
    SELECT CASE WHEN NOT unnamed THEN least END AS conv_id, n, copies FROM m
    WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos = m.n AND p.h = m.h AND p.n > p.pos)
)
SELECT k.conv_id, CAST((t.pos - 1) // {TURNS} AS BIGINT) AS part, k.n AS n_turns, copies,
       string_agg('{BEGIN}' || coalesce(role, 'unknown') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '{END}' || chr(10), ''
                  ORDER BY t.pos) AS text
FROM k JOIN t ON t.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY ALL
"""
