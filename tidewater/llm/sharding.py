"""Sharding by vector bin packing of bytes, tokens and rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import WORD, keep

SHARDS = 16
#: Groups below this part of the whole are packed in as many bundles.
BUNDLES = 4096
#: Loads are measured in this part of the whole, in integers.
UNIT = 2**30
#: Rows that are numbered together, at least; beyond CELLS cells they grow with the table.
CELL, CELLS = 1000, 2**17
LOADS = ("bytes", "tokens", "rows")


def pack(loads: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each row of ``loads`` (units in packing order; integer parts of UNIT in bytes, tokens, rows).

    A unit goes where the dot product of its load and the shard's residual capacity is highest, among
    the shards it fits in; if there are none, among those whose bytes it fits in; else where most
    bytes are left, so that sizes end near equal. Equal products go to the first shard.
    """
    left = np.full((shards, loads.shape[1]), UNIT // shards, dtype=np.int64)
    found = np.empty(len(loads), dtype=np.int32)
    for k, load in enumerate(loads):
        product = left @ load
        fits = left >= load
        for among in (fits.all(axis=1), fits[:, 0]):
            if among.any():
                product = np.where(among, product, np.iinfo(np.int64).min)
                break
        else:
            product = left[:, 0]
        found[k] = product.argmax()
        left[found[k]] -= load
    return found


def place(units: DataFrame, shards: int) -> DataFrame:
    """``unit, shard`` for ``unit, bytes, tokens, rows`` (parts of UNIT); a bounded number of units, so one task packs them.

    Units are packed in order of their largest part, ties by name.
    """

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            return
        all_units = pd.concat(frames)
        all_units["top"] = all_units[list(LOADS)].max(axis=1)
        all_units = all_units.sort_values(["top", "unit"], ascending=[False, True])
        yield pd.DataFrame({"unit": all_units["unit"], "shard": pack(all_units[list(LOADS)].to_numpy(np.int64), shards)})

    return units.select("unit", *LOADS).coalesce(1).mapInPandas(packed, "unit string, shard int")


def _part(load: Column, whole: int) -> Column:
    if not whole:
        return F.lit(0).cast("long")
    return F.floor(load.cast("decimal(38,0)") * F.lit(UNIT) / F.lit(whole).cast("decimal(38,0)")).cast("long")


def shards(
    docs: DataFrame,
    shards: int = SHARDS,
    bundles: int = BUNDLES,
    cell: int = CELL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with its place: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: sizes (UTF-8 bytes of the text plus 1) of the shards end near equal, as near
    as single documents allow; tokens and rows are balanced with them as far as that goes. Equal
    texts are a group and share a shard. ``slot`` numbers a shard's rows from 0 without gaps;
    ``grown_shard`` is null, as this law says nothing of another number of shards.

    Groups are found by SHA-256. Those above 1/``bundles`` of all bytes, tokens or rows, of which there
    are 3 * ``bundles`` at most, are packed one by one; all others in ``bundles`` bundles by digest, so
    the packer sees a bounded number of units however large the table is. A group that no shard can
    hold (more than 1/``shards`` of any load) is cut by document id into pieces of about half a
    shard. Slots are numbered in cells of a unit and shifted by the sizes of the cells before.

    A null text counts as empty. Null ids and rows that repeat an id are rows like others; the order of
    equal rows is open. Other columns are not read. An empty table gives an empty one.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = keep(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "rows",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    whole = {name: n or 0 for name, n in rows.agg(*sums).first().asDict().items()}

    def above(part: int) -> Column:
        """Whether some load is more than one ``part``-th of the whole."""
        return F.greatest(*[F.col(n) > F.lit(whole[n] / part) for n in LOADS])

    largest = F.greatest(*[F.col(n) / F.lit(max(whole[n], 1)) for n in LOADS])
    pieces = F.when(above(shards), 2 * F.ceil(shards * largest)).otherwise(1).cast("int")
    large = keep(rows.groupBy("digest").agg(*sums).where(above(bundles)).select("digest", pieces.alias("pieces")), "large-groups")

    piece = F.concat(F.hex("digest"), F.lit(":"), F.pmod(F.xxhash64("doc_id"), "pieces").cast("string"))
    bundle = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(bundles)).cast("string")
    marked = rows.join(large, "digest", "left").select(
        "doc_id", "size", "tokens", "text_crc32", F.when(F.col("pieces").isNotNull(), piece).otherwise(bundle).alias("unit")
    )
    units = keep(marked.groupBy("unit").agg(*sums), "units")
    parts = units.select("unit", *[_part(F.col(n), whole[n]).alias(n) for n in LOADS])
    cells = F.ceil(F.col("rows") / max(cell, whole["rows"] // CELLS)).cast("int")
    placed = keep(place(parts, shards).join(units.select("unit", cells.alias("cells")), "unit"), "placed-units")

    rows = marked.drop("tokens").join(placed, "unit")
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), "cells").cast("int"))
    before = Window.partitionBy("shard").orderBy("unit", "cell")
    sizes = rows.groupBy("shard", "unit", "cell").agg(F.count("*").alias("n"))
    starts = sizes.select("unit", "cell", (F.sum("n").over(before) - F.col("n")).alias("start"))
    numbered = rows.withColumn("place", F.row_number().over(Window.partitionBy("unit", "cell").orderBy("doc_id", "text_crc32", "size")) - 1)
    return numbered.join(starts, ["unit", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
