"""Descriptive statistics with the null rules of the data-frame reports they replace."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators import sequences
from tidewater.operators.sequences import running_sum

#: Distinct values of a group that one task may read, at least.
WHOLE = 1 << 20
GRID = 64
ACCURACY = 2000
CELL_SLICES = 256


def number_or_null(df: DataFrame, column: str) -> DataFrame:
    """Not-a-number is a missing value in the data-frame reports."""
    if df.schema[column].dataType.typeName() in ("float", "double"):
        return df.withColumn(column, F.nanvl(F.col(column), F.lit(None).cast(df.schema[column].dataType)))
    return df


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    df = number_or_null(df, column)
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), column)


def not_in_values(column: str, values: Sequence) -> Column:
    """True where the column is none of the values; a null is none of them."""
    return ~F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def share_in_group(df: DataFrame, group: str, value: str, wanted: Sequence) -> DataFrame:
    """Share of each wanted value among the group's non-null values, 0.0 where it does not occur."""
    hits = [F.count_if(F.col(value) == F.lit(w)).alias(f"_h{i}") for i, w in enumerate(wanted)]
    grouped = (
        df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group).agg(F.count("*").alias("_n"), *hits)
    )
    cells = F.array(
        *(F.struct(F.lit(w).alias("v"), (F.col(f"_h{i}") / F.col("_n")).alias("s")) for i, w in enumerate(wanted))
    )
    return grouped.select(group, F.explode(cells).alias("_c")).select(
        group, F.col("_c.v").alias(value), F.col("_c.s").alias("share")
    )


def _rank(p: float, n: Column) -> Column:
    """Where a percentile lies among n sorted values: between ``low`` and ``high``, a ``part`` of the way."""
    position = F.lit(float(p)) * (n - 1)
    return F.struct(F.floor(position).alias("low"), F.ceil(position).alias("high"), (position - F.floor(position)).alias("part"))


def _between(low: Column, high: Column, part: Column) -> Column:
    return low + (high - low) * part


def _by_counts(ranked: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``_key, _p`` from the distinct values ``_v`` of each key, ``_c`` times each, ``_to`` values up to it, ``_n`` in all."""
    ranks = [_rank(p, F.col("_n")) for p in probs]

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("_to")) & (rank >= F.col("_to") - F.col("_c")), F.col("_v")))

    ends = [(at(r["low"]), at(r["high"]), F.max(r["part"])) for r in ranks]
    return ranked.groupBy("_key").agg(F.array(*(_between(*e) for e in ends)).alias("_p"))


def _by_cells(present: DataFrame, large: DataFrame, probs: Sequence[float], grid: int) -> DataFrame:
    """``_key, _p`` of large groups, in three passes.

    A sketch of each group (bounded state, merged map-side) gives values that cut it into about ``grid`` cells;
    the rows in each cell are counted, which says exactly in which cells the wanted ranks lie; the
    values of these few cells are counted and read. A sketch that is far off makes cells uneven, not wrong.
    """
    cuts = F.percentile_approx("_v", F.lit(np.arange(grid + 1) / grid), ACCURACY)
    # there are fewer than PIECES large groups
    sketch = F.broadcast(present.join(large, "_key").groupBy("_key").agg(F.first("_n").alias("_n"), F.array_distinct(cuts).alias("_cuts")))
    cell = F.size(F.filter("_cuts", lambda c: c <= F.col("_v")))
    placed = present.join(sketch, "_key").select("_key", "_v", "_n", cell.alias("_cell"))
    sizes = placed.groupBy("_key", "_n", "_cell").agg(F.count("*").alias("_size"), F.min("_v").alias("_from"), F.max("_v").alias("_till"))
    up_to = F.sum("_size").over(Window.partitionBy("_key").orderBy("_cell"))
    sizes = sizes.withColumn("_before", up_to - F.col("_size"))
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(_rank(p, F.col("_n"))["low"], _rank(p, F.col("_n"))["high"]) for p in probs))))
    wanted = F.exists(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_size")))
    cells = F.broadcast(sizes.filter(wanted).drop("_n", "_size"))
    group = ["_key", "_n", "_cell", "_before"]
    values = placed.join(cells, ["_key", "_cell"]).groupBy(*group, "_from", "_till", "_v").agg(F.count("*").alias("_c"))
    width = (F.col("_till") - F.col("_from")) / F.lit(CELL_SLICES)
    slice_no = F.when(width > 0, F.floor((F.col("_v") - F.col("_from")) / width)).otherwise(0)
    ranked = running_sum(values.withColumnRenamed("_key", "_group"), "_v", "_c", ["_group", "_cell"], slice_no, "_in")
    return _by_counts(ranked.select(F.col("_group").alias("_key"), "_v", "_c", "_n", (F.col("_before") + F.col("_in")).alias("_to")), probs)


def percentiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                grid: int = GRID, also: Sequence[Column] = ()) -> DataFrame:
    """Exact linearly interpolated percentiles per key: (keys, n, p0, p1, ..., also).

    A group with few distinct values, or of up to ``WHOLE`` rows or 1 / ``PIECES`` of all rows, is read from the counts of its
    distinct values, which one task can hold. Larger ones are cut into cells by a sketch, and only the cells
    that hold a wanted rank are read; the result is exact whatever the sketch says.
    ``also`` are further aggregates of the non-null ``value`` to take in the first pass.
    Not-a-number counts as null.
    """
    df = number_or_null(df, value)
    # without keys all rows share one that Spark can't fold, so that joins on it stay joins
    key = F.struct(*keys) if keys else F.struct(F.pmod(F.xxhash64(value), F.lit(1)).alias("all"))
    present = df.filter(F.col(value).isNotNull()).select(key.alias("_key"), value, F.col(value).cast("double").alias("_v"))
    facts = present.groupBy("_key").agg(F.struct(F.count("*").alias("n"), *also).alias("_f"), F.approx_count_distinct("_v").alias("_d"))
    present = present.select("_key", "_v")
    sizes = facts.select("_key", F.col("_f.n").alias("_n"), "_d")
    whole = F.greatest(F.lit(WHOLE), F.ceil(sizes.agg(F.sum("_n")).scalar() / sequences.PIECES))
    large = F.broadcast(sizes.filter((F.col("_d") > WHOLE) & (F.col("_n") > whole)).select("_key", "_n"))

    small = present.join(large, "_key", "left_anti").groupBy("_key", "_v").agg(F.count("*").alias("_c"))
    group = Window.partitionBy("_key")
    up_to = {"_to": F.sum("_c").over(group.orderBy("_v")), "_n": F.sum("_c").over(group)}
    found = _by_counts(small.withColumns(up_to), probs).unionByName(_by_cells(present, large, probs, grid))
    joined = facts.select("_key", "_f").join(found, "_key")
    return joined.select(*(F.col(f"_key.{k}").alias(k) for k in keys), "_f.*", *(F.col("_p")[i].alias(f"p{i}") for i in range(len(probs))))


def describe(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per group; rows with a null key are left out.

    A group without any value is absent.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    moments = [
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    ]
    names = {"n": "count", "p0": "q25", "p1": "q50", "p2": "q75"}
    return percentiles(df, value, [0.25, 0.5, 0.75], keys, also=moments).withColumnsRenamed(names)


def first_percentile_above(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Lowest whole percentile 1..100 whose (interpolated) value exceeds the threshold, or null.

    Whether a percentile exceeds it depends only on how many values do not, and on the two
    values next to the threshold, so four simple aggregates replace a sort.
    """
    x, t = F.col(value), F.lit(float(threshold))
    facts = number_or_null(df, value).agg(
        F.count(x).alias("n"),
        F.count_if(x <= t).alias("c"),
        F.max(F.when(x <= t, x)).alias("a"),
        F.min(F.when(x > t, x)).alias("b"),
    )

    def exceeds(p: Column) -> Column:
        position = p * (F.col("n") - 1) / 100
        low = F.floor(position)
        between = F.col("a") + (F.col("b") - F.col("a")) * (position - low)
        return (low >= F.col("c")) | ((low == F.col("c") - 1) & (position > low) & (between > t))

    found = F.filter(F.sequence(F.lit(1), F.lit(100)), exceeds)
    return facts.select(F.when(F.col("n") > 0, F.try_element_at(found, F.lit(1))).alias("first_pct"))


def at_maximum(df: DataFrame, value: str, has: Column) -> DataFrame:
    """One row: the maximum, how many rows reach it, and the share of these with a property."""
    df = number_or_null(df, value)
    top = df.agg(F.max(value)).scalar()
    return df.filter(F.col(value) == top).agg(
        F.max(value).alias("max_value"),
        F.count("*").alias("n_at_max"),
        F.coalesce(F.count_if(has) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("share_at_max"),
    )


def right_closed_bin(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of ``(low, high]``; null outside, including at the lowest edge."""
    chain = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > low) & (value <= high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def bin_counts(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Rows per bin in bin order, empty bins as 0: (ord, label, n), from one aggregation."""
    label = right_closed_bin(F.col(value), edges, labels)
    counts = df.agg(*(F.count_if(label == name).alias(f"_b{i}") for i, name in enumerate(labels)))
    cells = F.array(
        *(
            F.struct(F.lit(i).cast("bigint").alias("ord"), F.lit(name).alias("label"), F.col(f"_b{i}").alias("n"))
            for i, name in enumerate(labels)
        )
    )
    return counts.select(F.inline(cells))


def best_bin(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """The fullest bin; the lower one wins a tie."""
    return bin_counts(df, value, edges, labels).orderBy(F.desc("n"), "ord").limit(1)


def groups_where(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Keys of the groups that satisfy an aggregate condition; null keys form no group."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(condition.alias("_ok")).filter("_ok").select(*keys)


def rows_of_groups_where(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """The original rows of these groups."""
    return df.join(groups_where(df, keys, condition), list(keys), "left_semi")


def more_than_one(column: str) -> Column:
    """``COUNT(DISTINCT x) > 1`` as min <> max, which needs no second shuffle."""
    return F.coalesce(F.min(column) != F.max(column), F.lit(False))
