"""Ranked results without sorting a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_dense(df: DataFrame, value: str, k: int, keys: Sequence[str] = (), rank: str = "rnk") -> DataFrame:
    """Rows whose ``value`` is among the k largest distinct values (per key), ties kept.

    Equals ``DENSE_RANK() ... <= k``. Only distinct values are ranked, so any number of
    tied rows costs nothing, and at most k values per key and partition are shuffled.
    A null value ranks first, as in a descending sort of the reports' databases.
    """
    levels = df.select(*keys, value).distinct()
    order = F.col(value).desc_nulls_first()
    if not keys:
        # k rows are left, so the ranking window is bounded by k
        levels = levels.orderBy(order).limit(k)
    ranked = levels.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))
    ranked = ranked.filter(F.col(rank) <= k)
    return join_null_safe(df, ranked, [*keys, value])


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by name where null equals null; the key columns appear once."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition, how).drop(*(f"_r_{c}" for c in on))


def ordering(names: Sequence[str]) -> list[Column]:
    """Sort columns from names; a leading minus means descending."""
    return [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in names]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, which should be total.

    Planned as a group-limited window: each partition keeps one row per key before
    the shuffle, so a hot key sends one row per partition.
    """
    window = Window.partitionBy(*keys).orderBy(*ordering(order))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def top_rows(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT k; the order should end in a key to be repeatable."""
    return df.orderBy(*order).limit(k)
