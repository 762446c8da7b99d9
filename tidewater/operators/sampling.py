"""Seeded samples that do not depend on partitioning: each row's draw is a hash of its key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def draw(key: str, seed: int) -> Column:
    """A repeatable pseudo-random bigint per key."""
    return F.xxhash64(F.col(key), F.lit(seed))


def bernoulli_split(df: DataFrame, key: str, percent: int, seed: int = 42,
                    by: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(about ``percent`` of the rows, exactly the others)."""
    chosen = F.pmod(draw(key, seed) if by is None else by, F.lit(100)) < percent
    return df.filter(chosen), df.filter(~F.coalesce(chosen, F.lit(False)))


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    return df.filter(F.pmod(draw(key, seed), F.lit(1_000_000)) < int(fraction * 1_000_000))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all, if fewer): those with the smallest draws."""
    return df.orderBy(draw(key, seed), key).limit(n)


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(draw(key, seed), key)


def other_choice(current: Column, choices: Sequence[str], key: str, seed: int = 42) -> Column:
    """One of the choices other than the current one; any of them for a null."""
    every = F.array(*(F.lit(c) for c in choices))
    rest = F.when(current.isNull(), every).otherwise(F.array_remove(every, current))
    return F.element_at(rest, (F.pmod(draw(key, seed), F.size(rest)) + 1).cast("int"))
