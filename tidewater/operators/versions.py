"""Versioned tables: rows carry ``_version_ts`` and ``_op`` ('I', 'U' or 'D') and are never changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ranking import first_per_key


def as_of(history: DataFrame, keys: Sequence[str], at: Column, tie: Sequence[str] = ()) -> DataFrame:
    """The table as it was at a moment: the latest version of each key unless deleted."""
    past = history.filter(F.col("_version_ts") <= at)
    latest = first_per_key(past, keys, ["-_version_ts", *tie])
    return latest.filter(F.col("_op") != "D")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left by a DELETE; a null condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def restore(current: DataFrame, earlier: DataFrame, condition: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Adds back earlier rows that meet a condition.

    Without keys they are added blindly; with keys those still present are left out.
    """
    lost = earlier.filter(condition)
    if keys:
        lost = lost.join(current.select(*keys).distinct(), list(keys), "left_anti")
    return current.unionByName(lost.select(*current.columns))


def clone_as_of(history: DataFrame, keys: Sequence[str], at: Column, path: str | None = None,
                tie: Sequence[str] = ()) -> DataFrame:
    """The table as of a moment as a table of its own.

    Versions are never changed, so the clone needs no copy: it reads them up to its moment. With
    a path its rows are written there and read back.
    """
    clone = as_of(history, keys, at, tie).drop("_version_ts", "_op")
    if path is None:
        return clone
    clone.write.mode("overwrite").parquet(path)
    return history.sparkSession.read.parquet(path)
