"""Event counts over a sliding time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.sequences import running_sum

MINUTE_US = 60_000_000
HOUR_US = 3_600_000_000


def micros(ts: str | Column) -> Column:
    """Microseconds of a timestamp, with or without zone (session zone is UTC)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def rolling_count(df: DataFrame, ts: str, width_us: int, keys: Sequence[str] = (),
                  slice_us: int | None = None) -> DataFrame:
    """Rows in ``(t - width, t]`` for every distinct instant t (per key): (keys, us, n, in_window).

    ``n`` is the number of rows at the instant; tied rows count each other. Rows are
    counted per instant before anything else. An instant then enters the window at t and
    leaves it at t + width, and the window count is the running sum of these steps: one
    pass however many rows share a window, where a RANGE frame would rescan each window. A burst is
    cut at quantiles of its instants, so it is spread over tasks; ``slice_us`` cuts time evenly instead.
    """
    us = micros(ts)
    instants = df.filter(F.col(ts).isNotNull()).groupBy(*keys, us.alias("us")).agg(F.count("*").alias("n"))
    enters = F.struct(F.col("us").alias("us"), F.col("n").alias("step"), F.col("n").alias("n"))
    leaves = F.struct((F.col("us") + F.lit(width_us)).alias("us"), (-F.col("n")).alias("step"), F.lit(0).cast("bigint").alias("n"))
    steps = instants.select(*keys, F.explode(F.array(enters, leaves)).alias("_s")).select(*keys, "_s.*")
    part = F.floor(F.col("us") / F.lit(slice_us)) if slice_us else None
    counted = running_sum(steps, "us", "step", keys, part, "in_window")
    return counted.filter(F.col("n") > 0).drop("step")
