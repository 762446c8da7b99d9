"""Alert rules over log events: a frame in, a frame of alerts out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.rolling import HOUR_US, MINUTE_US, rolling_count

# The texts of the alerts in ``SpikeRule`` and ``KeySpikeRule`` are read by others.
# One alert: rule, key (null for a global rule), minute, number of events, message
ALERT_COLUMNS = ("rule", "key", "ts", "n", "message")


class Rule(Protocol):
    name: str
    width_us: int

    def alerts(self, events: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class SpikeRule:
    """More than ``limit`` events of a severity within any window; one alert per calendar minute."""

    limit: int = 10
    width_us: int = MINUTE_US
    severity: str = "Fatal"
    severity_col: str = "severity"
    ts: str = "date"
    name: str = "2.1"

    def spikes(self, events: DataFrame) -> DataFrame:
        hits = events.filter(F.col(self.severity_col) == self.severity).select(self.ts)
        return rolling_count(hits, self.ts, self.width_us).filter(F.col("in_window") > self.limit)

    def alerts(self, events: DataFrame) -> DataFrame:
        minute = F.date_trunc("minute", F.timestamp_micros("us"))
        found = self.spikes(events).groupBy(minute.alias("ts")).agg(F.max("in_window").alias("n"))
        return found.select(
            F.lit(self.name).alias("rule"), F.lit(None).cast("string").alias("key"), "ts", "n", self.message().alias("message")
        )

    def message(self) -> Column:
        """The text of an alert from its ``n`` and ``ts``."""
        return F.format_string(
            f"[RULE {self.name}] Critical: %d {self.severity.lower()} errors around %s",
            "n",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        )


@dataclass(frozen=True)
class KeySpikeRule:
    """More than ``limit`` events of a severity for one key within any window; one alert per key."""

    key: str = "bundle_id"
    limit: int = 10
    width_us: int = HOUR_US
    severity: str = "Fatal"
    severity_col: str = "severity"
    ts: str = "date"
    name: str = "2.2"

    def alerts(self, events: DataFrame) -> DataFrame:
        hits = events.filter((F.col(self.severity_col) == self.severity) & F.col(self.key).isNotNull())
        counted = rolling_count(hits.select(self.key, self.ts), self.ts, self.width_us, [self.key])
        found = counted.filter(F.col("in_window") > self.limit).groupBy(self.key).agg(
            F.max("in_window").alias("n"), F.min("us").alias("_us")
        )
        key = F.col(self.key).cast("string")
        return found.select(
            F.lit(self.name).alias("rule"),
            key.alias("key"),
            F.date_trunc("minute", F.timestamp_micros("_us")).alias("ts"),
            "n",
            self.message(key).alias("message"),
        )

    def message(self, key: Column | None = None) -> Column:
        """The text of an alert from its ``key``."""
        return F.concat(F.lit(f"[RULE {self.name}] Bundle Alert: High fatal rate detected for "), F.col("key") if key is None else key)


def apply_rules(events: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame | None, dict[str, str]]:
    """All alerts of the rules, and the error text of rules that could not be planned.

    A failing rule does not stop the others.
    """
    found, errors = [], {}
    for rule in rules:
        try:
            found.append(rule.alerts(events).select(*ALERT_COLUMNS))
        except Exception as error:  # each rule stands alone
            errors[rule.name] = str(error)
    return (reduce(DataFrame.unionByName, found) if found else None), errors


def write_alerts(events: DataFrame, rules: Sequence[Rule], path: str) -> tuple[int, dict[str, str]]:
    """Writes each rule's alerts to a folder of its own below ``path``: their number, and errors by rule.

    A rule that fails while it runs leaves the others' alerts as they are, and none of its own.
    """
    spark, n, errors = events.sparkSession, 0, {}
    for number, rule in enumerate(rules):
        folder = f"{path}/by={number}"
        try:
            rule.alerts(events).select(*ALERT_COLUMNS).write.mode("overwrite").parquet(folder)
        except Exception as error:  # each rule stands alone
            errors[rule.name] = str(error)
        else:
            n += spark.read.parquet(folder).count()
    return n, errors
