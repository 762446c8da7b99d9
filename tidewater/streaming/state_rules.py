"""Exact alert rules on state that the engine keeps, expires and restores."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewater.operators.alerts import ALERT_COLUMNS, KeySpikeRule, SpikeRule
from tidewater.operators.rolling import MINUTE_US, micros

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows in a list of instants before equal instants are put together.
LOOSE = 1000


class Bursts(StatefulProcessor):
    """The minutes of one bucket in which more than ``limit`` events fall into a window.

    A bucket is as wide as the window, so an instant's window lies in its bucket and the one before; each
    event is sent to its own bucket and the next. The state of a bucket is its instants and what has been told
    of them. An instant's count can only grow, so each batch tells what is new or larger than before. Once the
    watermark has passed the bucket no further event can reach it, and its timer removes the state.
    """

    def __init__(self, limit: int, width_us: int):
        self.limit, self.width_us = limit, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.instants = handle.getListState("instants", "us long, n long")
        self.told = handle.getMapState("told", "minute long", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        name, bucket = key[0], int(key[1])
        fresh = pd.concat([r["us"] for r in rows]).value_counts()
        stored = list(self.instants.get())
        if not stored:
            self.handle.registerTimer((bucket + 1) * self.width_us // 1000)
        both = pd.DataFrame([*stored, *fresh.items()], columns=["us", "n"]).groupby("us", as_index=False)["n"].sum()
        us, n = both["us"].to_numpy(np.int64), both["n"].to_numpy(np.int64)
        if len(stored) + len(fresh) - len(us) > LOOSE:
            self.instants.put([(int(a), int(b)) for a, b in zip(us, n)])
        else:
            self.instants.appendList([(int(a), int(b)) for a, b in fresh.items()])
        up_to = np.concatenate([[0], np.cumsum(n)])
        within = up_to[1:] - up_to[np.searchsorted(us, us - self.width_us, side="right")]
        over = (us // self.width_us == bucket) & (within > self.limit)
        most = pd.Series(within[over]).groupby(us[over] // MINUTE_US).max()
        news = []
        for minute, count in most.items():
            before = self.told.getValue((int(minute),))
            if before is None or before[0] < count:
                self.told.updateValue((int(minute),), (int(count),))
                news.append((name, int(minute) * MINUTE_US, int(count)))
        yield pd.DataFrame(news, columns=["name", "us", "n"]).astype({"us": "int64", "n": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.instants.clear()
        self.told.clear()
        yield pd.DataFrame({"name": pd.Series([], dtype=str), "us": pd.Series([], dtype="int64"), "n": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def told_alerts(events: DataFrame, rule: SpikeRule | KeySpikeRule, lateness: str = "10 minutes") -> DataFrame:
    """A stream of ``ALERT_COLUMNS``: each minute (and key) in which ``rule`` is broken, again whenever its count has grown.

    ``events`` is a stream of parsed log rows. Event time is the rule's time column, or the clock for rows
    ahead of it, so that a wrong time stamp in the future can't outdate what arrives. Rows more than ``lateness`` behind
    the newest are not looked at; :func:`late_events` counts them. Any split of the events into batches
    tells the same once :func:`settled` has taken the largest count: that of the rule over all events in time.

    A bucket and key is one state, so a global rule is spread over tasks by time, and a hot key too.
    """
    key = F.col(rule.key).cast("string") if isinstance(rule, KeySpikeRule) else F.lit("")
    hits = events.filter((F.col(rule.severity_col) == rule.severity) & F.col(rule.ts).isNotNull() & key.isNotNull())
    at = F.col(rule.ts).cast("timestamp")
    bucket = F.floor(F.col("us") / F.lit(rule.width_us))
    timed = (
        hits.select(key.alias("name"), micros(rule.ts).alias("us"), F.least(at, F.current_timestamp()).alias("event_time"))
        .withWatermark("event_time", lateness)
        .withColumn("bucket", F.explode(F.array(bucket, bucket + 1)))
    )
    found = timed.groupBy("name", "bucket").transformWithStateInPandas(
        Bursts(rule.limit, rule.width_us), "name string, us long, n long", "append", "eventTime"
    )
    keyed = F.when(F.lit(isinstance(rule, KeySpikeRule)), F.col("name"))
    return found.select(F.lit(rule.name).alias("rule"), keyed.alias("key"), F.timestamp_micros("us").alias("ts"), "n")


def settled(told: DataFrame, rules: Sequence[SpikeRule | KeySpikeRule]) -> DataFrame:
    """``ALERT_COLUMNS`` as the rules give them over all events: one row per minute, or per key for a keyed rule."""
    moment = F.when(F.col("key").isNull(), F.col("ts"))
    found = told.groupBy("rule", "key", moment.alias("_minute")).agg(F.min("ts").alias("ts"), F.max("n").alias("n"))
    text = F.lit(None).cast("string")
    for rule in rules:
        text = F.when(F.col("rule") == rule.name, rule.message()).otherwise(text)
    return found.withColumn("message", text).select(*ALERT_COLUMNS)


def start_rule(
    events: DataFrame, rule: SpikeRule | KeySpikeRule, path: str, checkpoint: str, lateness: str = "10 minutes",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Writes what :func:`told_alerts` tells to Parquet files, each batch once; the default trigger ends when all is read."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = told_alerts(events, rule, lateness).writeStream.format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_told(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("rule string, key string, ts timestamp, n long").parquet(path)


def late_events(query: StreamingQuery) -> int:
    """Events that came behind the watermark in the batches Spark still reports; each is two rows of the state operator."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"]) // 2
