"""Alert rules on the events table: error events stand for fatal log lines, users for bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.alerts import KeySpikeRule, SpikeRule, apply_rules
from tidewater.operators.rolling import HOUR_US, micros, rolling_count
from tidewater.registry import query

SPIKES = SpikeRule(limit=8, width_us=HOUR_US, severity="error", severity_col="event_type", ts="ts")
KEYS = KeySpikeRule(key="user_id", limit=2, width_us=24 * HOUR_US, severity="error", severity_col="event_type", ts="ts")

# (t - 1 h, t]: the range frame starts one microsecond after t - 1 h
SPIKES_SQL = """(SELECT event_id, ts, n FROM (
    SELECT event_id, ts, count(*) OVER (ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS n
    FROM events WHERE event_type = 'error') WHERE n > 8)"""
MINUTES_SQL = f"(SELECT date_trunc('minute', ts) AS ts, CAST(max(n) AS BIGINT) AS n FROM {SPIKES_SQL} GROUP BY 1)"
KEYS_SQL = """(SELECT user_id, CAST(max(n) AS BIGINT) AS n, min(ts) AS ts FROM (
    SELECT user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
                                   RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS n
    FROM events WHERE event_type = 'error') WHERE n > 2 GROUP BY user_id)"""


@query(f"SELECT event_id, CAST(n AS BIGINT) AS n FROM {SPIKES_SQL}")
def rolling_spikes(t):
    errors = t.events.filter("event_type = 'error'").select("event_id", "ts", micros("ts").alias("us"))
    spikes = SPIKES.spikes(t.events).select("us", F.col("in_window").alias("n"))
    return errors.join(spikes, "us").select("event_id", "n")


@query(
    """SELECT event_id, CAST(count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
              RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM events"""
)
def rolling_per_user(t):
    counted = rolling_count(t.events, "ts", HOUR_US, ["user_id"]).select("user_id", "us", F.col("in_window").alias("n"))
    return t.events.select("event_id", "user_id", micros("ts").alias("us")).join(counted, ["user_id", "us"]).select("event_id", "n")


@query(f"SELECT user_id FROM {KEYS_SQL}")
def rolling_keys(t):
    return KEYS.alerts(t.events).select(F.col("key").cast("bigint").alias("user_id"))


@query(f"SELECT ts, n FROM {MINUTES_SQL}")
def spike_minutes(t):
    return SPIKES.alerts(t.events).select(F.col("ts").cast("timestamp_ntz").alias("ts"), "n")


@query(
    f"""SELECT printf('[RULE 2.1] Critical: %d error errors around %s', n, strftime(ts, '%Y-%m-%d %H:%M:%S')) AS message
        FROM {MINUTES_SQL}"""
)
def alert_text(t):
    return SPIKES.alerts(t.events).select("message")


@query(
    f"""SELECT '2.1' AS rule, NULL AS key, ts, n,
               printf('[RULE 2.1] Critical: %d error errors around %s', n, strftime(ts, '%Y-%m-%d %H:%M:%S')) AS message
        FROM {MINUTES_SQL}
        UNION ALL SELECT '2.2', CAST(user_id AS VARCHAR), date_trunc('minute', ts), n,
               '[RULE 2.2] Bundle Alert: High fatal rate detected for ' || CAST(user_id AS VARCHAR) FROM {KEYS_SQL}"""
)
def alerts_all(t):
    found, errors = apply_rules(t.events, [SPIKES, KEYS])
    if errors:
        raise RuntimeError(str(errors))
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
