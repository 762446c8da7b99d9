"""The alert rules on engine state against the batch rules, for any cut of the events into files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators.alerts import KeySpikeRule, SpikeRule
from tidewater.streaming.state_rules import late_events, read_told, settled, start_rule

SCHEMA = "date timestamp, severity string, bundle_id string"
START = dt.datetime(2024, 3, 1, 9, 58)


def events_of(seed):
    """Bursts across minute, hour and bucket edges, ties, other severities, null keys; in order of time."""
    rng = random.Random(seed)
    rows = []
    for _ in range(60):
        at = START + dt.timedelta(seconds=rng.choice([rng.randrange(9000), 120 * rng.randrange(70) - 1]))
        for _ in range(rng.choice([1, 3, 12, 14])):
            rows.append((at, rng.choice(["Fatal"] * 9 + ["Error"]), rng.choice(["a", "b", "c", None])))
            at += dt.timedelta(microseconds=rng.choice([0, 1, 2_000_000, 6_000_000]))
    return sorted(rows, key=lambda r: r[0])


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def told(spark, rule, base):
    return sorted(map(tuple, settled(read_told(spark, f"{base}/alerts"), [rule]).collect()), key=str)


def batch(spark, rule, rows):
    return sorted(map(tuple, rule.alerts(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


@pytest.mark.parametrize("rule", [SpikeRule(), KeySpikeRule(limit=5, width_us=600_000_000)], ids=["global", "keyed"])
def test_equals_the_batch_rule(spark, tmp_path, rule):
    """Files hold events in any order within the lateness; the query is ended and taken up again between them."""
    rows = events_of(1)
    rng = random.Random(2)
    late = sorted(rows, key=lambda r: r[0] + dt.timedelta(seconds=rng.uniform(0, 500)))
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    cuts = [0, 30, 31, 150, 300, len(late)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        write(spark, folder, late[a:b])
        if k in (1, 4):  # a start, then a restart from the checkpoint with new files
            query = start_rule(stream(spark, folder), rule, f"{base}/alerts", f"{base}/checkpoint", "10 minutes")
            query.awaitTermination()
            assert late_events(query) == 0
    want = batch(spark, rule, rows)
    assert told(spark, rule, base) == want and len(want) > 2


def test_late_events_and_expiry(spark, tmp_path):
    """What is behind the watermark is counted and left out; a bucket's state goes when it is passed; a future stamp moves nothing."""
    rule, folder, base = SpikeRule(), str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda s: START + dt.timedelta(seconds=s)
    first = [(at(k), "Fatal", "a") for k in range(8)]
    future = [(dt.datetime(2200, 1, 1), "Fatal", "a")]
    write(spark, folder, first)
    write(spark, folder, [(at(2000), "Fatal", "a")])
    write(spark, folder, [(at(2001), "Fatal", "a")])
    write(spark, folder, [(at(9), "Fatal", "a")] * 5)  # far behind: would make 13
    query = start_rule(stream(spark, folder), rule, f"{base}/alerts", f"{base}/checkpoint", "5 minutes")
    query.awaitTermination()
    assert told(spark, rule, base) == [] and late_events(query) == 5
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    write(spark, folder, [(at(5000), "Fatal", "a")])
    write(spark, folder, future)
    write(spark, folder, [(at(2_400_000), "Fatal", "a")] * 11)
    query = start_rule(stream(spark, folder), rule, f"{base}/alerts", f"{base}/checkpoint", "36500 days")
    query.awaitTermination()
    assert sizes[-1] < max(sizes)
    assert [r[3] for r in told(spark, rule, base)] == [11]


def test_empty_stream(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, [(START, "Error", None), (None, "Fatal", "a")])
    start_rule(stream(spark, folder), KeySpikeRule(), f"{base}/alerts", f"{base}/checkpoint").awaitTermination()
    assert read_told(spark, f"{base}/alerts").isEmpty()
    assert settled(read_told(spark, f"{base}/alerts"), [KeySpikeRule()]).filter(F.col("n") > 0).isEmpty()
