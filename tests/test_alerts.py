import datetime
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators.alerts import KeySpikeRule, SpikeRule, apply_rules
from tidewater.sources.files import LOG_COLUMNS, read_log
from tidewater.streaming import logs
from tidewater.streaming.changes import FEED_SCHEMA, FlightWarehouse
from tidewater.streaming.objects import metric_files, route

START = datetime.datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = "date timestamp_ntz, severity string, bundle_id string"


def events(spark, seconds, severity="Fatal", bundle="com.app"):
    return spark.createDataFrame([(START + datetime.timedelta(seconds=s), severity, bundle) for s in seconds], SCHEMA)


def test_no_events_no_alerts(spark):
    for rule in (SpikeRule(), KeySpikeRule()):
        assert rule.alerts(events(spark, [])).count() == 0


def test_ten_are_no_alert_eleven_are(spark):
    assert SpikeRule().alerts(events(spark, range(10))).count() == 0
    row = SpikeRule().alerts(events(spark, range(11))).first()
    assert row.message == "[RULE 2.1] Critical: 11 fatal errors around 2024-01-01 12:00:00"
    assert KeySpikeRule().alerts(events(spark, range(10))).count() == 0
    row = KeySpikeRule().alerts(events(spark, range(11))).first()
    assert row.message == "[RULE 2.2] Bundle Alert: High fatal rate detected for com.app" and row.key == "com.app"


def test_other_severities_are_ignored(spark):
    for rule in (SpikeRule(), KeySpikeRule()):
        assert rule.alerts(events(spark, range(50), "Error")).count() == 0


def test_an_event_one_window_later_does_not_count(spark):
    assert SpikeRule().alerts(events(spark, [*range(10), 60])).count() == 0
    assert SpikeRule().alerts(events(spark, [0] * 11)).count() == 1


def test_null_bundle_forms_no_group(spark):
    assert KeySpikeRule().alerts(events(spark, range(20), bundle=None)).count() == 0


def test_rules_match_pandas(spark):
    rng = random.Random(11)
    rows = sorted((rng.randrange(0, 7200), rng.choice(["hot", "hot", "a", "b"])) for _ in range(900))
    df = spark.createDataFrame([(START + datetime.timedelta(seconds=s), "Fatal", b) for s, b in rows], SCHEMA)
    pdf = pd.DataFrame({"date": [START + datetime.timedelta(seconds=s) for s, _ in rows], "b": [b for _, b in rows], "x": 1}).set_index("date")
    counts = pdf["x"].rolling("1min").count()
    want = counts[counts > 10].resample("1min").max().dropna()
    got = {r.ts: r.n for r in SpikeRule().alerts(df).withColumn("ts", F.col("ts").cast("timestamp_ntz")).collect()}
    assert got == {t.to_pydatetime(): int(n) for t, n in want.items()}
    keyed = pdf.groupby("b")["x"].rolling("1h").count()
    assert {r.key for r in KeySpikeRule(limit=150).alerts(df).collect()} == set(keyed[keyed > 150].index.get_level_values("b"))


class Broken:
    name, width_us, severity, severity_col, ts = "9", 1, "Fatal", "severity", "date"

    def alerts(self, events):
        raise RuntimeError("boom")


def test_a_failing_rule_does_not_stop_the_others(spark):
    found, errors = apply_rules(events(spark, range(11)), [Broken(), SpikeRule()])
    assert errors == {"9": "boom"} and found.count() == 1
    assert apply_rules(events(spark, []), [Broken()]) == (None, {"9": "boom"})


def write_log(path, rows):
    """rows: (seconds after START or text, severity, bundle)."""
    path.parent.mkdir(parents=True, exist_ok=True)
    epoch = int(START.replace(tzinfo=datetime.timezone.utc).timestamp())
    with open(path, "w") as f:
        for when, severity, bundle in rows:
            cells = dict.fromkeys(LOG_COLUMNS, "")
            cells |= {"severity": severity, "bundle_id": bundle, "date": str(epoch + when) if isinstance(when, int) else when}
            f.write(",".join(cells[c] for c in LOG_COLUMNS) + "\n")


def as_rows(df):
    shown = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return sorted(((r.rule, r.key, r.ts, r.n, r.message) for r in shown.collect()), key=str)


def test_alert_stream_equals_the_batch_rules(spark, tmp_path):
    rng = random.Random(7)
    rows = [(rng.randrange(0, 5400), rng.choice(["Fatal"] * 4 + ["Error"]), rng.choice(["hot", "hot", "a"])) for _ in range(700)]
    rows += [(s, "Fatal", "burst") for s in range(100, 108)]
    rows.sort()
    # cut in the middle of the burst and elsewhere
    cut = [0, next(i for i, r in enumerate(rows) if r[0] >= 104), 400, len(rows)]
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        write_log(tmp_path / "in" / f"{i}.csv", rows[a:b] + [("bad date", "Fatal", "x")])
        os.utime(tmp_path / "in" / f"{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    write_log(tmp_path / "in" / "ignored.txt", [(0, "Fatal", "x")] * 50)
    rules = [SpikeRule(limit=8), KeySpikeRule(limit=120)]
    stream = logs.log_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    alerting = logs.AlertStream(str(tmp_path / "out"), rules)
    query = alerting.start(stream, str(tmp_path / "cp"))
    assert query.awaitTermination(120)
    whole = logs.clean_log(read_log(spark, str(tmp_path / "in/[0-9].csv")), metrics=None)
    found, errors = apply_rules(whole, rules)
    assert not errors
    want = as_rows(found)
    assert len(want) > 10
    assert as_rows(alerting.alerts(spark)) == want
    totals = alerting.counters(spark)
    assert totals["rows_dropped_invalid_date"] == 3 and totals["rows_total"] == len(rows) + 3
    assert totals["files_processed"] == 3 and totals["rule_errors"] == 0 and totals["alerts_raised"] >= len(want)


def test_alert_stream_repeats_a_batch_without_harm(spark, tmp_path):
    alerting = logs.AlertStream(str(tmp_path / "out"), [SpikeRule()])
    for _ in range(2):
        alerting.process(events(spark, range(6)), 0)
        alerting.process(events(spark, range(6, 12)), 1)
    assert [r.n for r in alerting.alerts(spark).collect()] == [12]


def test_late_events_within_the_allowance_count(spark, tmp_path):
    alerting = logs.AlertStream(str(tmp_path / "out"), [SpikeRule()], lateness_us=600_000_000)
    alerting.process(events(spark, [*range(10), 500]), 0)
    alerting.process(events(spark, [3]), 1)
    assert [r.n for r in alerting.alerts(spark).collect()] == [11]


def test_a_wrong_time_stamp_loses_no_alert(spark, tmp_path):
    """Ahead of the clock, and within a replay of older logs."""
    for name, ahead in (("future", 400 * 365 * 86400), ("replay", 86400)):
        alerting = logs.AlertStream(str(tmp_path / name), [SpikeRule()])
        alerting.process(events(spark, [*range(8), ahead]), 0)
        alerting.process(events(spark, range(20, 25)), 1)
        assert [r.n for r in alerting.alerts(spark).collect()] == [13]


def test_the_tail_stays_short(spark, tmp_path):
    alerting = logs.AlertStream(str(tmp_path / "out"), [SpikeRule()], patience=2)
    for batch in range(5):
        alerting.process(events(spark, [batch * 1000]), batch)
    assert spark.read.parquet(str(tmp_path / "out/tail/0")).count() == 2
    assert sorted(p.name for p in (tmp_path / "out/tail").iterdir()) == ["0", "1"]


class FailsInATask(SpikeRule):
    def alerts(self, events):
        return super().alerts(events).withColumn("n", F.raise_error(F.lit("boom")).cast("bigint"))


def test_rules_fail_alone_and_see_their_own_columns(spark, tmp_path):
    rules = [FailsInATask(name="8"), SpikeRule(), KeySpikeRule(severity="low", severity_col="level", key="host", name="7")]
    rows = events(spark, range(11)).withColumn("level", F.lit(None).cast("string")).withColumn("host", F.lit("h"))
    low = events(spark, range(11), "Info").withColumn("level", F.lit("low")).withColumn("host", F.lit("h"))
    alerting = logs.AlertStream(str(tmp_path / "out"), rules)
    assert list(alerting.process(rows.union(low), 0)) == ["8"]
    assert sorted((r.rule, r.n) for r in alerting.alerts(spark).collect()) == [("2.1", 11), ("7", 11)]
    assert alerting.counters(spark)["rule_errors"] == 1


def test_totals_of_many_batches(spark, tmp_path):
    alerting = logs.AlertStream(str(tmp_path / "out"), [SpikeRule()])
    for batch in range(150):
        counted = spark.range(1).select(F.lit(2).alias("rows_total"), F.lit(1).alias("alerts_raised"))
        counted.write.json(str(tmp_path / f"out/counters/batch={batch}"))
    assert alerting.counters(spark) == {"alerts_raised": 150, "rows_total": 300}


def test_missing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="bundle_id"):
        logs.clean_log(spark.createDataFrame([], "date string, severity string"))


def test_files_are_taken_once_and_archived(spark, tmp_path):
    write_log(tmp_path / "in" / "a.csv", [(0, "Fatal", "x")])
    archive = tmp_path / "done"

    def run(name):
        rows = logs.log_stream(spark, str(tmp_path / "in"), str(archive))
        writer = rows.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp2"))
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination(60)

    def to_files():
        rows = logs.log_stream(spark, str(tmp_path / "in"), str(archive))
        writer = rows.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "cp"))
        writer.trigger(availableNow=True).start().awaitTermination(60)
        return spark.read.parquet(str(tmp_path / "rows")).count()

    assert to_files() == 1
    assert to_files() == 1
    write_log(tmp_path / "in" / "b.csv", [(1, "Fatal", "x")] * 2)
    assert to_files() == 3
    assert [p.name for p in archive.rglob("*.csv")] == ["a.csv"]


def test_sliding_counts_and_repeats(spark, tmp_path):
    folder = tmp_path / "ev"
    seconds = [0, 1, 1, 200, 400]
    rows = [(i, START + datetime.timedelta(seconds=s), "k") for i, s in enumerate(seconds)]
    spark.createDataFrame(rows + rows[:2], "id int, ts timestamp, key string").coalesce(1).write.parquet(str(folder))
    stream = spark.readStream.schema("id int, ts timestamp, key string").parquet(str(folder))
    unique = logs.without_repeats(stream, "id", "ts", "10 minutes")
    unique.writeStream.format("parquet").option("path", str(tmp_path / "u")).option("checkpointLocation", str(tmp_path / "c1")).trigger(
        availableNow=True
    ).start().awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "u")).count() == 5
    counts = logs.sliding_counts(stream, "ts", "1 minute", "30 seconds", "0 seconds", ["key"])
    counts.writeStream.format("parquet").option("path", str(tmp_path / "s")).option("checkpointLocation", str(tmp_path / "c2")).trigger(
        availableNow=True
    ).start().awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "s")).agg(F.max("n")).first()[0] == 5


FEED = [
    ("p1", "Ann", "Lee", "F", "30", "PL", "AAA", "Poland", "EU", "1/5/2022", "On Time", "Economy", "INSERT"),
    ("p1", "Ann", "Lee", "F", "30", "PL", "BBB", "Japan", "AS", "bad", "Delayed", "Economy", "INSERT"),
    ("p2", "Bo", "Li", "M", "40", "CN", "AAA", "Poland", "EU", "12/31/2021", "On Time", "Economy", "DELETE"),
]


def test_change_batches(spark, tmp_path):
    shop = FlightWarehouse(spark, str(tmp_path / "dw"))
    feed = spark.createDataFrame(FEED, FEED_SCHEMA)
    assert shop.process(feed.limit(0), 0) == "No data in stream"
    assert shop.process(feed, 1) == "Processed Successfully. Facts inserted: 2"
    assert shop.process(feed, 1) == "Processed Successfully. Facts inserted: 2"
    facts = {r.airport_name: r.departure_date for r in shop.table("fact_flights").collect()}
    assert facts == {"AAA": datetime.date(2022, 1, 5), "BBB": None}
    assert [r.full_name for r in shop.table("dim_passengers").collect()] == ["Ann Lee"]
    second = spark.createDataFrame([FEED[0], ("p3", *FEED[0][1:])], FEED_SCHEMA)
    assert shop.process(second, 2) == "Processed Successfully. Facts inserted: 2"
    assert sorted(r.passenger_id for r in shop.table("dim_passengers").collect()) == ["p1", "p3"]
    assert shop.table("dim_airports").count() == 2 and shop.table("fact_flights").count() == 4
    assert sorted((r.batch, r.affected_rows) for r in shop.audit_log().collect()) == [(1, 2), (2, 2)]


def test_a_batch_that_fails_half_way_is_not_seen(spark, tmp_path, monkeypatch):
    shop = FlightWarehouse(spark, str(tmp_path / "dw"))
    feed = spark.createDataFrame(FEED, FEED_SCHEMA)
    shop.process(feed, 0)
    write = shop._write

    def failing(name, df, batch_id):
        if name == "fact_flights":
            raise RuntimeError("lost")
        write(name, df, batch_id)

    monkeypatch.setattr(shop, "_write", failing)
    third = spark.createDataFrame([("p9", *FEED[0][1:])], FEED_SCHEMA)
    with pytest.raises(RuntimeError):
        shop.process(third, 1)
    assert shop.table("dim_passengers").count() == 1
    monkeypatch.undo()
    shop.process(third, 1)
    assert shop.table("dim_passengers").count() == 2


def test_change_stream(spark, tmp_path):
    spark.createDataFrame(FEED, FEED_SCHEMA).write.json(str(tmp_path / "feed"))
    shop = FlightWarehouse(spark, str(tmp_path / "dw"))
    query = shop.start(spark.readStream.schema(FEED_SCHEMA).json(str(tmp_path / "feed")), str(tmp_path / "cp"))
    assert query.awaitTermination(60)
    assert shop.table("fact_flights").count() == 2


def test_metric_files_are_routed(spark, tmp_path):
    inbox = tmp_path / "bucket"
    for folder, rows in {"metrics/departures": "station_dep,DepCount\nA,5\n,6\n", "raw": "station_dep,DepCount\nZ,1\n"}.items():
        (inbox / folder).mkdir(parents=True)
        (inbox / folder / "part-0.csv").write_text(rows)
    stream = metric_files(spark, str(inbox), "station_dep string, DepCount string")
    assert route(stream, str(tmp_path / "tables"), str(tmp_path / "cp")).awaitTermination(60)
    got = spark.read.json(str(tmp_path / "tables"))
    assert sorted((r.target, r["item"].StationName, r["item"].DepCount) for r in got.collect()) == [
        ("DeparturesData", "A", "5"), ("DeparturesData", "Unknown", "6"),
    ]
