"""The stored table in key buckets: only hit buckets are written, versions, failures, equality with the plain loads."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tidewater.operators import warehouse as wh
from tidewater.sinks.buckets import BucketedTable

DIM = "id long, label string, valid_from timestamp, valid_to timestamp, is_current boolean"
AS_OF = "timestamp'2024-01-01 00:00:00'"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def dimension(spark, n):
    at = F.lit("2020-01-01").cast("timestamp")
    return spark.range(n).select("id", F.concat(F.lit("label "), F.col("id") % 7).alias("label"), at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"))


@pytest.fixture
def stored(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "dim"), ["id"], 64)
    table.create(dimension(spark, 20_000))
    return table


def written(table, version):
    return {d for d in os.listdir(f"{table.path}/data/v={version}") if d.startswith("bucket=")}


def batch_of(spark, ids, label="new"):
    return spark.createDataFrame([(i, label, k) for k, i in enumerate(ids)], "id long, label string, place int")


def test_an_update_writes_hit_buckets_only(spark, stored):
    batch = batch_of(spark, [3, 4, 3, 19_999, 50_000, None])
    want = rows(wh.overwrite_attribute(stored.read(), batch, "id", "label", ["place"]))
    first = rows(stored.read())
    assert stored.overwrite_attribute(batch, "label", ["place"]) == 2
    assert rows(stored.read()) == want != first
    assert 0 < len(written(stored, 2)) <= 5
    assert rows(stored.read(1)) == first


def test_the_target_is_not_shuffled(spark, stored):
    _, touched, rest = stored.parts(batch_of(spark, range(0, 300, 3)))
    for part, how in ((touched, "LeftSemi"), (rest, "LeftAnti")):
        plan = part._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index(how) :]
        target = next(line for line in join.splitlines() if "FileScan" in line and "label" in line)
        above = join[: join.index(target)]
        assert "BroadcastHashJoin" in plan and not re.search(r"(?<!Broadcast)Exchange hashpartitioning", above)


def test_versions_of_members(spark, stored):
    batch = batch_of(spark, [1, 2, 1, 77_777, None, 5], "label 1")
    want = rows(wh.versioned_dimension(stored.read(), batch, "id", ["label"], F.expr(AS_OF), ["place"]))
    stored.new_versions(batch, ["label"], F.expr(AS_OF), ["place"])
    assert rows(stored.read()) == want
    later = batch_of(spark, [2, 77_777], "label 9")
    want = rows(wh.versioned_dimension(stored.read(), later, "id", ["label"], F.expr(AS_OF), ["place"]))
    assert stored.new_versions(later, ["label"], F.expr(AS_OF), ["place"]) == 3 and len(written(stored, 3)) <= 2
    assert rows(stored.read()) == want


def test_inserts_add_files(spark, stored):
    fresh = dimension(spark, 20_050).filter("id >= 19990").withColumn("label", F.lit("late"))
    batch = fresh.unionByName(fresh.filter("id > 20040").withColumn("label", F.lit("again")))
    want = rows(wh.insert_ignore(stored.read(), batch, ["id"], ["label"]).applied_to(stored.read()))
    stored.insert_ignore(batch, ["label"])
    assert rows(stored.read()) == want
    size = lambda v: sum(len(f) for _, _, f in os.walk(f"{stored.path}/data/v={v}"))
    assert size(2) <= 2 * 64 + 4 and stored.read().count() == 20_050
    # the buckets now hold two folders; an update makes them one again
    stored.overwrite_attribute(batch_of(spark, [20_000]), "label", ["place"])
    assert stored.read().filter("id = 20000").first().label == "new" and stored.read().count() == 20_050


def test_a_failed_write_leaves_the_table(spark, stored):
    first = rows(stored.read())

    def fails(rows, batch):
        return rows.withColumn("label", F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("label")))

    with pytest.raises(Exception, match="broken"):
        stored.merge(batch_of(spark, [3, 4, 5]), fails)
    assert stored.version() == 1 and rows(stored.read()) == first
    assert stored.overwrite_attribute(batch_of(spark, [4]), "label", ["place"]) == 2
    assert stored.read().filter("id = 4").first().label == "new" and stored.read().count() == len(first)


def test_deletes_empty_batches_and_empty_tables(spark, stored, tmp_path):
    assert stored.overwrite_attribute(batch_of(spark, []), "label", ["place"]) == 1
    gone = batch_of(spark, range(0, 20_000))
    assert stored.merge(gone, lambda rows, batch: rows.filter("false")) == 2
    assert stored.read().count() == 0 and stored.read(1).count() == 20_000
    empty = BucketedTable(spark, str(tmp_path / "empty"), ["id"], 8)
    with pytest.raises(LookupError):
        empty.read()
    empty.create(dimension(spark, 0))
    assert rows(empty.read()) == [] and empty.read().columns == [c.split()[0] for c in DIM.split(", ")]
    empty.new_versions(batch_of(spark, [1, None]), ["label"], F.expr(AS_OF), ["place"])
    assert [r.id for r in empty.read().collect()] == [1]


def test_large_batches_are_joined_by_shuffle(spark, stored, monkeypatch):
    monkeypatch.setattr("tidewater.sinks.buckets.BROADCAST_KEYS", 10)
    batch = batch_of(spark, range(0, 4000, 2))
    want = rows(wh.overwrite_attribute(stored.read(), batch, "id", "label", ["place"]))
    stored.overwrite_attribute(batch, "label", ["place"])
    assert rows(stored.read()) == want
