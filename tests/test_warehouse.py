import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.operators import versions as vs
from tidewater.operators import warehouse as wh


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


KV = "k int, v string, o int"


def test_insert_ignore(spark):
    target = frame(spark, [(1, "old", 0)], KV)
    batch = frame(spark, [(1, "x", 1), (2, "late", 3), (2, "first", 2), (None, "n", 4)], KV)
    load = wh.insert_ignore(target, batch, ["k"], ["o"])
    assert tuples(load.inserted) == [(2, "first", 2)]
    assert tuples(load.rejected) == [(1, "x", 1), (2, "late", 3), (None, "n", 4)]
    assert load.inserted.count() + load.rejected.count() == batch.count()


def test_insert_ignore_twice_is_once(spark):
    target, batch = frame(spark, [(1, "a", 0)], KV), frame(spark, [(2, "b", 1), (2, "c", 2)], KV)
    once = wh.insert_ignore(target, batch, ["k"], ["o"]).applied_to(target)
    assert wh.insert_ignore(once, batch, ["k"], ["o"]).inserted.count() == 0


def test_composite_key_nulls_never_conflict(spark):
    schema = "a string, b string, o int"
    target = frame(spark, [("x", "y", 0), ("x", None, 0)], schema)
    batch = frame(spark, [("x", "y", 1), ("x", None, 2), ("x", None, 3), ("z", "y", 4)], schema)
    assert tuples(wh.insert_ignore_unique(target, batch, ["a", "b"], ["o"])) == [("x", None, 2), ("x", None, 3), ("z", "y", 4)]
    assert tuples(wh.insert_ignore_unique(target, batch, ["a", "b"], ["o"], nulls_equal=True)) == [("z", "y", 4)]


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    first = {r.k: r.sk for r in wh.surrogate_keys(df, ["k"], "sk", 5).collect()}
    again = {r.k: r.sk for r in wh.surrogate_keys(df.repartition(17), ["k"], "sk", 5).collect()}
    assert sorted(first.values()) == list(range(6, 1006))
    assert first == again


def test_surrogate_keys_continue_an_existing_table(spark):
    known = frame(spark, [(1, 41)], "k int, sk bigint")
    fresh = frame(spark, [(2,), (3,)], "k int")
    numbered = wh.surrogate_keys(fresh, ["k"], "sk", known.agg(F.max("sk")).scalar())
    assert sorted(r.sk for r in numbered.collect()) == [42, 43]


def test_fk_load_allows_null_and_keeps_rejects(spark):
    schema = "id int, room int"
    load = wh.fk_load(
        frame(spark, [], schema), frame(spark, [(1, 10), (2, 99), (3, None), (1, 11)], schema), ["id"],
        frame(spark, [(10,), (11,)], "id int"), "room", "id", ["room"],
    )
    assert tuples(load.inserted) == [(1, 10), (3, None)]
    assert tuples(load.rejected) == [(1, 11), (2, 99)]


def test_overwrite_attribute(spark):
    dim = frame(spark, [(1, "a", True), (2, "b", True), (3, None, True), (4, "d", False)], "k int, v string, cur boolean")
    batch = frame(spark, [(1, "A", 2), (1, "z", 1), (2, None, 1), (3, "c", 1), (4, "D", 1)], KV)
    stamped = wh.overwrite_attribute(dim.withColumn("at", F.lit(0)), batch, "k", "v", ["-o"], F.col("cur"), ("at", F.lit(9)))
    assert tuples(stamped) == [(1, "A", True, 9), (2, "b", True, 0), (3, None, True, 0), (4, "d", False, 0)]


def test_new_members_and_append(spark):
    dim = frame(spark, [(1,)], "k int")
    batch = frame(spark, [(1, "x"), (2, "y"), (2, "z"), (2, "z")], "k int, v string")
    assert tuples(wh.new_members(dim, batch, "k")) == [(2, "y"), (2, "z")]
    facts = frame(spark, [("r1",)], "row_id string")
    rows = frame(spark, [("r1",), ("r2",), (None,)], "row_id string")
    assert tuples(wh.append_new_facts(facts, rows, "row_id")) == [("r2",), (None,)]


def test_placeholder_members(spark):
    facts = frame(spark, [("a",), ("b",), ("b",), (None,)], "g string")
    got = wh.placeholder_members(frame(spark, [("a",)], "g string"), facts, "g", {"title": "Unknown"})
    assert tuples(got) == [("b", "Unknown")]


DIM = "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
OLD, NOW = datetime.datetime(2020, 1, 1), datetime.datetime(2024, 1, 1)


def test_versioned_dimension(spark):
    dim = frame(spark, [(1, "a", OLD, None, True), (2, "b", OLD, None, True), (3, "c0", OLD, OLD, False), (3, "c", OLD, None, True)], DIM)
    batch = frame(spark, [(1, "A", 1), (2, "b", 1), (4, "d", 1), (3, None, 1)], KV)
    now = F.lit(NOW).cast("timestamp_ntz")
    got = wh.versioned_dimension(dim, batch, "k", ["v"], now, ["o"])
    assert tuples(got) == sorted(
        [
            (1, "a", OLD, NOW, False), (1, "A", NOW, None, True), (2, "b", OLD, None, True), (3, "c0", OLD, OLD, False),
            (3, "c", OLD, NOW, False), (3, None, NOW, None, True), (4, "d", NOW, None, True),
        ],
        key=str,
    )
    assert tuples(wh.versioned_dimension(got, batch, "k", ["v"], now, ["o"])) == tuples(got)


def test_calendar(spark):
    days = wh.calendar(F.lit("2014-01-01").cast("date"), F.lit("2025-12-31").cast("date"), spark)
    assert days.count() == 4383
    first = days.orderBy("date_key").first()
    assert tuple(first)[1:] == (2014, 1, 1, "January  ", "Wednesday", 3)
    plain = wh.calendar(F.lit("2014-01-01").cast("date"), F.lit("2014-01-01").cast("date"), spark, padded=False)
    assert plain.first().month_name == "January"


def test_integrity(spark):
    child = frame(spark, [(1, 1), (1, 2), (None, 9), (2, None)], "id int, p int")
    parent = frame(spark, [(1,), (2,)], "id int")
    report = wh.integrity_report(
        [
            ("dup", wh.duplicate_keys(child, ["id"])),
            ("null", wh.null_keys(child, ["id"])),
            ("orphan", wh.orphans(child, "p", parent, "id")),
        ]
    )
    assert tuples(report) == [("dup", 1), ("null", 1), ("orphan", 1)]


def test_publish_prunes_partitions_and_refresh(spark, tmp_path):
    facts = spark.range(90).select("id", F.concat(F.lit("2020-0"), (F.col("id") % 9 + 1)).alias("month"))
    stored = wh.publish(facts, str(tmp_path / "facts"), "1", ["month"])
    plan = stored.filter("month = '2020-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    view = wh.StoredView("march", lambda: stored.filter("month = '2020-03'"), str(tmp_path))
    assert view.refresh("1").count() == 10
    assert spark.table("march").count() == 10
    wh.clear(stored, str(tmp_path / "empty"))
    emptied = spark.read.parquet(str(tmp_path / "empty"))
    assert emptied.count() == 0 and set(emptied.columns) == {"id", "month"}


HISTORY = "k int, v string, _version_ts int, _op string"


@pytest.fixture
def history(spark):
    return frame(spark, [(1, "a", 1, "I"), (1, "b", 5, "U"), (2, "x", 2, "I"), (2, "x", 6, "D"), (3, "new", 9, "I")], HISTORY)


def test_as_of(history):
    def at(t):
        return tuples(vs.as_of(history, ["k"], F.lit(t)).select("k", "v"))

    assert at(0) == []
    assert at(4) == [(1, "a"), (2, "x")]
    assert at(6) == [(1, "b")]
    assert at(99) == [(1, "b"), (3, "new")]


def test_delete_restore_clone(spark, history, tmp_path):
    rows = frame(spark, [(1, 2021), (2, 2022), (3, None)], "k int, y int")
    left = vs.delete_where(rows, F.col("y") >= 2022)
    assert tuples(left) == [(1, 2021), (3, None)]
    assert tuples(vs.restore(left, rows, F.col("y") >= 2022)) == tuples(rows)
    twice = vs.restore(vs.restore(left, rows, F.col("y") >= 2022, ["k"]), rows, F.col("y") >= 2022, ["k"])
    assert tuples(twice) == tuples(rows)
    assert vs.restore(rows, rows, F.col("y") >= 2022).count() == 4
    clone = vs.clone_as_of(history, ["k"], F.lit(4), str(tmp_path / "clone"))
    assert tuples(clone) == [(1, "a"), (2, "x")]


def test_audit_row(spark):
    row = wh.audit_row(spark, "P", 7, "INSERT_FACTS").first()
    assert (row.procedure_name, row.affected_rows, row.operation_type) == ("P", 7, "INSERT_FACTS")


def test_row_counts(spark):
    assert tuples(wh.row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_every_batch_row_is_inserted_or_rejected(spark):
    target = spark.createDataFrame([(9, "Z")], "k int, o string")
    batch = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, "C"), (9, "Z"), (9, "Z"), (None, "N"), (None, "N")], "k int, o string")
    load = wh.insert_ignore(target, batch, ["k"], ["o"])
    assert tuples(load.inserted) == [(1, "A"), (2, "C")]
    assert sorted(map(str, tuples(load.rejected))) == sorted(map(str, [(1, "A"), (1, "B"), (9, "Z"), (9, "Z"), (None, "N"), (None, "N")]))
    many = spark.range(25_000).select(F.lit(1).alias("k"), F.lit("A").alias("o"))
    assert wh.insert_ignore(target, many, ["k"], ["o"]).rejected.count() == 24_999


def test_type_1_changes_look_at_differing_rows_only(spark):
    dim = spark.createDataFrame([(1, "Zed", True), (2, "Bo", True), (3, None, True), (4, "Al", False)], "k int, n string, cur boolean")
    batch = spark.createDataFrame([(1, "Zed"), (1, "Adam"), (2, "Bo"), (3, "Cy"), (4, "Di"), (5, "New")], "k int, n string")
    changed = wh.overwrite_attribute(dim, batch, "k", "n", ["-n"], F.col("cur"))
    assert tuples(changed) == [(1, "Adam", True), (2, "Bo", True), (3, None, True), (4, "Al", False)]


def test_versions_need_a_key(spark):
    dim = spark.createDataFrame([], "k int, a string, valid_from timestamp, valid_to timestamp, is_current boolean")
    batch = spark.createDataFrame([(None, "x"), (1, "y")], "k int, a string")
    loaded = wh.versioned_dimension(dim, batch, "k", ["a"], F.current_timestamp(), ["a"])
    assert [r.k for r in loaded.collect()] == [1]
