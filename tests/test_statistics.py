import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import statistics as st


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 100, 3000])
@pytest.mark.parametrize("shape", ["spread", "ties", "tail"])
def test_percentiles_are_exact(spark, n, shape):
    rng = random.Random(n)
    draw = {
        "spread": lambda: rng.uniform(-5, 5),
        "ties": lambda: float(rng.choice([0, 0, 0, 1, 7])),
        "tail": lambda: rng.paretovariate(0.3),
    }[shape]
    values = [draw() for _ in range(n)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    row = st.percentiles(numbers(spark, values), "x", probs).first()
    assert row.n == n
    assert [row[f"p{i}"] for i in range(len(probs))] == pytest.approx(list(np.percentile(values, [100 * p for p in probs])))


def test_percentiles_per_key_with_hot_and_null_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.gauss(0, 1)) for _ in range(2000)] + [("a", None)]
    got = {r.k: r for r in st.percentiles(spark.createDataFrame(rows, "k string, x double"), "x", [0.5], ["k"]).collect()}
    for key in ("hot", "a", None):
        values = [v for k, v in rows if k == key and v is not None]
        assert got[key].n == len(values)
        assert got[key].p0 == pytest.approx(np.median(values))


def test_percentiles_of_nothing(spark):
    assert st.percentiles(numbers(spark, [None]), "x", [0.5], []).count() == 0


def test_describe_equals_the_data_frame_one(spark):
    import pandas as pd

    pdf = pd.DataFrame({"g": ["a", "a", "a", "b", None], "x": [1.0, 2.0, 4.0, 5.0, 9.0]})
    want = pdf.groupby("g")["x"].describe()
    got = {r.g: r for r in st.describe(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 5.0), (None, 9.0)], "g string, x double"), "x", ["g"]).collect()}
    assert set(got) == {"a", "b"}
    a = want.loc["a"]
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["std"], got["a"]["min"], got["a"]["q25"], got["a"]["q50"], got["a"]["q75"], got["a"]["max"]) == pytest.approx(tuple(a))
    assert got["b"]["std"] is None


# Calories per serving of 77 cereals
CEREAL = [70, 120, 70, 50, 110, 110, 110, 130, 90, 90, 120, 110, 120, 110, 110, 110, 100, 110, 110, 110, 100, 110, 100, 100,
          110, 110, 100, 120, 120, 110, 100, 110, 100, 110, 120, 120, 110, 110, 110, 140, 110, 100, 110, 100, 150, 150, 160,
          100, 120, 140, 90, 130, 120, 100, 50, 50, 100, 100, 120, 100, 90, 110, 110, 80, 90, 90, 110, 110, 90, 110, 140, 100,
          110, 110, 100, 100, 110]


def test_calories(spark):
    df = numbers(spark, [float(c) for c in CEREAL])
    assert st.first_percentile_above(df, "x", 60).first()[0] == 4
    assert st.percentiles(df, "x", [0.5]).first()["p0"] == 110
    row = df.agg(F.avg("x"), F.stddev_pop("x"), F.avg((F.col("x") > 60).cast("double")) * 100).first()
    assert tuple(round(v, 3) for v in row) == (106.883, 19.357, 96.104)


@pytest.mark.parametrize("seed", range(12))
def test_first_percentile_above_matches_a_scan(spark, seed):
    rng = random.Random(seed)
    values = [float(rng.choice([1, 5, 6, 9, 60, 61])) for _ in range(rng.choice([1, 2, 5, 101, 250]))]
    threshold = rng.choice([0, 5, 5.5, 60, 99])
    want = next((p for p in range(1, 101) if np.percentile(values, p) > threshold), None)
    assert st.first_percentile_above(numbers(spark, values), "x", threshold).first()[0] == want


def test_bins_are_right_closed(spark):
    df = numbers(spark, [16.0, 17.0, 35.0, 36.0, 70.0, 101.0])
    got = st.bin_counts(df, "x", (16, 35, 70, 100), ("young", "adult", "retiree")).orderBy("ord").collect()
    assert [(r.label, r.n) for r in got] == [("young", 2), ("adult", 2), ("retiree", 0)]
    assert st.best_bin(df, "x", (16, 35, 70, 100), ("young", "adult", "retiree")).first().label == "young"


def test_share_of_absent_value_is_zero(spark):
    df = spark.createDataFrame([("m", ">50K"), ("m", "<=50K"), ("s", "<=50K"), (None, ">50K"), ("s", None)], "g string, v string")
    got = {(r.g, r.v): r.share for r in st.share_in_group(df, "g", "v", [">50K", "<=50K"]).collect()}
    assert got == {("m", ">50K"): 0.5, ("m", "<=50K"): 0.5, ("s", ">50K"): 0.0, ("s", "<=50K"): 1.0}


def test_value_counts_and_negated_list_follow_the_data_frame_rules(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "v string")
    assert [(r.v, r.n) for r in st.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]
    assert df.filter(st.not_in_values("v", ["a"])).count() == 2


def test_at_maximum(spark):
    df = spark.createDataFrame([(99, True), (99, False), (40, True)], "h int, rich boolean")
    assert tuple(st.at_maximum(df, "h", F.col("rich")).first()) == (99, 2, 0.5)
    assert tuple(st.at_maximum(df.filter("h < 0"), "h", F.col("rich")).first()) == (None, 0, 0.0)


def test_group_filter(spark):
    df = spark.createDataFrame([("a", 30, 40), ("a", 50, 6), ("b", 41, 40), ("c", 20, 5), (None, 1, 9)], "job string, age int, h int")
    rule = (F.avg("age") <= 40) & (F.min("h") > 5)
    assert [r.job for r in st.groups_where(df, ["job"], rule).collect()] == ["a"]
    assert st.rows_of_groups_where(df, ["job"], rule).count() == 2


def test_more_than_one(spark):
    df = spark.createDataFrame([(1, "M"), (1, "F"), (2, "M"), (2, None), (3, None)], "room int, sex string")
    got = df.groupBy("room").agg(st.more_than_one("sex").alias("mixed"))
    assert {r.room: r.mixed for r in got.collect()} == {1: True, 2: False, 3: False}


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, "nan")] + [("b", float("nan"))], "k string, v double")
    row = st.percentiles(df, "v", [0.5]).first()
    assert (row.n, row.p0) == (3, 2.0)
    (group,) = st.describe(df, "v", ["k"]).collect()
    assert (group.k, group["count"], group.max, group.mean) == ("a", 3, 3.0, 2.0)
    assert st.value_counts(df, "v").count() == 3
    assert st.at_maximum(df, "v", F.lit(True)).first().max_value == 3.0
    assert st.first_percentile_above(df, "v", 2.5).first().first_pct == 76


@pytest.fixture
def large_groups(monkeypatch):
    """Groups of more than a few values are large, so that sketches are used on small tables."""
    monkeypatch.setattr(st, "WHOLE", 20)


def percentiles_of_groups(spark, grid=st.GRID):
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.choice([rng.gauss(0, 1), 0.5])) for _ in range(3000)]
    rows += [("few", float(k % 3)) for k in range(300)] + [("one", 4.0)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r for r in st.percentiles(spark.createDataFrame(rows, "k string, x double"), "x", probs, ["k"], grid).collect()}
    assert set(got) == {"hot", "a", None, "few", "one"}
    for key, row in got.items():
        values = [v for k, v in rows if k == key]
        assert row.n == len(values)
        assert [row[f"p{i}"] for i in range(len(probs))] == pytest.approx(list(np.percentile(values, [100 * p for p in probs])))


def test_percentiles_of_large_groups(spark, large_groups):
    percentiles_of_groups(spark)


@pytest.mark.parametrize("accuracy, grid", [(1, 64), (2, 3), (2000, 1)])
def test_a_poor_sketch_changes_nothing(spark, large_groups, monkeypatch, accuracy, grid):
    """Cells are uneven then, wanted ranks lie anywhere; the results are exact all the same."""
    monkeypatch.setattr(st, "ACCURACY", accuracy)
    percentiles_of_groups(spark, grid)
