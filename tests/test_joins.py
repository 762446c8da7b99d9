import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import joins as jn
from tidewater.operators.ranking import first_per_key, top_dense


def ints(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


@pytest.mark.parametrize(
    "right, want",
    [([2, 3], [1]), ([2, None], []), ([], [1, 2, None]), ([None], []), ([9], [1, 2])],
)
def test_not_in_has_sql_null_rules(spark, right, want):
    got = jn.not_in(ints(spark, [1, 2, None]), ints(spark, right, "r"), "k", "r")
    assert sorted((r.k for r in got.collect()), key=str) == sorted(want, key=str)


def test_anti_and_semi_join(spark):
    left, right = ints(spark, [1, 2, 2, None]), ints(spark, [2, 2, None], "r")
    assert sorted(str(r.k) for r in jn.without_match(left, right, "k", "r").collect()) == ["1", "None"]
    assert [r.k for r in jn.with_match(left, right, "k", "r").collect()] == [2, 2]


def test_children_counted_keeps_empty_parents(spark):
    got = jn.children_counted(ints(spark, [1, 2]), "k", ints(spark, [1, 1, None], "c"), "c", "n")
    assert {r.k: r.n for r in got.collect()} == {1: 2, 2: 0}


def test_direct_product_known_answer(spark):
    df = spark.createDataFrame([(1, [[1, 2], [3, 4], [5, 6]])], "id int, v array<array<int>>")
    got = [tuple(r.combination) for r in jn.direct_product(df, "v").collect()]
    assert sorted(got) == sorted(itertools.product([1, 2], [3, 4], [5, 6]))


def test_rows_covering_both_forms(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(10) for _ in range(3)]) for i in range(50)]
    sets = [[1, 2], [7, 4]]
    want = sorted(i for i, row in rows if all(set(row) & set(s) for s in sets))
    df = spark.createDataFrame(rows, "id int, row array<int>")
    assert sorted(r.id for r in jn.rows_covering(df, "row", sets).collect()) == want
    long_rows = df.select("id", F.explode("row").alias("e"))
    long_sets = spark.createDataFrame([(i, e) for i, s in enumerate(sets) for e in s], "s int, e int")
    assert sorted(r.id for r in jn.keys_covering(long_rows, "id", "e", long_sets, "s", "e").collect()) == want


def test_a_vector_travels_once_for_each_column_of_the_grid(spark):
    """40 tiles, 4 columns: 4 copies of a left vector, not 40."""
    x = spark.range(100).select(F.col("id").alias("x"), F.array(F.col("id").cast("double")).alias("v"))
    y = spark.range(120).select(F.col("id").alias("y"), F.array(F.col("id").cast("double")).alias("w"))
    assert jn.grid_cells(x, "x", "v", F.lit(4), 4).groupBy("x").count().agg(F.min("count"), F.max("count")).first() == (4, 4)
    wrong = jn.distance_matrix(x, "x", "v", y, "y", "w", 3, 4).where("distance <> abs(x - y)")
    got = jn.distance_matrix(x, "x", "v", y, "y", "w", 3, 4)
    assert wrong.count() == 0 and got.select("x", "y").distinct().count() == got.count() == 12_000


@pytest.mark.parametrize("tile, spread", [(1, 1), (3, 2), (512, 16)])
def test_distance_matrix(spark, tile, spread):
    rng = random.Random(2)
    xs = [(i, [rng.random() for _ in range(4)]) for i in range(9)]
    ys = [(i, [rng.random() for _ in range(4)]) for i in range(7)]
    x = spark.createDataFrame(xs, "x int, v array<double>")
    y = spark.createDataFrame(ys, "y int, w array<double>")
    got = {(r.x, r.y): r.distance for r in jn.distance_matrix(x, "x", "v", y, "y", "w", tile, spread).collect()}
    assert len(got) == 63
    for (i, a), (j, b) in itertools.product(xs, ys):
        assert got[i, j] == pytest.approx(math.dist(a, b))


def test_top_dense_keeps_ties(spark):
    rows = [("a", 9), ("b", 9), ("c", 8), ("d", 7), ("e", 7), ("f", 1)]
    df = spark.createDataFrame(rows, "name string, n int")
    got = {r.name: r.rnk for r in top_dense(df, "n", 3).collect()}
    assert got == {"a": 1, "b": 1, "c": 2, "d": 3, "e": 3}
    grouped = df.withColumn("g", F.when(F.col("name") > "c", "x"))
    assert {(r.g, r.name) for r in top_dense(grouped, "n", 1, ["g"]).collect()} == {(None, "a"), (None, "b"), ("x", "d"), ("x", "e")}


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, 1, "z")], "k int, o int, v string")
    assert {r.k: r.v for r in first_per_key(df, ["k"], ["o"]).collect()} == {1: "y", 2: "z"}
    assert {r.k: r.v for r in first_per_key(df, ["k"], ["-o"]).collect()} == {1: "x", 2: "z"}


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
