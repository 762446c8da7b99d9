"""Search through posting lists and SQL table functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.functions.text import has_all_terms, tokens
from tidewater.operators.postings import with_all_terms, write_postings
from tidewater.operators.rentals import film_in_stock, film_not_in_stock, stock_functions

SCHEMA = "term string, block int, docs array<bigint>, bucket int"


def test_postings_equal_a_scan(spark, tmp_path):
    rng = random.Random(4)
    words = ["The", "and", "ÉTÉ", "x1", "rare", "a", "日本"]
    rows = [(i, " ,".join(rng.choices(words, [9, 5, 2, 2, 1, 3, 1], k=rng.randint(0, 9))) + rng.choice(["", ".", "the"])) for i in range(500)]
    rows += [(900, None), (901, "the-and"), (901, "rare"), (None, "the and rare")]
    docs = spark.createDataFrame(rows, "id bigint, body string")
    write_postings(docs, "id", [F.col("body")], str(tmp_path / "p"), buckets=8, blocks=5)
    lists = spark.read.schema(SCHEMA).parquet(str(tmp_path / "p"))
    stored = lists.collect()
    assert all(r.docs == sorted(set(r.docs)) for r in stored) and max(len(r.docs) for r in stored) < 200
    for terms in (["the"], ["the", "AND"], ["rare", "été", "the"], ["日本", "a"], ["absent", "the"], ["the", "the"]):
        held = docs.filter(F.col("id").isNotNull()).groupBy("id").agg(F.flatten(F.collect_list(tokens(F.col("body")))).alias("w"))
        want = {r.id for r in held.filter(has_all_terms(F.col("w"), terms)).collect()}
        got = [r.id for r in with_all_terms(lists, terms, "id", buckets=8).collect()]
        assert set(got) == want and len(got) == len(want)
    with pytest.raises(ValueError):
        with_all_terms(lists, ["two words"], "id")


def test_only_the_terms_buckets_are_read(spark, tmp_path):
    docs = spark.range(300).select("id", F.concat(F.lit("w"), F.col("id") % 50).alias("body"))
    write_postings(docs, "id", [F.col("body")], str(tmp_path / "p"), buckets=16)
    found = with_all_terms(spark.read.schema(SCHEMA).parquet(str(tmp_path / "p")), ["w7"], "id", buckets=16)
    assert sorted(r.id for r in found.collect()) == list(range(7, 300, 50))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", plan) and "PushedFilters: [" in plan and "EqualTo(term,w7)" in plan


def test_table_functions(spark):
    copies = spark.createDataFrame([(f, s, i) for i, (f, s) in enumerate([(1, 1), (1, 1), (1, 2), (2, 1), (None, 1)])], "film bigint, store int, item int")
    rentals = spark.createDataFrame([(0, None), (0, "back"), (1, "back"), (3, None), (9, None)], "item int, returned string")
    stock_functions(copies, rentals, "film", "store", ["item"], "returned")
    for name, plain in (("film_in_stock", film_in_stock), ("film_not_in_stock", film_not_in_stock)):
        for film, store in ((1, 1), (1, 2), (2, 1), (7, 7)):
            want = plain(copies, rentals, film, store, "film", "store", ["item"], "returned").collect()
            assert sorted(spark.sql(f"SELECT * FROM {name}({film}, {store})").collect()) == sorted(want)
    calls = spark.sql("SELECT v.f, v.s, t.item FROM VALUES (1L, 1), (2L, 1), (1L, 2), (NULL, 1) AS v(f, s), LATERAL film_in_stock(v.f, v.s) t")
    assert sorted(map(tuple, calls.collect())) == [(1, 1, 1), (1, 2, 2)]
    plan = calls._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
