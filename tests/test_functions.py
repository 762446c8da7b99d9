import datetime
import decimal
import re

import pytest
from pyspark.sql import functions as F

from tidewater.functions import dates, text, values
from tidewater.operators import sampling as sp
from tidewater.operators import validation as va
from tidewater.operators.purchases import EVENT_SCHEMA, load_star, preview, stage_purchases
from tidewater.operators.trips import chart_feed, clean_trips, daily_metrics, station_counts


def one(spark, column, **inputs):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in inputs.items())
    return spark.createDataFrame([tuple(v for v, _ in inputs.values())], schema).select(column.alias("x")).first().x


SAMPLES = ["Привет, мир! 😀 #1", "a_b-c?.,! x²½", "naïve\tcafé\n$5%", "", "漢字★"]


@pytest.mark.parametrize("sample", SAMPLES)
def test_clean_text(spark, sample):
    assert one(spark, text.clean_text(F.col("s")), s=(sample, "string")) == re.sub(r"[^\w\s.,?!-]", "", sample)


def test_clean_text_leaves_other_columns(spark):
    df = spark.createDataFrame([(1,)], "content int")
    assert text.clean_text_column(df, "content").first().content == 1
    assert text.clean_text_column(df, "absent") is df


def test_names(spark):
    assert one(spark, text.proper(F.col("s")), s=("mARY", "string")) == "Mary"
    assert one(spark, text.full_name(F.col("a"), F.col("b")), a=("A", "string"), b=(None, "string")) is None
    assert one(spark, text.file_name(F.col("p")), p=("a/b/c.csv", "string")) == "c.csv"
    words = text.tokens(F.col("t"), F.col("d"))
    assert one(spark, text.has_all_terms(words, ["Fate", "india"]), t=("FATE!", "string"), d=("in India.", "string"))
    for words_of, term, want in (("the Fäte", "fäte", True), ("fate2", "fate", False), ("a_fate_b", "fate", True), (None, "fate", False)):
        assert one(spark, text.mentions_all_terms([term], F.col("t")), t=(words_of, "string")) is want
    with pytest.raises(ValueError):
        text.mentions_all_terms(["a.b"], F.col("t"))
    assert not one(spark, text.has_all_terms(words, ["fat"]), t=("FATE!", "string"), d=(None, "string"))


@pytest.mark.parametrize(
    "born, today, want",
    [("2000-02-29", "2001-02-28", 0), ("2000-02-29", "2001-03-01", 1), ("2000-05-10", "2010-05-09", 9), ("2000-05-10", "2010-05-10", 10)],
)
def test_whole_years(spark, born, today, want):
    years = dates.whole_years(F.lit(born).cast("date"), F.lit(today).cast("date"))
    assert spark.range(1).select(years).first()[0] == want


def test_dates(spark):
    assert one(spark, dates.us_date(F.col("s")), s=("1/5/2020", "string")) == datetime.date(2020, 1, 5)
    assert one(spark, dates.try_us_date(F.col("s")), s=("2020-01-05", "string")) is None
    with pytest.raises(Exception):
        one(spark, dates.us_date(F.col("s")), s=("junk", "string"))
    assert one(spark, dates.epoch_seconds(F.col("s")).cast("timestamp_ntz"), s=("60", "string")) == datetime.datetime(1970, 1, 1, 0, 1)
    assert one(spark, dates.epoch_seconds(F.col("s")), s=("2020-01-01 00:00:00", "string")) is None
    assert one(spark, dates.month_back(F.col("d"), 3), d=(datetime.date(2020, 5, 31), "date")) == datetime.date(2020, 2, 1)


@pytest.mark.parametrize("raw, want", [("12", 12), (" -7 ", -7), ("+3", 3), ("x", None), ("1x", None), ("1.5", None), ("", None), (None, None), ("99999999999", None)])
def test_whole_number(spark, raw, want):
    assert one(spark, values.whole_number(F.col("s"), "int"), s=(raw, "string")) == want


def test_values(spark):
    assert one(spark, values.speed_kmh(F.col("m"), F.col("s")), m=(1000.0, "double"), s=(3600.0, "double")) == 1.0
    for seconds in (0.0, -1.0, None):
        assert one(spark, values.speed_kmh(F.col("m"), F.col("s")), m=(1000.0, "double"), s=(seconds, "double")) == 0.0
    flipped = F.transform("a", lambda x: values.flip_between(x, 3, 8))
    assert one(spark, flipped, a=([3, 4, 7, 8], "array<int>")) == [3, -4, -7, 8]
    assert one(spark, values.differences(F.col("a")), a=([1, 4, 2], "array<int>")) == [3, -2]
    assert one(spark, values.differences(F.col("a")), a=([1], "array<int>")) == []
    assert one(spark, values.differences(F.col("a")), a=([], "array<int>")) == []
    item = values.rename_key(values.without_empty(F.col("m")), "a", "A")
    assert one(spark, item, m=({"a": "1", "b": "", "c": None}, "map<string,string>")) == {"A": "1"}
    assert one(spark, values.amount_or_zero(F.col("d")), d=(None, "decimal(10,2)")) == 0.0


def test_validation(spark):
    df = spark.createDataFrame([(1, "M", 1950), (2, "Q", None), (3, None, 2200)], "id int, sex string, year int")
    rules = {"sex": F.col("sex").isin("M", "F"), "year": F.col("year").between(1901, 2155)}
    good, bad = va.split_valid(df, rules)
    assert [r.id for r in good.collect()] == [1] and good.columns == df.columns
    assert {r.id: r._errors for r in bad.collect()} == {2: ["sex", "year"], 3: ["sex", "year"]}
    with pytest.raises(ValueError, match="date"):
        va.require_columns(df, ["id", "date"])
    assert va.when_column(df, "absent", lambda d: d.limit(0)) is df
    assert tuple(va.fill_all_nulls(df).orderBy("id").collect()[1]) == ("2", "Q", "-")
    assert df.filter(va.visible_to("ANALYST", ["ACCOUNTADMIN"])).count() == 0
    both = spark.createDataFrame([(None, "x"), ("y", "z")], "`Departure time` string, departure string")
    picked = va.first_present(both, ["Departure time", "departure"], "t")
    assert sorted(r.t for r in picked.collect()) == ["x", "y"] and picked.columns == ["t"]
    with pytest.raises(ValueError):
        va.first_present(df, ["nope"], "t")


def test_decimals_to_double_everywhere(spark):
    d = decimal.Decimal("1.50")
    df = spark.createDataFrame(
        [(d, [d], (1, d), {"k": d}, "s")],
        "a decimal(5,2), b array<decimal(5,2)>, c struct<i:int,d:decimal(5,2)>, m map<string,decimal(5,2)>, s string",
    )
    row = va.decimals_to_double(df).first()
    assert (row.a, row.b, tuple(row.c), row.m, row.s) == (1.5, [1.5], (1, 1.5), {"k": 1.5}, "s")


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    chosen, rest = sp.bernoulli_split(df, "id", 80)
    assert chosen.count() + rest.count() == 2000 and chosen.intersect(rest).count() == 0
    assert 1500 < chosen.count() < 1700
    again, _ = sp.bernoulli_split(df.repartition(13), "id", 80)
    assert chosen.exceptAll(again).isEmpty()
    assert sp.sample_rows(df, "id", 50).exceptAll(sp.sample_rows(df.repartition(7), "id", 50)).isEmpty()
    assert sp.sample_rows(df, "id", 50).count() == 50 and sp.sample_rows(df.limit(3), "id", 50).count() == 3
    order = [r.id for r in sp.shuffle_rows(df, "id").collect()]
    assert order != sorted(order) and sorted(order) == list(range(2000))
    assert order == [r.id for r in sp.shuffle_rows(df.repartition(5), "id").collect()]
    picked = df.select(sp.other_choice(F.lit("b"), ["a", "b", "c"], "id").alias("r")).distinct()
    assert sorted(r.r for r in picked.collect()) == ["a", "c"]


def event(price=10.0, quantity=2, key="evt_1"):
    return (key, "purchase", "u_1", "game_1", "prod_1", "Coins", price, quantity, "2023-12-18 10:00:00", "PL")


def test_stage_purchases(spark):
    staged = stage_purchases(spark.createDataFrame([event(), event(None, 5, "evt_2")], EVENT_SCHEMA))
    rows = {r.purchase_id: r for r in staged.collect()}
    assert len(staged.columns) == 7 and rows["evt_1"].total_amount == 20.0 and rows["evt_2"].total_amount is None
    types = dict(staged.dtypes)
    assert types["purchase_timestamp"] == "timestamp" and types["total_amount"] == "decimal(10,2)"
    empty = stage_purchases(spark.createDataFrame([], EVENT_SCHEMA))
    assert empty.count() == 0 and "purchase_id" in empty.columns


def test_load_star(spark):
    staged = stage_purchases(spark.createDataFrame([event(), event(), event(key="evt_0")], EVENT_SCHEMA))
    users = spark.createDataFrame([("u_1", "PL")], "user_id string, country string")
    games = spark.createDataFrame([("g_001", "Minecraft")], "game_id string, title string")
    products = spark.createDataFrame([], "product_id string, name string, price decimal(10,2)")
    loaded = load_star(staged, users, games, products, staged.filter("purchase_id = 'evt_0'"))
    assert [r.purchase_id for r in loaded["fact_purchases"].collect()] == ["evt_1"]
    assert loaded["dim_users"].count() == 0
    assert [tuple(r) for r in loaded["dim_games"].collect()] == [("game_1", "Unknown Game")]
    assert loaded["dim_products"].first().price == 0
    shown = preview(staged.withColumn("total_amount", F.lit(None).cast("decimal(10,2)")), "purchase_id", 2)
    assert [r.total_amount for r in shown.collect()] == [0.0, 0.0]


def test_trips(spark):
    rows = [
        ("2020-05-01 10:00:00", "A", "B", "3600", "1000", "10.5"),
        ("2020-05-01 11:00:00", "A", None, "0", "500", None),
        (None, "C", "B", None, "1", "1"),
    ]
    schema = "`Departure time` string, departure_name string, return_name string, `duration (sec.)` string, `distance (m)` string, `Air temperature (degC)` string"
    trips = clean_trips(spark.createDataFrame(rows, schema))
    days = {r.Date: r for r in daily_metrics(trips).collect()}
    assert set(days) == {"2020-05-01", None}
    may = days["2020-05-01"]
    assert (may.AvgDistance, may.AvgDuration, may.AvgSpeed, may.AvgTemp, may.TripCount) == (750.0, 1800.0, 0.5, 10.5, 2)
    assert days[None].AvgSpeed == 0.0
    assert {r.station_ret: r.n for r in station_counts(trips, "station_ret", "n").collect()} == {"B": 2, None: 1}
    feed = spark.createDataFrame([("d", "1,5"), ("d", "2.5")], "Date string, AvgTemp string")
    assert chart_feed(feed).first().AvgTemp == 4.0
