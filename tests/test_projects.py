"""Room reports, census questions, store loads and review cleaning on small literal tables."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import census, reviews, rooms, store_sales
from tidewater.sinks.files import combined_json, export_reports

DAY = datetime.date


@pytest.fixture(scope="module")
def dorm(spark):
    r = spark.createDataFrame([(1, "Room #1"), (2, "Room #2"), (3, "Room #1"), (4, "Room #4")], rooms.ROOM_SCHEMA)
    s = spark.createDataFrame(
        [
            (1, "A", DAY(2000, 2, 29), "M", 1), (2, "B", DAY(2001, 1, 1), "F", 1), (3, "C", DAY(1990, 6, 1), "M", 2),
            (4, "D", DAY(1980, 1, 1), "M", 2), (5, "E", DAY(1999, 1, 1), "F", 3), (6, "F", DAY(1999, 1, 1), "F", None),
            (7, "G", DAY(2002, 1, 1), "F", 1),
        ],
        "id int, name string, birthday date, sex string, room_id int",
    )
    return r, s


TODAY = "2021-02-28"


def test_room_reports(dorm):
    reports = {n: [tuple(r) for r in df.collect()] for n, df in rooms.all_reports(*dorm, F.lit(TODAY).cast("date")).items()}
    assert reports["rooms_student_count"] == [(1, "Room #1", 3), (2, "Room #2", 2), (3, "Room #1", 1), (4, "Room #4", 0)]
    assert reports["rooms_min_avg_age"] == [(1, "Room #1", 19.6667), (3, "Room #1", 22.0), (2, "Room #2", 35.5)]
    assert reports["rooms_max_age_diff"] == [(2, "Room #2", 11), (1, "Room #1", 1), (3, "Room #1", 0)]
    assert reports["rooms_mixed_gender"] == [(1, "Room #1")]
    by_name = {r.name: r.students_count for r in rooms.student_counts_by_name(*dorm).collect()}
    assert by_name == {"Room #1": 4, "Room #2": 2, "Room #4": 0}


def test_room_reports_are_exported(dorm, tmp_path):
    reports = rooms.all_reports(*dorm, F.lit(TODAY).cast("date"))
    for kind in ("json", "xml"):
        export_reports(reports, str(tmp_path / kind), kind)
    combined_json(reports, str(tmp_path / "all"))
    document = json.loads("".join(f.read_text() for f in sorted((tmp_path / "all").glob("part-*"))))
    assert document["rooms_mixed_gender"] == [{"id": 1, "name": "Room #1"}] and len(document) == 4


def test_student_load(spark, dorm):
    batch = spark.createDataFrame(
        [(8, "H", DAY(2000, 1, 1), "F", 1), (9, "I", DAY(2000, 1, 1), "X", 1), (10, "J", DAY(2000, 1, 1), "M", 99),
         (1, "K", DAY(2000, 1, 1), "M", 1), (11, "L", DAY(2000, 1, 1), "M", None)],
        rooms.STUDENT_SCHEMA,
    )
    load = rooms.load_students(dorm[1], batch, dorm[0])
    assert sorted(r.id for r in load.inserted.collect()) == [8, 11]
    assert sorted(r.id for r in load.rejected.collect()) == [1, 9, 10]
    assert rooms.load_rooms(dorm[0], dorm[0]).inserted.count() == 0


PEOPLE = [
    (20, "Male", "White", "HS-grad", "Never-married", "Sales", 40, "United-States", "<=50K"),
    (30, "Male", "White", "Masters", "Married-civ-spouse", "Sales", 99, "United-States", ">50K"),
    (40, "Female", "Black", "HS-grad", "Divorced", "Tech", 99, "Cuba", ">50K"),
    (36, "Male", "White", "Bachelors", "Married-AF-spouse", "Tech", 5, "Cuba", "<=50K"),
    (71, "Female", "White", None, "Widowed", None, 10, None, ">50K"),
]
PEOPLE_SCHEMA = (
    "age int, sex string, race string, education string, `marital-status` string, occupation string, "
    "`hours-per-week` int, `native-country` string, salary string"
)


def test_census(spark):
    people = spark.createDataFrame(PEOPLE, PEOPLE_SCHEMA)

    def got(df):
        return [tuple(r) for r in df.collect()]

    assert got(census.by_sex(people)) == [("Male", 3), ("Female", 2)]
    assert census.mean_age(people).first()[0] == pytest.approx(86 / 3)
    assert got(census.share_of_country(people)) == [(40.0, "40.00%")]
    ages = {r.salary: (r.mean_age, r.std_age) for r in census.age_by_salary(people).collect()}
    assert ages["<=50K"] == (28.0, pytest.approx(11.3137085))
    assert got(census.rich_without_degree(people)) == [("HS-grad", 1)]
    stats = {(r.race, r.sex): (r["count"], r.q50, r.max) for r in census.age_statistics(people).collect()}
    assert stats["White", "Male"] == (3, 30.0, 36)
    assert dict(got(census.rich_share_by_marriage(people))) == {"married": 0.5, "single": 0.0}
    assert got(census.hardest_working(people)) == [(99, 2, 1.0)]
    hours = {(r["native-country"], r.salary): r.mean_hours for r in census.hours_by_country(people).collect()}
    assert hours == {("United-States", "<=50K"): 40, ("United-States", ">50K"): 99, ("Cuba", ">50K"): 99, ("Cuba", "<=50K"): 5}
    assert {r.age: r.AgeGroup for r in census.with_age_group(people).collect()}[36] == "adult"
    assert [(r.label, r.n) for r in census.rich_by_age_group(people).collect()] == [("young", 1), ("adult", 1), ("retiree", 1)]
    assert census.richest_age_group(people).first().label == "young"
    assert got(census.occupation_sizes(people)) == [("Sales", 2), ("Tech", 2)]
    assert got(census.young_busy_occupations(people)) == [("Sales",)]


def staged(spark, rows):
    base = dict.fromkeys(store_sales.STAGING, "x")
    base |= {"order_date": "1/5/2016", "ship_date": "12/31/2016", "sales": "261.96", "quantity": "2", "discount": "0.2", "profit": "-41.91",
             "postal_code": "42420", "region": "South"}
    full = [tuple({**base, **r}[c] for c in store_sales.STAGING) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in store_sales.STAGING))


def test_two_store_loads(spark, tmp_path):
    at = F.lit("2024-01-01").cast("timestamp")
    first = staged(spark, [
        {"row_id": "1", "customer_id": "c1", "customer_name": "Ann", "product_id": "p1"},
        {"row_id": "2", "customer_id": "c2", "customer_name": "Bo", "product_id": "p2", "city": "y"},
        {"row_id": "3", "customer_id": "c1", "customer_name": "Ann", "product_id": "p1", "postal_code": None},
    ])
    core = store_sales.load(store_sales.empty_core(spark), first, at)
    assert core["dim_locations"].count() == 3 and core["dim_products"].count() == 2 and core["dim_customers"].count() == 2
    facts = core["fct_orders"].collect()
    # the row without postal code finds no location
    assert sorted(r.source_row_id for r in facts) == ["1", "2"] and sorted(r.order_pk for r in facts) == [1, 2]
    assert str(facts[0].sales) == "261.9600" and facts[0].order_date == DAY(2016, 1, 5)
    second = staged(spark, [
        {"row_id": "1", "customer_id": "c1", "customer_name": "Ann (Updated)", "product_id": "p1"},
        {"row_id": "2", "customer_id": "c2", "customer_name": "Bo", "product_id": "p2", "city": "y", "region": "West"},
        {"row_id": "9", "customer_id": "c9", "customer_name": "New", "product_id": "p9"},
    ])
    after = store_sales.load(core, second, at, by_state=False)
    names = {r.customer_id: (r.customer_sk, r.customer_name) for r in after["dim_customers"].collect()}
    assert names["c1"][1] == "Ann (Updated)" and names["c9"][0] == 3
    assert after["dim_locations"].count() == 3
    assert sorted(r.source_row_id for r in after["fct_orders"].collect()) == ["1", "2", "9"]
    again = store_sales.load(after, second, at, by_state=False)
    assert {n: df.count() for n, df in again.items()} == {n: df.count() for n, df in after.items()}
    star = store_sales.mart(after)
    assert star["fact_sales"].count() == 3 and "valid_from" not in star["dim_customers"].columns
    assert star["dim_calendar"].count() == 4383


def test_prepared_loads(spark):
    rows = staged(spark, [{"row_id": str(i), "customer_name": f"n{i}"} for i in range(1000)])
    initial, second = store_sales.prepare_loads(rows)
    n_first, n_second = initial.count(), second.count()
    assert 750 < n_first < 850
    assert second.filter(F.col("customer_name").endswith("(Updated)")).count() == 20
    assert second.filter("region <> 'South'").count() == 20
    assert n_second == 90 + second.join(initial.select("row_id"), "row_id", "left_anti").count()
    assert 60 < n_second - 90 < 140


def test_reviews(spark):
    rows = spark.createDataFrame([("b", 2, "hi 😀!"), (None, 1, None), ("a", None, "x<y>")], "created_date string, score int, content string")
    got = [tuple(r) for r in reviews.clean_reviews(rows).collect()]
    assert got == [("-", "1", "-"), ("a", "-", "xy"), ("b", "2", "hi !")]
    assert reviews.clean_reviews(rows.select("score")).count() == 3
