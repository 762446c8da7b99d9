import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.operators import rentals as rn


def day(text):
    return datetime.datetime.fromisoformat(text)


@pytest.fixture
def shop(spark):
    inventory = spark.createDataFrame([(i, 1 if i < 4 else 2, 1) for i in range(1, 6)], "item int, film int, store int")
    rentals = spark.createDataFrame(
        [(1, 10, day("2020-01-01"), day("2020-01-03")), (2, 11, day("2020-01-02"), None), (2, 12, day("2020-01-01"), day("2020-01-02")), (4, 10, day("2020-02-01"), None)],
        "item int, customer int, rented timestamp_ntz, returned timestamp_ntz",
    )
    return inventory, rentals


def test_stock(shop):
    inventory, rentals = shop
    assert sorted(r.item for r in rn.in_stock(inventory, rentals, ["item"], "returned").collect()) == [1, 3, 5]
    assert sorted(r.item for r in rn.not_in_stock(inventory, rentals, ["item"], "returned").collect()) == [2, 4]
    args = (inventory, rentals, 1, 1, "film", "store", ["item"], "returned")
    assert sorted(r.item for r in rn.film_in_stock(*args).collect()) == [1, 3]
    assert [r.item for r in rn.film_not_in_stock(*args).collect()] == [2]
    assert sorted(tuple(r) for r in rn.held_by(rentals, ["item"], "customer", "returned").collect()) == [(2, 11), (4, 10)]


def test_customer_balance(spark):
    customers = spark.createDataFrame([(1,), (2,), (3,)], "customer_id int")
    rentals = spark.createDataFrame(
        [
            (1, day("2020-01-01"), day("2020-01-06T23:00"), 4.0, 3, 20.0),  # 5 whole days, 2 late
            (1, day("2020-01-01"), None, 2.0, 3, 20.0),
            (1, day("2021-01-01"), None, 100.0, 3, 20.0),
            (2, day("2020-01-01"), day("2020-02-01"), 1.0, 3, 20.0),  # 28 days late
        ],
        "customer_id int, rental_date timestamp_ntz, return_date timestamp_ntz, rental_rate double, rental_duration int, replacement_cost double",
    )
    payments = spark.createDataFrame(
        [(1, 5.0, day("2020-01-02")), (1, 9.0, day("2021-05-01"))], "customer_id int, amount double, payment_date timestamp_ntz"
    )
    as_of = F.lit("2020-12-31").cast("timestamp_ntz")
    got = {r.customer_id: r.balance for r in rn.customer_balance(customers, rentals, payments, as_of).collect()}
    assert got == {1: 3.0, 2: 29.0, 3: 0.0}
    charged = rn.customer_balance(customers, rentals, payments, as_of, replacement=True)
    assert {r.customer_id: r.balance for r in charged.collect()} == {1: 3.0, 2: 49.0, 3: 0.0}


def test_rewards_report(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "customer_id int, name string")
    payments = spark.createDataFrame(
        [(1, 6.0, day("2020-02-01")), (1, 5.0, day("2020-02-29T23:59")), (2, 50.0, day("2020-02-05")), (3, 6.0, day("2020-02-05")), (3, 5.0, day("2020-03-01"))],
        "customer_id int, amount double, payment_date timestamp_ntz",
    )
    as_of = F.lit("2020-05-31").cast("date")
    assert [r.name for r in rn.rewards_report(customers, payments, 1, 10, as_of).collect()] == ["a"]
    for bad in ((0, 10), (1, 0)):
        with pytest.raises(ValueError):
            rn.rewards_report(customers, payments, *bad, as_of)
