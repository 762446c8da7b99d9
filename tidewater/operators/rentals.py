"""Rental shop functions in set form: all items or customers at once, never a lookup per row."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import month_back
from tidewater.functions.values import from_units, units


def held_by(rentals: DataFrame, item: Sequence[str], customer: str, returned: str) -> DataFrame:
    """(item columns, customer) of every rental not returned."""
    return rentals.filter(F.col(returned).isNull()).select(*item, customer)


def out_items(rentals: DataFrame, item: Sequence[str], returned: str) -> DataFrame:
    return rentals.filter(F.col(returned).isNull()).select(*item).distinct()


def in_stock(inventory: DataFrame, rentals: DataFrame, item: Sequence[str], returned: str) -> DataFrame:
    """Items without an open rental; an item never rented is in stock."""
    return inventory.join(out_items(rentals, item, returned), list(item), "left_anti")


def not_in_stock(inventory: DataFrame, rentals: DataFrame, item: Sequence[str], returned: str) -> DataFrame:
    return inventory.join(out_items(rentals, item, returned), list(item), "left_semi")


def film_in_stock(inventory: DataFrame, rentals: DataFrame, film, store, film_col: str, store_col: str,
                  item: Sequence[str], returned: str) -> DataFrame:
    """Item ids of one film in one store that are in stock."""
    copies = inventory.filter((F.col(film_col) == film) & (F.col(store_col) == store))
    return in_stock(copies, rentals, item, returned).select(*item)


def film_not_in_stock(inventory: DataFrame, rentals: DataFrame, film, store, film_col: str, store_col: str,
                      item: Sequence[str], returned: str) -> DataFrame:
    copies = inventory.filter((F.col(film_col) == film) & (F.col(store_col) == store))
    return not_in_stock(copies, rentals, item, returned).select(*item)


def stock_functions(inventory: DataFrame, rentals: DataFrame, film_col: str, store_col: str, item: Sequence[str], returned: str) -> None:
    """Makes ``film_in_stock(film, store)`` and ``film_not_in_stock(film, store)`` known to SQL of the session.

    They return a table of items and are planned into the query that calls them: a lateral call for many
    films becomes one join, not a lookup per film. The tables are those given here, under names of their own.
    """
    spark = inventory.sparkSession
    names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("copies", "held")]
    inventory.select(F.col(film_col).alias("film_id"), F.col(store_col).alias("store_id"), *item).createOrReplaceTempView(names[0])
    out_items(rentals, item, returned).createOrReplaceTempView(names[1])
    columns = ", ".join(f"`{c}` {inventory.schema[c].dataType.simpleString()}" for c in item)
    film, store = (inventory.schema[c].dataType.simpleString() for c in (film_col, store_col))
    held = " AND ".join(f"h.`{c}` = c.`{c}`" for c in item)
    chosen = ", ".join(f"c.`{c}`" for c in item)
    for name, test in (("film_in_stock", "NOT EXISTS"), ("film_not_in_stock", "EXISTS")):
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(film {film}, store {store}) RETURNS TABLE ({columns})
                RETURN SELECT {chosen} FROM {names[0]} c WHERE c.film_id = {name}.film AND c.store_id = {name}.store
                       AND {test} (SELECT 1 FROM {names[1]} h WHERE {held})"""
        )


def customer_balance(customers: DataFrame, rentals: DataFrame, payments: DataFrame, as_of: Column,
                     replacement: bool = False) -> DataFrame:
    """Balance of every customer at a date: rental fees + late fees - payments.

    ``rentals``: customer_id, rental_date, return_date, rental_rate, rental_duration (days)
    and, with ``replacement``, replacement_cost. ``payments``: customer_id, amount,
    payment_date. A late fee is 1 per whole day beyond the rental duration; a rental not
    returned has none. ``replacement`` charges the cost of a film overdue by more than
    twice its duration (documented for the function, left out of its body: off).
    """
    overdue = F.timestamp_diff("DAY", F.col("rental_date"), F.col("return_date")) - F.col("rental_duration")
    charge = F.col("rental_rate") + F.coalesce(F.greatest(overdue, F.lit(0)), F.lit(0))
    if replacement:
        lost = overdue > F.col("rental_duration") * 2
        charge = charge + F.when(lost, F.col("replacement_cost")).otherwise(0)
    charged, paid = F.sum(units(charge)).alias("_charged"), F.sum(units(F.col("amount"))).alias("_paid")
    if rentals is payments:
        # one table holds both: it is read and summed once
        due = F.when(F.col("rental_date") <= as_of, units(charge))
        come = F.when(F.col("payment_date") <= as_of, units(F.col("amount")))
        sums = [rentals.groupBy("customer_id").agg(F.sum(due).alias("_charged"), F.sum(come).alias("_paid"))]
    else:
        charges = rentals.filter(F.col("rental_date") <= as_of).groupBy("customer_id").agg(charged)
        sums = [charges, payments.filter(F.col("payment_date") <= as_of).groupBy("customer_id").agg(paid)]
    found = customers.select("customer_id")
    for part in sums:
        found = found.join(part, "customer_id", "left")
    return (
        found
        .select("customer_id", from_units(F.coalesce("_charged", F.lit(0)) - F.coalesce("_paid", F.lit(0))).alias("balance"))
    )


def rewards_report(customers: DataFrame, payments: DataFrame, min_purchases: int, min_amount: float, as_of: Column,
                   months: int = 3) -> DataFrame:
    """Customers above both limits in the whole month that lies ``months`` months back."""
    if not min_purchases > 0:
        raise ValueError("minimum monthly purchases must be > 0")
    if not min_amount > 0:
        raise ValueError("minimum monthly amount must be > 0")
    first = month_back(as_of, months)
    month = payments.filter((F.col("payment_date") >= first) & (F.col("payment_date") < F.date_add(F.last_day(first), 1)))
    rewarded = (
        month.groupBy("customer_id").agg(F.sum(units(F.col("amount"))).alias("_sum"), F.count("*").alias("_n"))
        .filter((F.col("_sum") > units(F.lit(min_amount))) & (F.col("_n") > min_purchases))
    )
    return customers.join(rewarded, "customer_id", "left_semi")
