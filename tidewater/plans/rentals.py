"""Rental functions: an item is a copy (part, supplier, line number), a line is a rental and its payment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import rentals as rn
from tidewater.registry import query

AS_OF = "1999-06-15"
ITEM = ["l_partkey", "l_suppkey", "l_linenumber"]
RETURNED_SQL = "CASE WHEN l_linestatus <> 'O' THEN l_shipdate END"


def rentals(t):
    """One row per line: item, customer, dates, rate and allowed days."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
        F.col("p_retailprice").alias("rental_rate"),
        F.col("p_size").alias("rental_duration"),
    )


def ledger(t):
    """Rentals and payments of one line beside each other."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
        F.col("p_retailprice").alias("rental_rate"),
        F.col("p_size").alias("rental_duration"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
    )


def payments(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
    )


def customers(t):
    return t.customer.withColumnRenamed("c_custkey", "customer_id")


def copies(t):
    """Rentals by item; the film is the part, the store the line number."""
    return t.lineitem.select(
        *ITEM,
        "l_orderkey",
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
    )


def labelled(items):
    return items.select(F.concat_ws("-", *ITEM).alias("item_id"))


def inventory(t):
    return copies(t).select(*ITEM).distinct()


@query(
    f"""WITH r AS (SELECT o_custkey AS c, o_orderdate AS d, {RETURNED_SQL} AS b, p_retailprice AS rate, p_size AS days,
                          l_extendedprice AS amount, l_shipdate AS paid
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
        SELECT c_custkey AS customer_id,
               round(coalesce(sum(rate) FILTER (d <= TIMESTAMP '{AS_OF}'), 0)
                 + coalesce(sum(coalesce(greatest(date_sub('day', d, b) - days, 0), 0)) FILTER (d <= TIMESTAMP '{AS_OF}'), 0)
                 - coalesce(sum(amount) FILTER (paid <= TIMESTAMP '{AS_OF}'), 0), 2) AS balance
        FROM customer LEFT JOIN r ON c = c_custkey GROUP BY c_custkey"""
)
def customer_balance(t):
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    both = ledger(t)
    balances = rn.customer_balance(customers(t), both, both, as_of)
    return balances.withColumn("balance", F.round("balance", 2))


@query(
    f"""SELECT c_custkey AS customer_id, c_name FROM customer WHERE c_custkey IN (
          SELECT o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          WHERE l_shipdate >= TIMESTAMP '1999-03-01' AND l_shipdate < TIMESTAMP '1999-04-01'
          GROUP BY o_custkey HAVING sum(l_extendedprice) > 50000 AND count(*) > 1)"""
)
def rewards(t):
    as_of = F.lit(AS_OF).cast("date")
    return rn.rewards_report(customers(t), payments(t), 1, 50000, as_of).select("customer_id", "c_name")


@query(
    """SELECT DISTINCT concat_ws('-', l_partkey, l_suppkey, l_linenumber) AS item_id, o_custkey AS customer_id
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'O'"""
)
def held_by(t):
    held = copies(t).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = rn.held_by(held, ITEM, "o_custkey", "return_date").distinct()
    return pairs.select(F.concat_ws("-", *ITEM).alias("item_id"), F.col("o_custkey").alias("customer_id"))


@query(
    """SELECT concat_ws('-', l_partkey, l_suppkey, l_linenumber) AS item_id FROM lineitem
       GROUP BY l_partkey, l_suppkey, l_linenumber HAVING count(*) FILTER (l_linestatus = 'O') = 0"""
)
def in_stock(t):
    return labelled(rn.in_stock(inventory(t), copies(t), ITEM, "return_date"))


@query(
    """SELECT concat_ws('-', l_partkey, l_suppkey, l_linenumber) AS item_id FROM lineitem WHERE l_partkey = 7 AND l_linenumber = 3
       GROUP BY l_partkey, l_suppkey, l_linenumber HAVING count(*) FILTER (l_linestatus = 'O') = 0"""
)
def film_in_stock(t):
    return labelled(rn.film_in_stock(inventory(t), copies(t), 7, 3, "l_partkey", "l_linenumber", ITEM, "return_date"))


@query(
    """SELECT concat_ws('-', l_partkey, l_suppkey, l_linenumber) AS item_id FROM lineitem WHERE l_partkey = 7 AND l_linenumber = 3
       GROUP BY l_partkey, l_suppkey, l_linenumber HAVING count(*) FILTER (l_linestatus = 'O') > 0"""
)
def film_not_in_stock(t):
    return labelled(rn.film_not_in_stock(inventory(t), copies(t), 7, 3, "l_partkey", "l_linenumber", ITEM, "return_date"))


@query(
    """SELECT l_partkey AS film, l_linenumber AS store, count(*) FILTER (held = 0) AS in_stock, count(*) FILTER (held > 0) AS out
       FROM (SELECT l_partkey, l_linenumber, l_suppkey, count(*) FILTER (l_linestatus = 'O') AS held FROM lineitem GROUP BY ALL)
       GROUP BY ALL"""
)
def stock_by_film(t):
    """How many items of each film a store has and lacks, by lateral calls of the table functions for all films."""
    rn.stock_functions(inventory(t), copies(t), "l_partkey", "l_linenumber", ITEM, "return_date")
    inventory(t).select("l_partkey", "l_linenumber").distinct().createOrReplaceTempView("films_and_stores")
    return t.spark.sql(
        """SELECT film, store, count_if(here) AS in_stock, count_if(NOT here) AS out FROM (
             SELECT f.l_partkey AS film, f.l_linenumber AS store, true AS here
             FROM films_and_stores f, LATERAL film_in_stock(f.l_partkey, f.l_linenumber)
             UNION ALL
             SELECT f.l_partkey, f.l_linenumber, false FROM films_and_stores f, LATERAL film_not_in_stock(f.l_partkey, f.l_linenumber))
           GROUP BY film, store"""
    )
