"""Unions, splits, samples and shuffles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import sampling as sp
from tidewater.operators.store_sales import prepare_loads
from tidewater.registry import query

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query(
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""
)
def concat_frames(t):
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return customers.unionByName(suppliers)


@query(
    """SELECT o_orderkey, CASE WHEN (o_orderkey * 7919) % 100 < 80 THEN 'initial' ELSE 'rest' END AS part FROM orders"""
)
def split_80_20(t):
    initial, rest = sp.bernoulli_split(t.orders, "o_orderkey", 80, by=F.col("o_orderkey") * 7919)
    return initial.select("o_orderkey", F.lit("initial").alias("part")).unionAll(
        rest.select("o_orderkey", F.lit("rest").alias("part"))
    )


def facts(t, sample):
    """What must hold for a sample of the orders, however it is drawn: one row."""
    known = t.orders.select("o_orderkey", F.lit(1).alias("known"))
    return sample.join(known, "o_orderkey", "left").agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_distinct"), F.count_if(F.col("known").isNull()).alias("n_unknown")
    )


@query("SELECT o_orderkey, CAST(1 AS BIGINT) AS n_parts, true AS about_80 FROM orders")
def split_80_20_hashed(t):
    """Each order lies in one part exactly; the first part is about 80 % of them."""
    initial, rest = sp.bernoulli_split(t.orders, "o_orderkey", 80)
    both = initial.select("o_orderkey", F.lit(1).alias("first")).unionAll(rest.select("o_orderkey", F.lit(0).alias("first")))
    share = both.agg(F.avg("first")).scalar()
    counted = both.groupBy("o_orderkey").agg(F.count("*").alias("n_parts"))
    return counted.withColumn("about_80", share.between(0.75, 0.85))


@query("SELECT true AS about_half, true AS all_distinct, CAST(0 AS BIGINT) AS n_unknown FROM orders LIMIT 1")
def sample_fraction(t):
    found = facts(t, sp.sample_fraction(t.orders, "o_orderkey", 0.5))
    share = F.col("n") / t.orders.agg(F.count("*")).scalar()
    return found.select(share.between(0.44, 0.56).alias("about_half"), (F.col("n") == F.col("n_distinct")).alias("all_distinct"), "n_unknown")


@query("SELECT least(50, count(*)) AS n, least(50, count(DISTINCT o_orderkey)) AS n_distinct, CAST(0 AS BIGINT) AS n_unknown FROM orders")
def sample_rows(t):
    return facts(t, sp.sample_rows(t.orders, "o_orderkey", 50))


@query("SELECT o_orderkey, o_custkey FROM orders")
def shuffle(t):
    return sp.shuffle_rows(t.orders, "o_orderkey").select("o_orderkey", "o_custkey")


@query("SELECT c_custkey, true AS known, true AS changed FROM customer")
def other_region(t):
    """A region drawn for each customer: one there is, and not its own. Some customers have none."""
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    own = F.when(F.col("c_custkey") % 7 != 0, F.col("r_name"))
    moved = sp.other_choice(own, REGIONS, "c_custkey")
    changed = F.coalesce(moved != own, moved.isNotNull())
    return placed.select("c_custkey", F.coalesce(moved.isin(*REGIONS), F.lit(False)).alias("known"), changed.alias("changed"))


@query(
    """SELECT 'in one part or both loads' AS fact, count(*) AS n FROM orders
       UNION ALL SELECT * FROM (VALUES ('repeated', CAST(50 AS BIGINT)), ('renamed', 20), ('moved', 20), ('regions that are none', 0))"""
)
def prepared_loads(t):
    """Counts of the first and the second load: what is new, repeated, renamed and moved.

    Rows may be drawn for more than one kind, so the second load is counted by what differs.
    """
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = t.orders.join(placed, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("row_id"), F.col("c_name").alias("customer_name"), F.col("r_name").alias("region")
    )
    first, second = prepare_loads(rows, regions=REGIONS)
    was = rows.select("row_id", F.col("customer_name").alias("name"), F.col("region").alias("place"))
    loaded = first.select("row_id", F.lit(1).alias("first"))
    again = second.join(was, "row_id").join(loaded, "row_id", "left")
    renamed, moved = F.col("customer_name") != F.col("name"), F.col("region") != F.col("place")
    new = F.col("first").isNull()
    counted = again.agg(
        F.count_if(~new & ~renamed & ~moved).alias("repeated"), F.count_if(~new & renamed).alias("renamed"), F.count_if(~new & moved).alias("moved"),
        F.count_if(~F.col("region").isin(*REGIONS)).alias("regions that are none"),
    )
    left = rows.join(loaded, "row_id", "left_anti").count()
    half = again.agg(F.count_if(new).between(int(left * 0.4), int(left * 0.6) + 1)).scalar()
    whole = first.agg(F.when(half, F.count("*") + left).alias("n")).select(F.lit("in one part or both loads").alias("fact"), "n")
    names = [c for c in counted.columns]
    return whole.unionAll(counted.select(F.stack(F.lit(len(names)), *[x for c in names for x in (F.lit(c), F.col(c))]).alias("fact", "n")))
