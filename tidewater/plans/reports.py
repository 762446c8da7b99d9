"""Shop reports: rental-style rankings and totals, room reports, listings.

Roles: part = film, p_type = category, supplier = actor or store, lineitem = rental and
payment, customer / nation / region = customer / city / country, orders = students of a room.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import hours_between
from tidewater.functions.text import full_name, proper
from tidewater.functions.values import from_units, units
from tidewater.operators import rooms
from tidewater.operators.joins import children_counted, rollup_to, with_match, without_match
from tidewater.operators.ranking import first_per_key, top_dense, top_rows
from tidewater.operators.warehouse import row_counts
from tidewater.registry import query

AS_OF = "2002-01-01"


REVENUE_SQL = "round(sum(CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS BIGINT)) / 10000.0, 4)"


def revenue():
    return units(F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query(
    """SELECT p_type, CAST(count(*) AS BIGINT) AS item_count
       FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_type ORDER BY item_count DESC, p_type"""
)
def type_item_count(t):
    per_part = rollup_to(t.lineitem, "l_partkey", {"n": F.count("*")}, t.part, "p_partkey")
    return per_part.groupBy("p_type").agg(F.sum("n").alias("item_count")).orderBy(F.desc("item_count"), "p_type")


@query(
    """SELECT s_suppkey, s_name, CAST(count(*) AS BIGINT) AS rental_count
       FROM supplier JOIN lineitem ON s_suppkey = l_suppkey
       GROUP BY s_suppkey, s_name ORDER BY rental_count DESC, s_suppkey LIMIT 10"""
)
def top_supp_count(t):
    counted = rollup_to(t.lineitem, "l_suppkey", {"rental_count": F.count("*")}, t.supplier, "s_suppkey")
    return top_rows(
        counted.select("s_suppkey", "s_name", "rental_count"), 10, F.desc("rental_count"), F.col("s_suppkey")
    )


@query(
    f"""SELECT s_suppkey, s_name, {REVENUE_SQL} AS total_revenue
       FROM supplier JOIN lineitem ON s_suppkey = l_suppkey
       GROUP BY s_suppkey, s_name ORDER BY total_revenue DESC, s_suppkey LIMIT 10"""
)
def top_supp_revenue(t):
    summed = rollup_to(t.lineitem, "l_suppkey", {"total_revenue": F.sum(revenue())}, t.supplier, "s_suppkey")
    rounded = summed.select("s_suppkey", "s_name", from_units(F.col("total_revenue")).alias("total_revenue"))
    return top_rows(rounded, 10, F.desc("total_revenue"), F.col("s_suppkey"))


def sales_per_type(t):
    per_part = rollup_to(t.lineitem, "l_partkey", {"s": F.sum(revenue())}, t.part, "p_partkey")
    return per_part.groupBy("p_type").agg(from_units(F.sum("s")).alias("total_sales"))


@query(
    f"""SELECT p_type, {REVENUE_SQL} AS total_sales
       FROM part JOIN lineitem ON p_partkey = l_partkey
       GROUP BY p_type ORDER BY total_sales DESC, p_type LIMIT 1"""
)
def top_type_by_sales(t):
    return top_rows(sales_per_type(t), 1, F.desc("total_sales"), F.col("p_type"))


@query(
    f"""SELECT p_type, {REVENUE_SQL} AS total_sales
       FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_type ORDER BY total_sales DESC, p_type"""
)
def sales_by_category(t):
    return sales_per_type(t).orderBy(F.desc("total_sales"), "p_type")


@query(
    f"""SELECT concat(n_name, ',', r_name) AS store, concat(s_name, ' ', CAST(s_nationkey AS VARCHAR)) AS manager,
              {REVENUE_SQL} AS total_sales
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
       GROUP BY r_name, n_name, s_suppkey, s_name, s_nationkey"""
)
def sales_by_store(t):
    stores = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    summed = rollup_to(t.lineitem, "l_suppkey", {"total_sales": F.sum(revenue())}, stores, "s_suppkey")
    return summed.orderBy("r_name", "n_name").select(
        F.concat("n_name", F.lit(","), "r_name").alias("store"),
        full_name(F.col("s_name"), F.col("s_nationkey").cast("string")).alias("manager"),
        from_units(F.col("total_sales")).alias("total_sales"),
    )


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def orders_without_items(t):
    return without_match(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey", "o_totalprice")


@query(
    """SELECT s_name, film_count, rnk FROM (
         SELECT s_name, film_count, dense_rank() OVER (ORDER BY film_count DESC) AS rnk FROM (
           SELECT s_suppkey, s_name, CAST(count(*) AS BIGINT) AS film_count
           FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN part ON l_partkey = p_partkey
           WHERE p_type = 'ECONOMY' GROUP BY s_suppkey, s_name))
       WHERE rnk <= 3 ORDER BY film_count DESC, s_name"""
)
def top3_dense(t):
    economy = with_match(t.lineitem, t.part.filter("p_type = 'ECONOMY'"), "l_partkey", "p_partkey")
    counted = rollup_to(economy, "l_suppkey", {"film_count": F.count("*")}, t.supplier, "s_suppkey")
    ranked = top_dense(counted.select("s_suppkey", "s_name", "film_count"), "film_count", 3)
    return ranked.select("s_name", "film_count", "rnk").orderBy(F.desc("film_count"), "s_name")


@query(
    """WITH g AS (
         SELECT p_type, CASE WHEN o_orderpriority LIKE '1%' THEN 'Starts with 1'
                             WHEN o_orderpriority LIKE '%-%' THEN 'Contains hyphen' END AS priority_group,
                CAST(sum(p_size) AS DOUBLE) / 60.0 AS total_hours
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '%-%' GROUP BY ALL),
       r AS (SELECT *, dense_rank() OVER (PARTITION BY priority_group ORDER BY total_hours DESC) AS rnk FROM g)
       SELECT priority_group, p_type, round(total_hours, 6) AS total_hours FROM r
       WHERE rnk = 1 ORDER BY priority_group"""
)
def best_per_group(t):
    return top_dense(hours_per_priority_group(t), "total_hours", 1, ["priority_group"]).select(
        "priority_group", "p_type", F.round("total_hours", 6).alias("total_hours")
    ).orderBy("priority_group")


def hours_per_priority_group(t):
    priority = F.col("o_orderpriority")
    grouped = (
        t.orders.filter(priority.like("1%") | priority.like("%-%"))
        .withColumn(
            "priority_group",
            F.when(priority.like("1%"), "Starts with 1").when(priority.like("%-%"), "Contains hyphen"),
        )
        .join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("priority_group", "l_partkey").agg(F.count("*").alias("n"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )
    minutes = F.sum(F.col("n") * F.col("p_size")).cast("double")
    return grouped.groupBy("priority_group", "p_type").agg((minutes / F.lit(60.0)).alias("total_hours"))


@query(
    """SELECT p_type, CASE WHEN o_orderpriority LIKE '1%' THEN 'Starts with 1'
                           WHEN o_orderpriority LIKE '%-%' THEN 'Contains hyphen' END AS priority_group,
              round(CAST(sum(p_size) AS DOUBLE) / 60.0, 6) AS total_hours
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '%-%' GROUP BY 1, 2"""
)
def hours_by_group(t):
    return hours_per_priority_group(t).withColumn("total_hours", F.round("total_hours", 6))


def actual_hours(t, pattern):
    """Hours from order to shipping per part type, for orders of one priority pattern."""
    held = (
        t.lineitem.filter(F.col("l_shipdate").isNotNull())
        .join(t.orders.filter(F.col("o_orderpriority").like(pattern)), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("hours", hours_between(F.col("o_orderdate"), F.col("l_shipdate")))
    )
    per_part = rollup_to(held, "l_partkey", {"h": F.sum("hours")}, t.part, "p_partkey")
    summed = per_part.groupBy("p_type").agg(F.round(F.sum("h"), 2).alias("total_rental_hours"))
    return top_rows(summed, 1, F.desc("total_rental_hours"), F.col("p_type"))


ACTUAL_HOURS_SQL = """SELECT p_type, round(sum((epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0), 2) AS total_rental_hours
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate IS NOT NULL AND o_orderpriority LIKE '{}'
    GROUP BY p_type ORDER BY total_rental_hours DESC, p_type LIMIT 1"""


@query(ACTUAL_HOURS_SQL.format("1%"))
def actual_hours_a(t):
    return actual_hours(t, "1%")


@query(ACTUAL_HOURS_SQL.format("%-%"))
def actual_hours_b(t):
    return actual_hours(t, "%-%")


@query(
    """SELECT n_name, CAST(count(CASE WHEN c_acctbal >= 0 THEN 1 END) AS BIGINT) AS active_clients,
              CAST(count(CASE WHEN c_acctbal < 0 THEN 1 END) AS BIGINT) AS inactive_clients
       FROM nation JOIN customer ON n_nationkey = c_nationkey
       GROUP BY n_name ORDER BY inactive_clients DESC, n_name"""
)
def active_counts(t):
    measures = {
        "active_clients": F.count(F.when(F.col("c_acctbal") >= 0, 1)),
        "inactive_clients": F.count(F.when(F.col("c_acctbal") < 0, 1)),
    }
    return (
        rollup_to(t.customer, "c_nationkey", measures, t.nation, "n_nationkey")
        .groupBy("n_name").agg(*(F.sum(m).alias(m) for m in measures))
        .orderBy(F.desc("inactive_clients"), "n_name")
    )


@query(
    """SELECT n_name, CAST(sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END) AS BIGINT) AS active_customers,
              CAST(sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS inactive_customers
       FROM nation JOIN customer ON n_nationkey = c_nationkey
       GROUP BY n_name ORDER BY active_customers DESC, n_name LIMIT 20"""
)
def active_sums(t):
    measures = {
        "active_customers": F.sum(F.when(F.col("c_acctbal") >= 0, 1).otherwise(0)),
        "inactive_customers": F.sum(F.when(F.col("c_acctbal") < 0, 1).otherwise(0)),
    }
    summed = (
        rollup_to(t.customer, "c_nationkey", measures, t.nation, "n_nationkey")
        .groupBy("n_name").agg(*(F.sum(m).alias(m) for m in measures))
    )
    return top_rows(summed, 20, F.desc("active_customers"), F.col("n_name"))


@query(
    f"""SELECT r_name, n_name, {REVENUE_SQL} AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY r_name, n_name"""
)
def multiway_revenue(t):
    per_order = rollup_to(t.lineitem, "l_orderkey", {"s": F.sum(revenue())}, t.orders, "o_orderkey")
    per_customer = rollup_to(per_order, "o_custkey", {"s2": F.sum("s")}, t.customer, "c_custkey")
    per_nation = rollup_to(per_customer, "c_nationkey", {"s3": F.sum("s2")}, t.nation, "n_nationkey")
    placed = per_nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return placed.groupBy("r_name", "n_name").agg(from_units(F.sum("s3")).alias("revenue"))


@query(
    """SELECT o_orderkey, CAST(count(l_orderkey) AS BIGINT) AS item_count
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey ORDER BY o_orderkey"""
)
def group_count_left(t):
    return children_counted(t.orders, "o_orderkey", t.lineitem, "l_orderkey", "item_count").select(
        "o_orderkey", "item_count"
    ).orderBy("o_orderkey")


@query(
    """SELECT p_name, CAST(count(l_partkey) AS BIGINT) AS item_count
       FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_name"""
)
def count_by_name(t):
    counted = children_counted(t.part, "p_partkey", t.lineitem, "l_partkey", "n")
    return counted.groupBy("p_name").agg(F.sum("n").alias("item_count"))


# full years: one less while the anniversary of the year lies ahead (29 February: 1 March)
YEARS_SQL = f"""(date_part('year', DATE '{AS_OF}') - date_part('year', o_orderdate)
    - CASE WHEN strftime(o_orderdate, '%m-%d') > strftime(DATE '{AS_OF}', '%m-%d') THEN 1 ELSE 0 END)"""


def dorm(t):
    """Customers as rooms, their orders as students born on the order date."""
    people = t.orders.select(
        F.col("o_custkey").alias("room_id"), F.col("o_orderdate").alias("birthday"), F.col("o_orderstatus").alias("sex")
    )
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), people


def as_customers(df):
    return df.withColumnsRenamed({"id": "c_custkey", "name": "c_name"})


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query(
    f"""SELECT c_custkey, c_name, round(avg({YEARS_SQL}), 4) AS avg_age
        FROM customer JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey, c_name ORDER BY avg_age, c_custkey LIMIT 5"""
)
def min_avg_years(t):
    return as_customers(rooms.youngest_rooms(*dorm(t), as_of()))


@query(
    f"""SELECT c_custkey, c_name, CAST(max({YEARS_SQL}) - min({YEARS_SQL}) AS BIGINT) AS age_diff
        FROM customer JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey, c_name ORDER BY age_diff DESC, c_custkey LIMIT 5"""
)
def max_year_spread(t):
    return as_customers(rooms.widest_age_gaps(*dorm(t), as_of()))


@query(
    """SELECT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey
       GROUP BY c_custkey, c_name HAVING count(DISTINCT o_orderstatus) > 1 ORDER BY c_custkey"""
)
def mixed_status(t):
    return as_customers(rooms.mixed_rooms(*dorm(t)))


@query(
    """SELECT custkey, c_name, o_orderkey, o_orderstatus
       FROM (SELECT o_custkey AS custkey, o_orderkey, o_orderstatus FROM orders)
       JOIN (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)"""
)
def using_join(t):
    orders = t.orders.withColumnRenamed("o_custkey", "custkey")
    customers = t.customer.withColumnRenamed("c_custkey", "custkey")
    return orders.join(customers, "custkey").select("custkey", "c_name", "o_orderkey", "o_orderstatus")


@query(
    """WITH dim AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS line_id FROM part GROUP BY ALL)
       SELECT p_partkey, line_id FROM part JOIN dim USING (p_brand, p_type, p_size)"""
)
def composite_lookup(t):
    keys = ["p_brand", "p_type", "p_size"]
    dim = t.part.groupBy(*keys).agg(F.min("p_partkey").alias("line_id"))
    return t.part.join(dim, keys).select("p_partkey", "line_id")


@query(
    """SELECT concat(c_name, ', ', c_mktsegment) AS customer, n_name AS phone, p_name AS title
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
       WHERE l_linestatus = 'O' AND o_orderdate < TIMESTAMP '2001-01-01'
       ORDER BY title, customer, phone LIMIT 5"""
)
def late_rentals(t):
    late = (
        t.lineitem.filter("l_linestatus = 'O'")
        .join(t.orders.filter("o_orderdate < timestamp_ntz '2001-01-01'"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat("c_name", F.lit(", "), "c_mktsegment").alias("customer"),
            F.col("n_name").alias("phone"),
            F.col("p_name").alias("title"),
        )
    )
    return top_rows(late, 5, F.col("title"), F.col("customer"), F.col("phone"))


@query(
    """SELECT c_custkey AS id, c_name || ' ' || c_mktsegment AS name, c_nationkey AS "zip code", n_name AS city,
              r_name AS country, CASE WHEN c_acctbal > 0 THEN 'active' ELSE '' END AS notes
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def customer_list(t):
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return placed.select(
        F.col("c_custkey").alias("id"),
        full_name(F.col("c_name"), F.col("c_mktsegment")).alias("name"),
        F.col("c_nationkey").alias("zip code"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("").alias("notes"),
    )


@query(
    """SELECT s_suppkey AS id, s_name || ' ' || n_name AS name, n_name AS city, r_name AS country
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def staff_list(t):
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return placed.select(
        F.col("s_suppkey").alias("id"),
        full_name(F.col("s_name"), F.col("n_name")).alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
    )


@query(
    """WITH titles AS (
         SELECT l_suppkey, p_type, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS names
         FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_type)
       SELECT s_suppkey, s_name, string_agg(p_type || ': ' || names, ', ' ORDER BY p_type) AS film_info
       FROM supplier LEFT JOIN titles ON s_suppkey = l_suppkey GROUP BY s_suppkey, s_name"""
)
def actor_info(t):
    # titles are a small vocabulary; distinct pairs are formed before the text is built
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    titles = pairs.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "p_type", "p_name").distinct()
    per_type = titles.groupBy("l_suppkey", "p_type").agg(F.expr("listagg(p_name, ', ') WITHIN GROUP (ORDER BY p_name)").alias("names"))
    per_supplier = per_type.withColumn("line", F.concat("p_type", F.lit(": "), "names")).groupBy("l_suppkey").agg(
        F.expr("listagg(line, ', ') WITHIN GROUP (ORDER BY line)").alias("film_info")
    )
    return t.supplier.join(per_supplier, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        "s_suppkey", "s_name", "film_info"
    )


def film_nations(t):
    """Distinct (part, nation of a supplier that sold it)."""
    sold = t.lineitem.select("l_partkey", "l_suppkey").distinct().join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return sold.select("l_partkey", "s_nationkey").distinct().join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))


@query(
    """SELECT p_partkey AS fid, p_name AS title, p_type AS category, p_retailprice AS price, p_size AS length,
              string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS actors
       FROM part JOIN lineitem ON p_partkey = l_partkey JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"""
)
def film_list(t):
    listed = film_nations(t).groupBy("l_partkey").agg(
        F.expr("listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name)").alias("actors")
    )
    return t.part.join(listed, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("p_partkey").alias("fid"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("length"),
        "actors",
    )


@query(
    """WITH n AS (SELECT DISTINCT p_type,
              upper(substring(split_part(p_name, ' ', 1), 1, 1)) || lower(substring(split_part(p_name, ' ', 1), 2)) ||
              upper(substring(split_part(p_name, ' ', 2), 1, 1)) || lower(substring(split_part(p_name, ' ', 2), 2)) AS nicer
            FROM part)
       SELECT p_type, string_agg(nicer, ', ' ORDER BY nicer) AS names FROM n GROUP BY p_type"""
)
def nicer_names(t):
    words = F.split("p_name", " ")
    nicer = F.concat(proper(F.get(words, F.lit(0))), proper(F.get(words, F.lit(1))))
    return (
        t.part.select("p_type", nicer.alias("nicer")).distinct()
        .groupBy("p_type").agg(F.expr("listagg(nicer, ', ') WITHIN GROUP (ORDER BY nicer)").alias("names"))
    )


@query(
    """SELECT n_name, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments
       FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name"""
)
def string_agg(t):
    segments = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    known = t.nation.join(segments, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return known.groupBy("n_name").agg(
        F.expr("listagg(DISTINCT c_mktsegment, ', ') WITHIN GROUP (ORDER BY c_mktsegment)").alias("segments")
    )


COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS cnt FROM {n}" for n in COUNTED))
def table_counts(t):
    return row_counts({name: getattr(t, name) for name in COUNTED})


@query(
    """SELECT n_name, CAST(count(o_orderkey) AS BIGINT) AS total_flights
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       GROUP BY n_name ORDER BY total_flights DESC, n_name LIMIT 10"""
)
def flights_report(t):
    per_customer = rollup_to(t.orders, "o_custkey", {"n": F.count("*")}, t.customer, "c_custkey")
    per_nation = rollup_to(per_customer, "c_nationkey", {"n2": F.sum("n")}, t.nation, "n_nationkey")
    counted = per_nation.groupBy("n_name").agg(F.sum("n2").alias("total_flights"))
    return top_rows(counted, 10, F.desc("total_flights"), F.col("n_name"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                      ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn FROM lineitem)
       WHERE rn = 1""",
    name="first_per_key",
)
def first_per_key_lines(t):
    first = first_per_key(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"),
        ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"],
    )
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
