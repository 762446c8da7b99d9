"""Warehouse loads. The first load is what lies before a date, the second what lies after it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.dates import month_label, try_us_date, us_date
from tidewater.functions.text import full_name
from tidewater.functions.values import from_units, units
from tidewater.operators import versions as vs
from tidewater.operators import warehouse as wh
from tidewater.operators.joins import not_in
from tidewater.operators.ranking import first_per_key
from tidewater.registry import query
from tidewater.sinks.buckets import BucketedTable
from tidewater.sources.layouts import layout

BOUNDARY = "1998-06-01"
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


# Segments and priorities as labels, so that a batch holds rows equal to the member's
NEW_LABEL = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'BUILDING' END"


def before(column, date=BOUNDARY):
    return F.col(column) < F.lit(date).cast("timestamp_ntz")


def since(column, date=BOUNDARY):
    return F.col(column) >= F.lit(date).cast("timestamp_ntz")


def line_load(t):
    """The batch delivers the first line of each order twice."""
    lines = t.lineitem.select(*LINE_KEY, *LINE_ORDER)
    batch = lines.filter(since("l_shipdate"))
    batch = batch.unionByName(batch.filter("l_linenumber = 1"))
    return wh.insert_ignore(lines.filter(before("l_shipdate")), batch, LINE_KEY, LINE_ORDER)


LINE_SQL = f"""(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                          ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn,
                      EXISTS (SELECT 1 FROM lineitem k WHERE k.l_orderkey = b.l_orderkey
                              AND k.l_linenumber = b.l_linenumber AND k.l_shipdate < TIMESTAMP '{BOUNDARY}') AS known
               FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1) b
               WHERE l_shipdate >= TIMESTAMP '{BOUNDARY}')"""


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {LINE_SQL} WHERE rn = 1 AND NOT known")
def insert_ignore(t):
    return line_load(t).inserted.select(*LINE_KEY, "l_partkey", "l_suppkey")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {LINE_SQL} WHERE rn > 1 OR known")
def insert_ignore_rejected(t):
    return line_load(t).rejected.select(*LINE_KEY, "l_partkey", "l_suppkey")


PART_KEY = ["brand", "p_type", "p_size", "p_name"]


@query(
    """WITH p AS (SELECT p_partkey, nullif(p_brand, 'Brand#1') AS brand, p_type, p_size, p_name, p_retailprice FROM part)
       SELECT p_partkey FROM (
         SELECT *, row_number() OVER (PARTITION BY brand, p_type, p_size, p_name ORDER BY p_partkey) AS rn
         FROM p WHERE p_retailprice >= 920) b
       WHERE brand IS NULL OR (rn = 1 AND NOT EXISTS (
         SELECT 1 FROM p t WHERE t.p_retailprice < 920 AND t.brand = b.brand AND t.p_type = b.p_type
                AND t.p_size = b.p_size AND t.p_name = b.p_name))"""
)
def insert_ignore_multi(t):
    parts = t.part.withColumn("brand", F.expr("nullif(p_brand, 'Brand#1')"))
    fresh = wh.insert_ignore_unique(
        parts.filter("p_retailprice < 920"), parts.filter("p_retailprice >= 920"), PART_KEY, ["p_partkey"]
    )
    return fresh.select("p_partkey")


def customer_dim(t):
    """Customers with a surrogate key; the bucket is an expression any SQL can repeat."""
    return wh.surrogate_keys(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"), ["c_custkey"], "customer_sk", 1000,
        F.pmod(F.col("c_custkey"), F.lit(64)),
    )


CUSTOMER_SK_SQL = """(SELECT c_custkey, c_name, c_mktsegment,
    CAST(1000 + row_number() OVER (ORDER BY c_custkey % 64, c_custkey) AS BIGINT) AS customer_sk FROM customer)"""


@query(f"SELECT c_custkey, customer_sk FROM {CUSTOMER_SK_SQL}")
def surrogate_keys(t):
    return customer_dim(t).select("c_custkey", "customer_sk")


def order_load(t):
    """The batch delivers every tenth order twice."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", F.expr("nullif(o_custkey, 7)").alias("parent"))
    batch = rows.filter(since("o_orderdate"))
    batch = batch.unionByName(batch.filter("o_orderkey % 10 = 0"))
    return wh.fk_load(
        rows.filter(before("o_orderdate")), batch, ["o_orderkey"],
        t.customer.filter("c_acctbal >= 0"), "parent", "c_custkey", ["o_orderdate", "o_custkey"],
    )


ORDER_LOAD_SQL = f"""(SELECT o_orderkey, o_custkey, (o_custkey = 7 OR o_custkey IN (
    SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS valid, again FROM (
        SELECT *, 0 AS again FROM orders UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 10 = 0)
    WHERE o_orderdate >= TIMESTAMP '{BOUNDARY}')"""


@query(f"SELECT o_orderkey, o_custkey FROM {ORDER_LOAD_SQL} WHERE valid AND again = 0")
def fk_load(t):
    return order_load(t).inserted.select("o_orderkey", "o_custkey")


@query(f"SELECT o_orderkey, o_custkey FROM {ORDER_LOAD_SQL} WHERE NOT valid OR again = 1")
def fk_load_rejected(t):
    return order_load(t).rejected.select("o_orderkey", "o_custkey")


@query(
    """SELECT DISTINCT l_partkey AS product_id, 'Unknown Product' AS name, 0.0::DOUBLE AS price FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')"""
)
def placeholder_dim(t):
    dim = t.part.filter("p_type <> 'PROMO'").select(F.col("p_partkey").alias("product_id"))
    facts = t.lineitem.select(F.col("l_partkey").alias("product_id"))
    return wh.placeholder_members(dim, facts, "product_id", {"name": "Unknown Product", "price": 0.0})


def staged_sales(t):
    """All-text staging rows, as a delimited file would deliver them."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    parts = t.part.select("p_partkey", "p_brand", "p_type", "p_size")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("order_date"),
        F.col("o_custkey").alias("c_custkey"),
        "p_brand",
        "p_type",
        F.col("p_size").cast("string").alias("p_size"),
        F.col("l_extendedprice").cast("string").alias("sales"),
        F.col("l_quantity").cast("decimal(10,0)").cast("string").alias("quantity"),
        (F.col("l_tax") + 0.0).cast("string").alias("tax"),
    )


def line_dim(t):
    return t.part.groupBy("p_brand", "p_type", F.col("p_size").cast("string").alias("p_size")).agg(
        F.min("p_partkey").alias("line_id")
    )


def sales_facts(t, segment=False):
    columns = {
        "row_id": F.col("row_id"),
        "order_date": us_date(F.col("order_date")),
        "customer_sk": F.col("customer_sk"),
        "line_id": F.col("line_id"),
        "sales": F.col("sales").cast("decimal(10,4)").cast("double"),
        "quantity": F.col("quantity").cast("int"),
        "tax": F.col("tax").cast("decimal(4,2)").cast("double"),
    }
    if segment:
        columns["segment"] = F.col("c_mktsegment")
    lookups = [
        (customer_dim(t).filter("c_mktsegment <> 'BUILDING'").drop("c_name"), ["c_custkey"]),
        (line_dim(t), ["p_brand", "p_type", "p_size"]),
    ]
    return wh.lookup_facts(staged_sales(t), lookups, columns)


FACTS_SQL = f"""(SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
        CAST(o_orderdate AS DATE) AS order_date, customer_sk, line_id, round(l_extendedprice, 4) AS sales,
        CAST(l_quantity AS INTEGER) AS quantity, round(l_tax, 2) AS tax
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN {CUSTOMER_SK_SQL} c ON o_custkey = c_custkey AND c_mktsegment <> 'BUILDING'
    JOIN (SELECT p_brand AS b, p_type AS y, p_size AS z, min(p_partkey) AS line_id FROM part GROUP BY ALL)
         ON b = p_brand AND y = p_type AND z = p_size)"""


@query(f"SELECT * FROM {FACTS_SQL}")
def fact_load(t):
    return sales_facts(t)


@query(
    f"""SELECT year(order_date) AS year, c_mktsegment AS segment, round(sum(sales), 2) AS sales,
               CAST(sum(quantity) AS BIGINT) AS quantity
        FROM {FACTS_SQL} f JOIN {CUSTOMER_SK_SQL} c USING (customer_sk) GROUP BY ALL"""
)
def mart_sales(t):
    facts = sales_facts(t, segment=True)
    summed = facts.groupBy(F.year("order_date").cast("bigint").alias("year"), "segment").agg(
        F.sum(units(F.col("sales"))).alias("s"), F.sum("quantity").alias("quantity")
    )
    return summed.select("year", "segment", F.round(from_units(F.col("s")), 2).alias("sales"), "quantity")


SEGMENTS_SQL = (
    f"""WITH b AS (SELECT c_custkey, label FROM (
          SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
          FROM (SELECT o_custkey, o_orderdate, o_orderkey, {{label}} AS label FROM orders WHERE o_orderdate >= TIMESTAMP '{BOUNDARY}')
          JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0 AND label <> c_mktsegment) WHERE rn = 1)
        SELECT c_custkey, c_acctbal >= 0 AS is_current, coalesce(label, c_mktsegment) AS label
        FROM customer LEFT JOIN b USING (c_custkey)""".replace("{label}", NEW_LABEL)
)


def segment_load(t):
    """Some rows of the batch repeat the member's segment, others bring a new one."""
    dim = t.customer.select("c_custkey", (F.col("c_acctbal") >= 0).alias("is_current"), F.col("c_mktsegment").alias("label"))
    batch = t.orders.filter(since("o_orderdate")).select(
        F.col("o_custkey").alias("c_custkey"), F.expr(NEW_LABEL).alias("label"), "o_orderdate", "o_orderkey"
    )
    return dim, batch, ["-o_orderdate", "o_orderkey"]


@query(SEGMENTS_SQL)
def scd1_update(t):
    dim, batch, order = segment_load(t)
    return wh.overwrite_attribute(dim, batch, "c_custkey", "label", order, F.col("is_current"))


@query(SEGMENTS_SQL)
def stored_scd1(t):
    """``scd1_update`` on a stored dimension: members the batch does not name stay where they are."""
    dim, batch, order = segment_load(t)
    change = lambda s: s.overwrite_attribute(batch, "label", order, current=F.col("is_current"))
    return stored(t, "segments", ["c_custkey"], dim, change).read()


@query(
    """SELECT DISTINCT o_custkey, o_orderstatus FROM orders b WHERE o_orderdate >= TIMESTAMP '1996-06-01'
       AND NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderdate < TIMESTAMP '1996-06-01' AND d.o_custkey = b.o_custkey)"""
)
def new_members(t):
    members = t.orders.select("o_custkey", "o_orderstatus", "o_orderdate")
    dim = members.filter(before("o_orderdate", "1996-06-01")).select("o_custkey").distinct()
    batch = members.filter(since("o_orderdate", "1996-06-01")).select("o_custkey", "o_orderstatus")
    return wh.new_members(dim, batch, "o_custkey")


@query(f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '{BOUNDARY}'")
def fact_append(t):
    # the second load repeats the last year of the first
    facts = t.orders.filter(before("o_orderdate")).select("o_orderkey", "o_orderdate")
    batch = t.orders.filter(since("o_orderdate", "1997-06-01")).select("o_orderkey", "o_orderdate")
    return wh.append_new_facts(facts, batch, "o_orderkey")


def last_priority(t, rows):
    return first_per_key(rows, ["o_custkey"], ["-o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderpriority", "o_orderdate")


def history_load(t):
    """A dimension of priorities, and the orders that come later."""
    first = last_priority(t, t.orders.filter(before("o_orderdate")))
    dim = first.select(
        "o_custkey",
        "o_orderpriority",
        F.col("o_orderdate").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    return dim, t.orders.filter(since("o_orderdate"))


def priority_history(t):
    dim, batch = history_load(t)
    loaded = F.lit("2002-01-01").cast("timestamp_ntz")
    return wh.versioned_dimension(dim, batch, "o_custkey", ["o_orderpriority"], loaded, ["-o_orderdate", "o_orderkey"])


HISTORY_SQL = f"""WITH l AS (SELECT o_custkey, o_orderpriority AS p, o_orderdate AS d, o_orderdate < TIMESTAMP '{BOUNDARY}' AS old,
        row_number() OVER (PARTITION BY o_custkey, o_orderdate < TIMESTAMP '{BOUNDARY}' ORDER BY o_orderdate DESC, o_orderkey) AS rn
        FROM orders),
    a AS (SELECT o_custkey, p, d FROM l WHERE old AND rn = 1), b AS (SELECT o_custkey, p FROM l WHERE NOT old AND rn = 1),
    h AS (SELECT a.o_custkey, a.p AS o_orderpriority, a.d AS valid_from,
            CASE WHEN b.p <> a.p THEN TIMESTAMP '2002-01-01' END AS valid_to, NOT coalesce(b.p <> a.p, false) AS is_current
          FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey
          UNION ALL SELECT b.o_custkey, b.p, TIMESTAMP '2002-01-01', NULL, true
          FROM b LEFT JOIN a ON a.o_custkey = b.o_custkey WHERE a.p IS NULL OR a.p <> b.p)
    SELECT * FROM h"""


@query(HISTORY_SQL)
def scd2(t):
    return priority_history(t)


def stored(t, name, keys, first, *changes):
    """A table in 64 key buckets, made and changed once; queries read it."""

    def build(path):
        table = BucketedTable(t.spark, path, keys, 64)
        table.create(first)
        for change in changes:
            change(table)

    return BucketedTable(t.spark, layout(t, name, build), keys, 64)


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '{BOUNDARY}'
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {LINE_SQL} WHERE rn = 1 AND NOT known"""
)
def stored_insert(t):
    """The lines of a stored table after a load that ignores keys it has."""
    later = t.lineitem.filter(since("l_shipdate"))
    batch = later.unionByName(later.filter("l_linenumber = 1"))
    first = t.lineitem.filter(before("l_shipdate"))
    table = stored(t, "lines", LINE_KEY, first, lambda s: s.insert_ignore(batch, LINE_ORDER))
    return table.read().select(*LINE_KEY, "l_partkey", "l_suppkey")


@query(HISTORY_SQL)
def stored_scd2(t):
    """The history of ``scd2``, kept in a stored table of which only the buckets of the batch are written."""
    dim, batch = history_load(t)
    loaded = F.lit("2002-01-01").cast("timestamp_ntz")
    change = lambda s: s.new_versions(batch, ["o_orderpriority"], loaded, ["-o_orderdate", "o_orderkey"])
    return stored(t, "priorities", ["o_custkey"], dim, change).read()


@query(HISTORY_SQL + " WHERE is_current")
def dim_current(t):
    return priority_history(t).filter("is_current")


def change_feed(t):
    """Event rows as a change feed: errors are deletions, all else insertions."""
    return t.events.withColumn("_action", F.when(F.col("event_type") == "error", "DELETE").otherwise("INSERT"))


def inserts(t):
    return change_feed(t).filter("_action = 'INSERT'")


@query("SELECT event_id, user_id FROM events WHERE event_type <> 'error'")
def cdc_inserts(t):
    return inserts(t).select("event_id", "user_id")


@query(
    """SELECT DISTINCT user_id, CAST(user_id AS VARCHAR) || ' ' || event_type AS full_name FROM events
       WHERE event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE value > 200)"""
)
def cdc_dims(t):
    fresh = inserts(t).select("user_id", full_name(F.col("user_id").cast("string"), F.col("event_type")).alias("full_name"))
    return not_in(fresh.distinct(), t.events.filter("value > 200"), "user_id", "user_id")


@query(
    """SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS departure_date,
              TIMESTAMP '2024-02-01' AS load_timestamp FROM events WHERE event_type <> 'error'"""
)
def cdc_facts(t):
    raw = F.when(F.col("event_type") == "view", "unknown").otherwise(F.date_format("ts", "MM/dd/yyyy"))
    return inserts(t).select(
        "event_id",
        "user_id",
        try_us_date(raw).alias("departure_date"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("load_timestamp"),
    )


@query(
    """SELECT 'PROCESS_FLIGHTS' AS procedure_name, CAST(count(*) AS BIGINT) AS affected_rows,
              'INSERT_FACTS' AS operation_type, CAST(ts AS DATE) AS logged_at
       FROM events WHERE event_type <> 'error' GROUP BY CAST(ts AS DATE) ORDER BY logged_at DESC LIMIT 5"""
)
def audit_tail(t):
    daily = inserts(t).groupBy(F.col("ts").cast("date").alias("logged_at")).agg(F.count("*").alias("affected_rows"))
    log = daily.select(
        F.lit("PROCESS_FLIGHTS").alias("procedure_name"),
        "affected_rows",
        F.lit("INSERT_FACTS").alias("operation_type"),
        "logged_at",
    )
    return log.orderBy(F.desc("logged_at")).limit(5)


@query(
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-04-01' GROUP BY 1"""
)
def partition_prune(t):
    """A quarter of the orders, stored by month: which months it has is known to a small table only, so the
    folders to open are chosen while the query runs."""

    def build(path):
        month = month_label(F.col("o_orderdate"))
        by_month = t.orders.select("o_orderkey", "o_totalprice", month.alias("month"))
        wh.publish(by_month, path, "orders", ["month"])
        months = t.orders.select(month.alias("month"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
        wh.publish(months.distinct().coalesce(1), path, "months")

    path = layout(t, "orders-by-month", build)
    orders = t.spark.read.schema("o_orderkey bigint, o_totalprice double, month string").parquet(f"{path}/version=orders")
    months = t.spark.read.schema("month string, year int, quarter int").parquet(f"{path}/version=months")
    quarter = orders.join(months.filter("year = 1998 and quarter = 1"), "month")
    return quarter.groupBy("month").agg(F.count("*").alias("n"), from_units(F.sum(units(F.col("o_totalprice"), 2)), 2).alias("total"))


@query(
    """SELECT 'duplicate lines' AS check_name, CAST(count(*) AS BIGINT) AS violations FROM (
         SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL SELECT 'duplicate orders', CAST(count(*) AS BIGINT) FROM (
         SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
       UNION ALL SELECT 'orders without customer', CAST(count(*) AS BIGINT) FROM orders
         WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
       UNION ALL SELECT 'lines without key', CAST(count(*) AS BIGINT) FROM lineitem
         WHERE l_orderkey IS NULL OR l_linenumber IS NULL"""
)
def integrity(t):
    return wh.integrity_report(
        [
            ("duplicate lines", wh.duplicate_keys(t.lineitem, LINE_KEY)),
            ("duplicate orders", wh.duplicate_keys(t.orders, ["o_orderkey"])),
            ("orders without customer", wh.orphans(t.orders, "o_custkey", t.customer.filter("c_acctbal >= 0"), "c_custkey")),
            ("lines without key", wh.null_keys(t.lineitem, LINE_KEY)),
        ]
    )


def order_history(t):
    return t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.col("o_orderdate").alias("_version_ts"),
        F.when(F.col("o_orderstatus") == "F", "D").otherwise("U").alias("_op"),
    )


AT = "1998-06-15"
AS_OF_SQL = f"""SELECT o_custkey, o_orderkey FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate <= TIMESTAMP '{AT}') WHERE rn = 1 AND o_orderstatus <> 'F'"""


@query(AS_OF_SQL)
def as_of(t):
    at = F.lit(AT).cast("timestamp_ntz")
    return vs.as_of(order_history(t), ["o_custkey"], at, ["-o_orderkey"]).select("o_custkey", "o_orderkey")


@query(AS_OF_SQL)
def clone_as_of(t):
    """The clone is written once, as a table of its own, and read from there."""
    at = F.lit(AT).cast("timestamp_ntz")
    path = layout(t, "clone", lambda path: vs.clone_as_of(order_history(t), ["o_custkey"], at, path, ["-o_orderkey"]))
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'P') = 'O', false)")
def delete_where(t):
    return vs.delete_where(t.orders, F.expr("nullif(o_orderstatus, 'P') = 'O'")).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'O' OR o_orderdate >= TIMESTAMP '2000-01-01'")
def restore(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    current = vs.delete_where(rows, F.col("o_orderstatus") == "O")
    restored = vs.restore(current, rows, since("o_orderdate", "2000-01-01"), ["o_orderkey"])
    return restored.select("o_orderkey", "o_orderstatus")
