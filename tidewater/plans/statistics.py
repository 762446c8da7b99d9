"""Census-style and vector statistics over orders, customers, parts and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.text import percent_text
from tidewater.operators import statistics as st
from tidewater.registry import query


@query(
    """SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer
       WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment"""
)
def value_counts(t):
    return st.value_counts(t.customer, "c_mktsegment")


@query(
    """SELECT round(avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 6) AS open_mean,
              round(stddev_samp(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 6) AS open_std,
              round(avg(CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END), 6) AS other_mean,
              round(stddev_samp(CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END), 6) AS other_std
       FROM orders"""
)
def mean_std_split(t):
    price = F.col("o_totalprice")
    opened = F.when(F.col("o_orderstatus") == "O", price)
    other = F.when(F.col("o_orderstatus") != "O", price)
    return t.orders.agg(
        F.round(F.avg(opened), 6).alias("open_mean"),
        F.round(F.stddev_samp(opened), 6).alias("open_std"),
        F.round(F.avg(other), 6).alias("other_mean"),
        F.round(F.stddev_samp(other), 6).alias("other_std"),
    )


@query(
    """SELECT round(avg(o_totalprice), 6) AS mean_price FROM orders WHERE o_orderpriority = '1-URGENT'"""
)
def filtered_mean(t):
    return t.orders.filter("o_orderpriority = '1-URGENT'").agg(F.round(F.avg("o_totalprice"), 6).alias("mean_price"))


@query("SELECT round(stddev_pop(value), 6) AS std_value FROM events")
def std_pop(t):
    return t.events.agg(F.round(F.stddev_pop("value"), 6).alias("std_value"))


@query("SELECT round(avg(value), 6) AS mean_value, round(avg(value) - 60, 6) AS difference FROM events")
def mean_vs_ref(t):
    mean = F.avg("value")
    return t.events.agg(F.round(mean, 6).alias("mean_value"), F.round(mean - F.lit(60), 6).alias("difference"))


@query("SELECT event_type, round(median(value), 6) AS median_value FROM events GROUP BY event_type")
def median_by_group(t):
    return st.percentiles(t.events, "value", [0.5], ["event_type"]).select(
        "event_type", F.round("p0", 6).alias("median_value")
    )


@query("SELECT round(median(o_totalprice), 6) AS median_price FROM orders")
def median_overall(t):
    return st.percentiles(t.orders, "o_totalprice", [0.5]).select(F.round("p0", 6).alias("median_price"))


@query(
    """SELECT CAST(min(p) AS BIGINT) AS first_pct FROM (
         SELECT unnest(range(1, 101)) AS p,
                unnest(quantile_cont(value, [x / 100.0 FOR x IN range(1, 101)])) AS v FROM events)
       WHERE v > 60"""
)
def first_pct_above(t):
    return st.first_percentile_above(t.events, "value", 60).select(F.col("first_pct").cast("bigint"))


@query("SELECT round(avg(CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct FROM events")
def pct_above(t):
    return t.events.agg(F.round(F.avg((F.col("value") > 60).cast("double")) * 100, 6).alias("pct"))


@query("SELECT value FROM events ORDER BY value")
def sorted_values(t):
    # the id spreads equal values over the range partitions
    return t.events.orderBy("value", "event_id").select("value")


@query(
    """SELECT round(count(*) FILTER (o_orderstatus = 'O') * 100.0 / count(*), 6) AS share,
              printf('%.2f%%', count(*) FILTER (o_orderstatus = 'O') * 100.0 / count(*)) AS share_text
       FROM orders"""
)
def share_value(t):
    share = F.count_if(F.col("o_orderstatus") == "O") / F.count("*") * 100
    return t.orders.agg(F.round(share, 6).alias("share"), percent_text(share).alias("share_text"))


@query(
    """SELECT priority, CAST(count(*) AS BIGINT) AS n
       FROM (SELECT nullif(o_orderpriority, '5-LOW') AS priority FROM orders WHERE o_orderstatus = 'O')
       WHERE NOT coalesce(priority IN ('1-URGENT', '2-HIGH'), false) GROUP BY priority"""
)
def not_in_list(t):
    opened = t.orders.filter("o_orderstatus = 'O'").select(F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"))
    kept = opened.filter(st.not_in_values("priority", ["1-URGENT", "2-HIGH"]))
    return kept.groupBy("priority").agg(F.count("*").alias("n"))


@query(
    """SELECT o_orderpriority, o_orderstatus, CAST(count(o_totalprice) AS BIGINT) AS count,
              round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
              min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS q25,
              round(quantile_cont(o_totalprice, 0.5), 6) AS q50, round(quantile_cont(o_totalprice, 0.75), 6) AS q75,
              max(o_totalprice) AS max
       FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL
       GROUP BY o_orderpriority, o_orderstatus"""
)
def describe_group(t):
    described = st.describe(t.orders, "o_totalprice", ["o_orderpriority", "o_orderstatus"])
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    """WITH g AS (SELECT CASE WHEN starts_with(o_orderpriority, '1') THEN 'urgent' ELSE 'normal' END AS status,
                         o_orderstatus FROM orders),
            w AS (SELECT unnest(['O', 'F', 'X']) AS o_orderstatus)
       SELECT s.status, w.o_orderstatus,
              round((SELECT count(*) FROM g WHERE g.status = s.status AND g.o_orderstatus = w.o_orderstatus)
                    / s.n, 6) AS share
       FROM (SELECT status, count(o_orderstatus) AS n FROM g GROUP BY status) s, w"""
)
def share_in_group(t):
    labelled = t.orders.withColumn(
        "status", F.when(F.col("o_orderpriority").startswith("1"), "urgent").otherwise("normal")
    )
    shares = st.share_in_group(labelled, "status", "o_orderstatus", ["O", "F", "X"])
    return shares.withColumn("share", F.round("share", 6))


@query(
    """SELECT status, o_orderstatus, round(n / sum(n) OVER (PARTITION BY status), 6) AS share
       FROM (SELECT CASE WHEN starts_with(o_orderpriority, '1') THEN 'urgent' ELSE 'normal' END AS status,
                    o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)"""
)
def share_of_values(t):
    status = F.when(F.col("o_orderpriority").startswith("1"), "urgent").otherwise("normal")
    counts = t.orders.groupBy(status.alias("status"), "o_orderstatus").agg(F.count("*").alias("n"))
    totals = counts.groupBy("status").agg(F.sum("n").alias("total"))
    return counts.join(totals, "status").select(
        "status", "o_orderstatus", F.round(F.col("n") / F.col("total"), 6).alias("share")
    )


@query(
    """SELECT max(l_quantity) AS max_value, CAST(count(*) AS BIGINT) AS n_at_max,
              round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS share_at_max
       FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)"""
)
def at_max(t):
    top = st.at_maximum(t.lineitem, "l_quantity", F.col("l_returnflag") == "R")
    return top.withColumn("share_at_max", F.round("share_at_max", 6))


@query(
    """SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 6) AS mean_price FROM orders
       WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL"""
)
def mean_two_keys(t):
    keyed = t.orders.filter("o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL")
    return keyed.groupBy("o_orderpriority", "o_orderstatus").agg(F.round(F.avg("o_totalprice"), 6).alias("mean_price"))


EDGES, LABELS = (16, 35, 70, 100), ("young", "adult", "retiree")
BIN_SQL = """CASE WHEN l_quantity > 16 AND l_quantity <= 35 THEN 'young' WHEN l_quantity > 35 AND l_quantity <= 70
    THEN 'adult' WHEN l_quantity > 70 AND l_quantity <= 100 THEN 'retiree' END"""


@query(
    f"""SELECT label, CAST(count(b) AS BIGINT) AS n
        FROM (SELECT unnest(['young', 'adult', 'retiree']) AS label)
        LEFT JOIN (SELECT {BIN_SQL} AS b FROM lineitem WHERE l_returnflag = 'R') ON b = label GROUP BY label"""
)
def age_bins(t):
    return st.bin_counts(t.lineitem.filter("l_returnflag = 'R'"), "l_quantity", EDGES, LABELS).select("label", "n")


@query(
    f"""SELECT {BIN_SQL} AS label, CAST(count(*) AS BIGINT) AS n FROM lineitem
        WHERE l_returnflag = 'R' AND {BIN_SQL} IS NOT NULL GROUP BY 1 ORDER BY n DESC, label LIMIT 1"""
)
def best_bin(t):
    return st.best_bin(t.lineitem.filter("l_returnflag = 'R'"), "l_quantity", EDGES, LABELS).select("label", "n")


def brand_rule():
    return (F.avg("p_size") <= 25) & (F.min("p_retailprice") > 900.1)


@query(
    """SELECT p_brand FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
       HAVING avg(p_size) <= 25 AND min(p_retailprice) > 900.1"""
)
def group_filter_keys(t):
    return st.groups_where(t.part, ["p_brand"], brand_rule())


@query(
    """SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN (
         SELECT p_brand FROM part GROUP BY p_brand HAVING avg(p_size) <= 25 AND min(p_retailprice) > 900.1)"""
)
def group_filter_rows(t):
    return st.rows_of_groups_where(t.part, ["p_brand"], brand_rule()).select("p_partkey", "p_brand", "p_size")
