"""Vector, matrix and sequence operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.text import tokens
from tidewater.functions.values import differences
from tidewater.operators import joins as jn
from tidewater.operators import sequences as sq
from tidewater.operators.validation import not_all_equal
from tidewater.registry import query

CELLS = ("l_linenumber", "l_quantity", "l_suppkey")
SETS = ((1, 2, 3), (10, 11, 12, 13))


def line_cells(t):
    cells = F.array(*(F.col(c).cast("bigint") for c in CELLS))
    return t.lineitem.select("l_orderkey", "l_partkey", cells.alias("cells"))


CELLS_SQL = "[CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT), l_suppkey]"


@query(
    f"""SELECT l_orderkey, l_partkey, CAST(list_sum(cells) AS BIGINT) AS total
        FROM (SELECT l_orderkey, l_partkey, {CELLS_SQL} AS cells FROM lineitem)
        WHERE list_has_any(cells, [1, 2, 3]) AND list_has_any(cells, [10, 11, 12, 13])"""
)
def rows_covering(t):
    covering = jn.rows_covering(line_cells(t), "cells", SETS)
    total = F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return covering.select("l_orderkey", "l_partkey", total.alias("total"))


@query(
    """SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey
       GROUP BY l_suppkey HAVING count(DISTINCT p_brand) = (SELECT count(DISTINCT p_brand) FROM part)"""
)
def keys_covering(t):
    # suppliers that sold a part of every brand
    return jn.keys_covering(t.lineitem, "l_suppkey", "l_partkey", t.part, "p_brand", "p_partkey")


@query(
    f"""SELECT l_orderkey, l_partkey FROM (SELECT l_orderkey, l_partkey, {CELLS_SQL} AS cells FROM lineitem)
        WHERE len(list_distinct(cells)) > 1"""
)
def rows_not_all_equal(t):
    return line_cells(t).filter(not_all_equal(F.col("cells"))).select("l_orderkey", "l_partkey")


@query(
    """SELECT p_partkey, CAST(size_no AS BIGINT) AS size_no, pick AS label FROM (
         SELECT p_partkey, p_size AS a, p_size + 1 AS b, split_part(p_name, ' ', 1) AS x, split_part(p_name, ' ', 2) AS y
         FROM part), LATERAL (SELECT unnest([a, b]) AS size_no), LATERAL (SELECT unnest([x, y]) AS pick)"""
)
def cartesian(t):
    sizes = F.array(F.col("p_size").cast("string"), (F.col("p_size") + 1).cast("string"))
    vectors = t.part.select("p_partkey", F.array(sizes, F.split("p_name", " ")).alias("vectors"))
    product = jn.direct_product(vectors, "vectors")
    return product.select(
        "p_partkey",
        F.element_at("combination", 1).cast("bigint").alias("size_no"),
        F.element_at("combination", 2).alias("label"),
    )


@query(
    """WITH c AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m
                  FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i),
            e AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v
                  FROM embeddings, (SELECT unnest(range(1, 65)) AS i))
       SELECT vec_id, c.label, round(sqrt(sum((v - m) * (v - m))), 4) AS distance
       FROM e JOIN c USING (i) GROUP BY vec_id, c.label"""
)
def pairwise_l2(t):
    # distances of all vectors to the mean vector of each label
    cells = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "v"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
    centres = means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centre")
    )
    distances = jn.distance_matrix(t.embeddings.select("vec_id", "embedding"), "vec_id", "embedding", centres, "label", "centre")
    return distances.withColumn("distance", F.round("distance", 4))


@query("SELECT vec_id, round(CAST(embedding[2] AS DOUBLE) - CAST(embedding[1] AS DOUBLE), 6) AS first_diff, CAST(len(embedding) - 1 AS INTEGER) AS n FROM embeddings")
def array_diff(t):
    diff = differences(F.col("embedding").cast("array<double>"))
    return t.embeddings.select(
        "vec_id", F.round(F.element_at(diff, 1), 6).alias("first_diff"), F.size(diff).alias("n")
    )


@query(
    """SELECT vec_id, round(CAST(list_sort(embedding)[1] AS DOUBLE), 6) AS smallest,
              list_contains(embedding, embedding[3]) AS has_third FROM embeddings"""
)
def array_members(t):
    return t.embeddings.select(
        "vec_id",
        F.round(F.element_at(F.array_sort("embedding"), 1).cast("double"), 6).alias("smallest"),
        F.array_contains("embedding", F.element_at("embedding", 3)).alias("has_third"),
    )


@query(
    """SELECT word, CAST(count(*) AS BIGINT) AS n FROM (
         SELECT unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents)
       WHERE word <> '' GROUP BY word"""
)
def explode_tokens(t):
    words = t.documents.select(F.explode(tokens(F.col("text"))).alias("word"))
    return words.filter("word != ''").groupBy("word").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT l_linenumber, l_returnflag, l_linestatus FROM lineitem ORDER BY ALL")
def distinct_rows(t):
    names = ["l_linenumber", "l_returnflag", "l_linestatus"]
    return t.lineitem.select(*names).distinct().orderBy(*names)


@query(
    """SELECT round(ln(product(v)), 6) AS diag_product_ln FROM (
         SELECT l_linenumber AS i, CAST(l_quantity AS INTEGER) AS j, count(*) AS v FROM lineitem GROUP BY 1, 2)
       WHERE i = j AND v <> 0"""
)
def diag_product(t):
    # matrix of row counts: line number by quantity
    cells = t.lineitem.groupBy(F.col("l_linenumber").alias("i"), F.col("l_quantity").cast("int").alias("j")).agg(
        F.count("*").alias("v")
    )
    product = sq.diagonal_product(cells, "i", "j", "v")
    return product.select(F.round(F.log("diag_product"), 6).alias("diag_product_ln"))


@query(
    """SELECT 'keys' AS pair, count(*) = 0 AS is_equal FROM (
         SELECT v, sum(s) AS n FROM (SELECT c_custkey AS v, 1 AS s FROM customer
                                     UNION ALL SELECT o_custkey, -1 FROM orders) GROUP BY v HAVING sum(s) <> 0)
       UNION ALL
       SELECT 'tokens', count(*) = 0 FROM (
         SELECT v, sum(s) AS n FROM (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS v, 1 AS s FROM events
                                     UNION ALL SELECT CAST(trim(props, '{"k: }') AS BIGINT), -1 FROM events)
         GROUP BY v HAVING sum(s) <> 0)"""
)
def multiset_equal(t):
    keys = sq.same_multiset(t.customer, "c_custkey", t.orders, "o_custkey").select(F.lit("keys").alias("pair"), "is_equal")
    parsed = t.events.select(F.get_json_object("props", "$.k").cast("bigint").alias("v"))
    digits = t.events.select(F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("v"))
    same = sq.same_multiset(parsed, "v", digits, "v").select(F.lit("tokens").alias("pair"), "is_equal")
    return keys.unionAll(same)


@query(
    """SELECT max(v) AS max_after_zero FROM (
         SELECT v, lag(v) OVER (ORDER BY event_id) AS p
         FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS v FROM events))
       WHERE p = 0"""
)
def max_after_zero(t):
    silenced = t.events.select("event_id", F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value")).alias("v"))
    return sq.max_after_zero(silenced, "event_id", "v")


@query(
    """SELECT user_id, CAST(run AS BIGINT) AS run, min(event_type) AS event_type, CAST(count(*) AS BIGINT) AS n FROM (
         SELECT *, sum(start) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM (
           SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS start
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)))
       GROUP BY user_id, run"""
)
def run_length(t):
    return sq.run_lengths(t.events, "event_id", "event_type", ["user_id"])


@query(
    """SELECT CAST(run AS BIGINT) AS run, min(event_type) AS event_type, CAST(count(*) AS BIGINT) AS n FROM (
         SELECT *, sum(start) OVER (ORDER BY event_id) AS run FROM (
           SELECT *, CASE WHEN lag(event_type) OVER (ORDER BY event_id) IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END
                  AS start FROM events))
       GROUP BY run"""
)
def run_length_whole(t):
    return sq.run_lengths(t.events, "event_id", "event_type")


@query(
    """SELECT user_id, event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1
              THEN 0.0 ELSE value END AS value FROM events"""
)
def zero_argmax(t):
    return sq.zero_first_max(t.events.select("user_id", "event_id", "value"), "event_id", "value", ["user_id"])
