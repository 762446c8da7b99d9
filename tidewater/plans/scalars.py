"""Projections, predicates, text, date and JSON expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import dates, text, values
from tidewater.operators import postings
from tidewater.operators import validation as va
from tidewater.operators.joins import not_in as not_in_rows
from tidewater.operators.purchases import preview
from tidewater.operators.warehouse import calendar as calendar_rows
from tidewater.registry import query
from tidewater.sources.layouts import layout

AS_OF = "2002-02-28"


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CAST(CAST(l_quantity * l_tax AS DECIMAL(10,2)) AS DOUBLE) AS total_amount FROM lineitem"""
)
def purchase_amount(t):
    # the tax column has two decimals and the quantity none, so the product is exact money
    total = values.line_total(F.col("l_tax"), F.col("l_quantity")).cast("double")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", total.alias("total_amount"))


@query(
    """SELECT o_orderkey, coalesce(CAST(nullif(o_totalprice, 0) AS DOUBLE), 0.0) AS total_amount, o_orderdate
       FROM orders ORDER BY o_orderkey LIMIT 100"""
)
def preview_sales(t):
    facts = t.orders.select("o_orderkey", F.col("o_totalprice").alias("total_amount"), "o_orderdate")
    return preview(facts, "o_orderkey", 100)


@query(
    """SELECT p_partkey, round(p_retailprice, 2) AS price,
              [round(p_retailprice, 2), round(p_retailprice * 2, 2)][1] AS first_price FROM part"""
)
def dec_to_double(t):
    money = F.col("p_retailprice").cast("decimal(10,2)")
    decimals = t.part.select("p_partkey", money.alias("price"), F.array(money, (money * 2).cast("decimal(10,2)")).alias("prices"))
    plain = va.decimals_to_double(decimals)
    return plain.select("p_partkey", "price", F.element_at("prices", 1).alias("first_price"))


@query(
    """SELECT event_id, CAST(CAST(k AS FLOAT) AS DOUBLE) AS k_float, CAST(k AS INTEGER) AS k_int,
              CAST(CAST(k AS DECIMAL(10,4)) AS DOUBLE) AS k_decimal,
              TRY_CAST(event_type AS INTEGER) AS k_lenient
       FROM (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events)"""
)
def typed_cast(t):
    raw = t.events.select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    return raw.select(
        "event_id",
        F.col("k").cast("float").cast("double").alias("k_float"),
        F.col("k").cast("int").alias("k_int"),
        F.col("k").cast("decimal(10,4)").cast("double").alias("k_decimal"),
        values.whole_number(F.col("event_type"), "int").alias("k_lenient"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
              round(CASE WHEN l_quantity - 1 > 0 THEN (l_extendedprice / 1000) / ((l_quantity - 1) / 3600)
                         ELSE 0.0 END, 6) AS speed FROM lineitem"""
)
def safe_speed(t):
    speed = values.speed_kmh(F.col("l_extendedprice"), F.col("l_quantity") - 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(speed, 6).alias("speed"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'Starts with 1'
                               WHEN o_orderpriority LIKE '%NOT%' THEN 'Contains NOT' END AS label FROM orders"""
)
def case_label(t):
    priority = F.col("o_orderpriority")
    label = F.when(priority.like("1%"), "Starts with 1").when(priority.like("%NOT%"), "Contains NOT")
    return t.orders.select("o_orderkey", label.alias("label"))


@query(
    """SELECT event_id, CASE WHEN value > 3 AND value < 8 THEN -value ELSE value END AS value FROM events"""
)
def sign_flip(t):
    return t.events.select("event_id", values.flip_between(F.col("value"), 3, 8).alias("value"))


@query(
    """SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, coalesce(CAST(quality AS VARCHAR), '-') AS quality,
              coalesce(CAST(toxic AS VARCHAR), '-') AS toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def fill_dash(t):
    return va.fill_all_nulls(t.documents.select("doc_id").join(t.labels, "doc_id", "left"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'b%' OR p_name LIKE '%-%' OR p_name LIKE '%ring'")
def like_or(t):
    name = F.col("p_name")
    return t.part.filter(name.like("b%") | name.like("%-%") | name.like("%ring")).select("p_partkey", "p_name")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM (
         SELECT *, CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS return_date FROM lineitem)
       WHERE return_date IS NULL"""
)
def late_open(t):
    returned = F.when(F.col("l_linestatus") != "O", F.col("l_shipdate"))
    return t.lineitem.withColumn("return_date", returned).filter(F.col("return_date").isNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'"""
)
def date_between(t):
    # the column stays bare, so the range reaches the scan
    return t.orders.filter(
        "o_orderdate >= timestamp_ntz '1997-03-01' AND o_orderdate < timestamp_ntz '1997-06-01'"
    ).select("o_orderkey", "o_orderdate")


@query(
    """SELECT CAST(count(ts) AS BIGINT) AS kept, CAST(count(*) - count(ts) AS BIGINT) AS dropped
       FROM (SELECT TRY_CAST(CASE WHEN event_type = 'error' THEN 'bad ' ELSE '' END || CAST(ts AS VARCHAR) AS TIMESTAMP)
             AS ts FROM events)"""
)
def drop_bad_ts(t):
    stamp = F.concat(F.when(F.col("event_type") == "error", "bad ").otherwise(""), F.col("ts").cast("string"))
    parsed = t.events.select(F.try_to_timestamp(stamp).alias("ts"))
    return parsed.agg(F.count("ts").alias("kept"), F.count_if(F.col("ts").isNull()).alias("dropped"))




@query(
    """SELECT errors, CAST(count(*) AS BIGINT) AS n FROM (
         SELECT concat_ws(',', CASE WHEN NOT o_orderstatus IN ('O', 'F') THEN 'status' END,
                               CASE WHEN NOT year(o_orderdate) BETWEEN 1901 AND 1999 THEN 'year' END,
                               CASE WHEN o_totalprice IS NULL THEN 'price' END) AS errors FROM orders)
       GROUP BY errors"""
)
def validate_split(t):
    rules = {
        "status": F.col("o_orderstatus").isin("O", "F"),
        "year": F.year("o_orderdate").between(1901, 1999),
        "price": F.col("o_totalprice").isNotNull(),
    }
    checked = va.with_errors(t.orders, rules)
    return checked.groupBy(F.concat_ws(",", "_errors").alias("errors")).agg(F.count("*").alias("n"))


@query(
    """SELECT 'ACCOUNTADMIN' AS role, CAST(count(*) AS BIGINT) AS visible FROM customer
       UNION ALL SELECT 'ANALYST', CAST(count(*) FILTER (false) AS BIGINT) FROM customer"""
)
def row_policy(t):
    def seen(role):
        rows = t.customer.filter(va.visible_to(role, ["ACCOUNTADMIN"]))
        return rows.agg(F.lit(role).alias("role"), F.count("*").alias("visible"))

    return seen("ACCOUNTADMIN").unionAll(seen("ANALYST"))


@query(
    """SELECT doc_id FROM (SELECT doc_id, string_split_regex(lower(concat_ws(' ', source, text)), '[^\\p{L}\\p{N}]+') AS w
                           FROM documents)
       WHERE list_contains(w, 'the') AND list_contains(w, 'and')"""
)
def token_search(t):
    """Both words are looked up in a table of posting lists, which is written once."""

    def build(path):
        postings.write_postings(t.documents, "doc_id", [F.col("source"), F.col("text")], path)

    path = layout(t, "postings", build)
    lists = t.spark.read.schema("term string, block int, docs array<bigint>, bucket int").parquet(path)
    return postings.with_all_terms(lists, ["the", "and"], "doc_id")


@query(
    """SELECT doc_id FROM (SELECT doc_id, string_split_regex(lower(concat_ws(' ', source, text)), '[^\\p{L}\\p{N}]+') AS w
                           FROM documents)
       WHERE list_contains(w, 'the') AND list_contains(w, 'and')"""
)
def token_scan(t):
    """The same by a look at every text."""
    found = text.mentions_all_terms(["the", "and"], F.col("source"), F.col("text"))
    return t.documents.filter(found).select("doc_id")


@query("""SELECT doc_id, regexp_replace(text, '[^\\p{L}\\p{N}_\\s.,?!-]', '', 'g') AS content FROM documents""")
def clean_text(t):
    return text.clean_text_column(t.documents.select("doc_id", F.col("text").alias("content")), "content")


@query("""SELECT c_custkey, c_name || ' ' || nullif(c_mktsegment, 'BUILDING') AS name FROM customer""")
def full_name(t):
    segment = F.expr("nullif(c_mktsegment, 'BUILDING')")
    return t.customer.select("c_custkey", text.full_name(F.col("c_name"), segment).alias("name"))


@query(
    """SELECT p_partkey, CASE WHEN starts_with(p_name, 'red') THEN 'red' ELSE 'other' END AS label,
              substring(p_name, 1, 3) AS head, upper(p_brand) AS brand FROM part"""
)
def prefix_label(t):
    return t.part.select(
        "p_partkey",
        F.when(F.col("p_name").startswith("red"), "red").otherwise("other").alias("label"),
        F.substring("p_name", 1, 3).alias("head"),
        F.upper("p_brand").alias("brand"),
    )


@query(
    f"""SELECT o_orderkey, CAST(date_part('year', DATE '{AS_OF}') - date_part('year', o_orderdate)
               - CASE WHEN strftime(o_orderdate, '%m-%d') > strftime(DATE '{AS_OF}', '%m-%d') THEN 1 ELSE 0 END AS BIGINT)
               AS years FROM orders"""
)
def years_between(t):
    years = dates.whole_years(F.col("o_orderdate"), F.lit(AS_OF).cast("timestamp_ntz"))
    return t.orders.select("o_orderkey", years.alias("years"))


@query("SELECT event_id, CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS parsed FROM events")
def parse_iso(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select("event_id", F.to_timestamp(iso).cast("timestamp_ntz").alias("parsed"))


@query("SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') AS DATE) AS parsed FROM orders")
def parse_us_date(t):
    return t.orders.select("o_orderkey", dates.us_date(F.date_format("o_orderdate", "M/d/yyyy")).alias("parsed"))


@query(
    """SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN 'n/a'
              ELSE strftime(o_orderdate, '%m/%d/%Y') END, '%m/%d/%Y') AS DATE) AS parsed FROM orders"""
)
def try_us_date(t):
    raw = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return t.orders.select("o_orderkey", dates.try_us_date(raw).alias("parsed"))


@query(
    """SELECT event_id, make_timestamp(CAST(epoch(date_trunc('second', ts)) * 1000000 AS BIGINT)) AS parsed
       FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, NULL FROM events WHERE event_type = 'error'"""
)
def epoch_ts(t):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    raw = F.when(F.col("event_type") == "error", "broken").otherwise(seconds)
    return t.events.select("event_id", dates.epoch_seconds(raw).cast("timestamp_ntz").alias("parsed"))


@query(
    """SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
              CAST(month(d) AS INTEGER) AS month_num, rpad(strftime(d, '%B'), 9, ' ') AS month_name,
              rpad(strftime(d, '%A'), 9, ' ') AS day_name, CAST(isodow(d) AS INTEGER) AS day_of_week
       FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                           INTERVAL 1 DAY)) AS d FROM orders)"""
)
def calendar(t):
    span = t.orders.agg(
        F.struct(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    ).scalar()
    return calendar_rows(span["a"], span["b"], t.spark)


@query("SELECT strftime(ts, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def split_month(t):
    return t.events.groupBy(dates.month_label(F.col("ts")).alias("month")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders")
def month_end(t):
    return t.orders.select("o_orderkey", F.last_day("o_orderdate").alias("month_end"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t):
    parsed = F.try_parse_json("props")
    return t.events.select("event_id", F.try_variant_get(parsed, "$.k", "bigint").alias("k"))


@query("SELECT event_id, 'StationName=' || event_type || ';props=' || props AS item FROM events")
def prune_map(t):
    fields = F.create_map(
        F.lit("station_dep"), F.col("event_type"), F.lit("props"), F.col("props"),
        F.lit("blank"), F.lit(""), F.lit("missing"), F.lit(None).cast("string"),
    )
    pruned = values.rename_key(values.without_empty(fields), "station_dep", "StationName")
    entries = F.array_sort(F.transform(F.map_entries(pruned), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return t.events.select("event_id", F.array_join(entries, ";").alias("item"))


@query("SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_in_form FROM orders")
def with_uuid(t):
    """How many identifiers are given, differ, and have the form of a version 4 UUID."""
    named = t.orders.select("o_orderkey", F.uuid().alias("row_id"))
    form = F.col("row_id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return named.agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("n_distinct"), F.count_if(form).alias("n_in_form"))


@query(
    """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def not_in_sub(t):
    return not_in_rows(t.orders, t.lineitem, "o_orderkey", "l_orderkey").select("o_orderkey")


@query("SELECT doc_id, source, CAST(length(text) AS BIGINT) AS n_chars, content FROM (SELECT *, text AS content FROM documents)")
def sort_created(t):
    ordered = va.when_column(t.documents, "source", lambda df: df.orderBy(F.asc_nulls_last("source"), "doc_id"))
    return ordered.select(
        "doc_id", "source", F.length("text").cast("bigint").alias("n_chars"), F.col("text").alias("content")
    )
