"""Film shop reports against plain SQL in DuckDB on a random little shop."""

import datetime
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from compare import rows_of
from tidewater.operators import film_shop as fs

SCHEMAS = {
    "actor": "actor_id int, first_name string, last_name string",
    "film": "film_id int, title string, description string, rental_duration int, rental_rate double, length int, rating string",
    "film_actor": "actor_id int, film_id int",
    "category": "category_id int, name string",
    "film_category": "film_id int, category_id int",
    "inventory": "inventory_id int, film_id int, store_id int",
    "rental": "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int, return_date timestamp_ntz",
    "payment": "payment_id int, customer_id int, rental_id int, amount double, payment_date timestamp_ntz",
    "customer": "customer_id int, store_id int, first_name string, last_name string, address_id int, activebool boolean, active int",
    "staff": "staff_id int, first_name string, last_name string, address_id int, store_id int",
    "store": "store_id int, manager_staff_id int, address_id int",
    "address": "address_id int, address string, postal_code string, phone string, city_id int",
    "city": "city_id int, city string, country_id int",
    "country": "country_id int, country string",
}
CITIES = ["aurora", "al-minya", "baden-baden", "Zug", "kyoto"]


def rows():
    rng = random.Random(4)
    start = datetime.datetime(2022, 1, 1)
    rentals, payments = [], []
    for i in range(1, 301):
        out = start + datetime.timedelta(hours=rng.randrange(0, 5000))
        back = None if rng.random() < 0.1 else out + datetime.timedelta(minutes=rng.randrange(30, 20000))
        # item 1 is the hot one
        rentals.append((i, out, 1 if rng.random() < 0.33 else rng.randrange(1, 61), rng.randrange(1, 31), back))
        if rng.random() < 0.9:
            payments.append((i, rentals[-1][3], i, round(rng.uniform(0.5, 9), 2), out))
    return {
        "actor": [(i, rng.choice(["ANN", "bob"]), f"Name{i}") for i in range(1, 16)],
        "film": [(i, f"FILM {i:02d}", rng.choice([f"a Fate of {i} in India", "other", None]), 3, 2.99, 60 + i, "PG") for i in range(1, 26)],
        "film_actor": sorted({(rng.randrange(1, 15), rng.randrange(1, 26)) for _ in range(80)}),
        "category": [(1, "Children"), (2, "Drama"), (3, "Music")],
        "film_category": [(i, rng.randrange(1, 4)) for i in range(1, 26)],
        "inventory": [(i, rng.randrange(1, 21), rng.randrange(1, 3)) for i in range(1, 61)],
        "rental": rentals,
        "payment": payments,
        "customer": [(i, 1, f"F{i}", f"L{i}", rng.randrange(1, 11), rng.random() < 0.7, rng.randrange(0, 2)) for i in range(1, 31)],
        "staff": [(1, "Mike", "H", 1, 1), (2, "Jon", "S", 2, 2)],
        "store": [(1, 1, 1), (2, 2, 2)],
        "address": [(i, f"street {i}", f"{i:05d}", f"555-{i}", rng.randrange(1, 6)) for i in range(1, 11)],
        "city": [(i + 1, c, i % 2 + 1) for i, c in enumerate(CITIES)],
        "country": [(1, "Chad"), (2, "Peru")],
    }


@pytest.fixture(scope="module")
def data():
    return rows()


@pytest.fixture(scope="module")
def db(spark, data):
    return {name: spark.createDataFrame(data[name], schema).cache() for name, schema in SCHEMAS.items()}


@pytest.fixture(scope="module")
def con(data):
    connection = duckdb.connect()
    for name, schema in SCHEMAS.items():
        names = [c.split()[0] for c in schema.split(", ")]
        frame = pd.DataFrame(data[name], columns=names)  # noqa: F841
        kinds = {"int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
        casts = ", ".join(f"CAST({c.split()[0]} AS {kinds[c.split()[1]]}) AS {c.split()[0]}" for c in schema.split(", "))
        connection.execute(f"CREATE TABLE {name} AS SELECT {casts} FROM frame")
    return connection


SOLD = """payment p JOIN rental r ON p.rental_id = r.rental_id JOIN inventory i ON r.inventory_id = i.inventory_id"""
CATEGORY = "JOIN film_category fc ON fc.film_id = i.film_id JOIN category c ON c.category_id = fc.category_id"
HOME = "JOIN customer cu ON r.customer_id = cu.customer_id JOIN address a ON a.address_id = cu.address_id JOIN city ON city.city_id = a.city_id"

CASES = {
    "films_per_category": (fs.films_per_category, "SELECT name AS category_name, count(*) AS film_count FROM category JOIN film_category USING (category_id) GROUP BY name"),
    "most_rented_actors": (
        fs.most_rented_actors,
        """SELECT a.actor_id, first_name, last_name, count(*) AS rental_count FROM actor a JOIN film_actor fa ON a.actor_id = fa.actor_id
           JOIN inventory i ON i.film_id = fa.film_id JOIN rental r ON r.inventory_id = i.inventory_id
           GROUP BY ALL ORDER BY rental_count DESC, a.actor_id LIMIT 10""",
    ),
    "top_earning_actors": (
        fs.top_earning_actors,
        f"""SELECT a.actor_id, first_name, last_name, round(sum(amount), 2) AS total_revenue FROM {SOLD}
            JOIN film_actor fa ON fa.film_id = i.film_id JOIN actor a ON a.actor_id = fa.actor_id
            GROUP BY ALL ORDER BY total_revenue DESC, a.actor_id LIMIT 10""",
    ),
    "sales_by_category": (fs.sales_by_category, f"SELECT c.name AS category, round(sum(amount), 2) AS total_sales FROM {SOLD} {CATEGORY} GROUP BY 1"),
    "top_category": (fs.top_category, f"SELECT c.name AS category, round(sum(amount), 2) AS total_sales FROM {SOLD} {CATEGORY} GROUP BY 1 ORDER BY 2 DESC LIMIT 1"),
    "films_not_in_inventory": (fs.films_not_in_inventory, "SELECT title FROM film WHERE NOT EXISTS (SELECT 1 FROM inventory WHERE inventory.film_id = film.film_id)"),
    "most_cast_actors": (
        fs.most_cast_actors,
        """SELECT first_name, last_name, film_count, rnk AS rank FROM (SELECT *, dense_rank() OVER (ORDER BY film_count DESC) AS rnk FROM (
             SELECT a.actor_id, first_name, last_name, count(*) AS film_count FROM actor a JOIN film_actor fa ON a.actor_id = fa.actor_id
             JOIN film_category fc ON fc.film_id = fa.film_id JOIN category c ON c.category_id = fc.category_id
             WHERE c.name = 'Children' GROUP BY ALL)) WHERE rnk <= 3""",
    ),
    "clients_per_city": (
        fs.clients_per_city,
        """SELECT city, count(CASE WHEN active = 1 THEN 1 END) AS active_clients, count(CASE WHEN active = 0 THEN 1 END) AS inactive_clients
           FROM city JOIN address USING (city_id) JOIN customer USING (address_id) GROUP BY city""",
    ),
    "most_active_cities": (
        fs.most_active_cities,
        """SELECT city, CAST(sum(CASE WHEN activebool THEN 1 ELSE 0 END) AS BIGINT) AS active_customers,
                  CAST(sum(CASE WHEN NOT activebool THEN 1 ELSE 0 END) AS BIGINT) AS inactive_customers
           FROM city JOIN address USING (city_id) JOIN customer USING (address_id) GROUP BY city""",
    ),
    "best_categories_by_length": (
        fs.best_categories_by_length,
        f"""SELECT city_group, category_name, total_hours FROM (
              SELECT *, dense_rank() OVER (PARTITION BY city_group ORDER BY total_hours DESC) AS rnk FROM (
                SELECT c.name AS category_name, CASE WHEN city LIKE 'a%' THEN 'Starts with a' WHEN city LIKE '%-%' THEN 'Contains hyphen' END AS city_group,
                       CAST(sum(f.length) AS DOUBLE) / 60.0 AS total_hours
                FROM rental r JOIN inventory i ON r.inventory_id = i.inventory_id {CATEGORY} JOIN film f ON f.film_id = i.film_id {HOME}
                WHERE city LIKE 'a%' OR city LIKE '%-%' GROUP BY ALL)) WHERE rnk = 1""",
    ),
    "customer_list": (
        fs.customer_list,
        """SELECT customer_id AS id, first_name || ' ' || last_name AS name, address, postal_code AS "zip code", phone, city, country,
                  CASE WHEN activebool THEN 'active' ELSE '' END AS notes, store_id AS sid
           FROM customer JOIN address USING (address_id) JOIN city USING (city_id) JOIN country USING (country_id)""",
    ),
    "staff_list": (
        fs.staff_list,
        """SELECT staff_id AS id, first_name || ' ' || last_name AS name, address, postal_code AS "zip code", phone, city, country, store_id AS sid
           FROM staff JOIN address USING (address_id) JOIN city USING (city_id) JOIN country USING (country_id)""",
    ),
    "film_list": (
        fs.film_list,
        """SELECT film_id AS fid, title, description, name AS category, rental_rate AS price, length, rating,
                  string_agg(first_name || ' ' || last_name, ', ' ORDER BY first_name || ' ' || last_name) AS actors
           FROM category JOIN film_category USING (category_id) JOIN film USING (film_id) JOIN film_actor USING (film_id) JOIN actor USING (actor_id)
           GROUP BY ALL""",
    ),
    "actor_info": (
        fs.actor_info,
        """WITH t AS (SELECT actor_id, name, string_agg(title, ', ' ORDER BY title) AS titles FROM film_actor JOIN film USING (film_id)
                      JOIN film_category USING (film_id) JOIN category USING (category_id) GROUP BY ALL)
           SELECT actor_id, first_name, last_name, string_agg(name || ': ' || titles, ', ' ORDER BY name) AS film_info
           FROM actor LEFT JOIN t USING (actor_id) GROUP BY ALL""",
    ),
    "sales_by_store": (
        fs.sales_by_store,
        f"""SELECT city || ',' || country AS store, m.first_name || ' ' || m.last_name AS manager, round(sum(amount), 2) AS total_sales
            FROM {SOLD} JOIN store s ON i.store_id = s.store_id JOIN address a ON s.address_id = a.address_id JOIN city USING (city_id)
            JOIN country USING (country_id) JOIN staff m ON s.manager_staff_id = m.staff_id GROUP BY country, city, s.store_id, m.first_name, m.last_name""",
    ),
}
TIMES = f"""SELECT c.name AS category, round(sum(epoch(return_date) - epoch(rental_date)) / 3600, 2) AS total_rental_hours
    FROM rental r JOIN inventory i ON r.inventory_id = i.inventory_id {CATEGORY} {HOME}
    WHERE return_date IS NOT NULL AND city LIKE '%s' GROUP BY 1 ORDER BY 2 DESC LIMIT 1"""
for pattern in ("a%", "%-%"):
    CASES[f"by_time {pattern}"] = (
        lambda db, p=pattern: fs.best_category_by_time(db, F.col("city").like(p)), TIMES.replace("%s", pattern)
    )


@pytest.mark.parametrize("name", CASES)
def test_report(db, con, name):
    report, sql = CASES[name]
    df, rel = report(db), con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = rows_of(df.columns, df.collect()), rows_of(rel.columns, rel.fetchall())
    assert len(got) > 0 and got == want


def test_nicer_list(db):
    names = fs.film_list(db, nicer=True).first().actors
    assert any(n in names for n in ("AnnName", "BobName")) and " Name" not in names


def test_late_rentals(db, con):
    late = fs.late_rentals(db, F.lit("2022-06-01").cast("timestamp_ntz")).collect()
    want = con.sql(
        """SELECT concat(last_name, ', ', first_name), phone, title FROM rental r JOIN customer USING (customer_id) JOIN address USING (address_id)
           JOIN inventory USING (inventory_id) JOIN film USING (film_id)
           WHERE return_date IS NULL AND rental_date < DATE '2022-06-01' ORDER BY title, rental_id LIMIT 5"""
    ).fetchall()
    assert [tuple(r) for r in late] == want


def test_search(db, data):
    want = sum(1 for f in data["film"] if f[2] and "Fate" in f[2])
    assert fs.search_films(db, "fate", "india").count() == want > 0
