"""Reports over a film rental database.

``db`` maps table names to DataFrames: actor, film, film_actor, film_category, category,
language, inventory, rental, payment, customer, staff, store, address, city, country.
Rentals and payments are summed per item, film or customer before they meet a dimension,
so no join carries single rentals further than it must.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import hours_between
from tidewater.functions.text import full_name, mentions_all_terms, proper
from tidewater.operators.joins import without_match
from tidewater.operators.ranking import top_dense, top_rows

Database = Mapping[str, DataFrame]


def _category_of(db: Database) -> DataFrame:
    """(film_id, category)"""
    names = db["category"].select("category_id", F.col("name").alias("category"))
    return db["film_category"].select("film_id", "category_id").join(names, "category_id").select("film_id", "category")


def _per_film(db: Database, facts: DataFrame, measure: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sums a measure of facts with an inventory_id per film (and further keys)."""
    per_item = facts.groupBy("inventory_id", *keys).agg(F.sum(measure).alias(measure))
    items = db["inventory"].select("inventory_id", "film_id")
    return per_item.join(items, "inventory_id").groupBy("film_id", *keys).agg(F.sum(measure).alias(measure))


def _rentals(db: Database) -> DataFrame:
    return db["rental"].select("inventory_id", F.lit(1).alias("n"))


def _paid(db: Database) -> DataFrame:
    """Payments summed per rental, at the rented item."""
    per_rental = db["payment"].groupBy("rental_id").agg(F.sum("amount").alias("amount"))
    return per_rental.join(db["rental"].select("rental_id", "inventory_id"), "rental_id")


def _per_actor(db: Database, per_film: DataFrame, measure: str) -> DataFrame:
    cast = db["film_actor"].select("actor_id", "film_id")
    summed = per_film.join(cast, "film_id").groupBy("actor_id").agg(F.sum(measure).alias(measure))
    return summed.join(db["actor"].select("actor_id", "first_name", "last_name"), "actor_id")


def films_per_category(db: Database) -> DataFrame:
    counts = _category_of(db).groupBy("category").agg(F.count("*").alias("film_count"))
    return counts.select(F.col("category").alias("category_name"), "film_count").orderBy(F.desc("film_count"), "category_name")


def most_rented_actors(db: Database, limit: int = 10) -> DataFrame:
    counted = _per_actor(db, _per_film(db, _rentals(db), "n"), "n").withColumnRenamed("n", "rental_count")
    return top_rows(counted, limit, F.desc("rental_count"), F.col("actor_id")).select(
        "actor_id", "first_name", "last_name", "rental_count"
    )


def top_earning_actors(db: Database, limit: int = 10) -> DataFrame:
    summed = _per_actor(db, _per_film(db, _paid(db), "amount"), "amount")
    rounded = summed.withColumn("total_revenue", F.round("amount", 2))
    return top_rows(rounded, limit, F.desc("total_revenue"), F.col("actor_id")).select(
        "actor_id", "first_name", "last_name", "total_revenue"
    )


def sales_by_category(db: Database) -> DataFrame:
    summed = _per_film(db, _paid(db), "amount").join(_category_of(db), "film_id")
    return summed.groupBy("category").agg(F.round(F.sum("amount"), 2).alias("total_sales")).orderBy(
        F.desc("total_sales"), "category"
    )


def top_category(db: Database) -> DataFrame:
    return sales_by_category(db).limit(1)


def films_not_in_inventory(db: Database) -> DataFrame:
    return without_match(db["film"], db["inventory"], "film_id", "film_id").select("title")


def most_cast_actors(db: Database, category: str = "Children", places: int = 3) -> DataFrame:
    """Actors in the first places by number of films of a category, ties kept."""
    films = _category_of(db).filter(F.col("category") == category).select("film_id", F.lit(1).alias("film_count"))
    ranked = top_dense(_per_actor(db, films, "film_count"), "film_count", places, rank="rank")
    return ranked.select("first_name", "last_name", "film_count", "rank").orderBy(F.desc("film_count"), "first_name")


def _customers_per_city(db: Database, active: Column, names: tuple[str, str]) -> DataFrame:
    flags = db["customer"].groupBy("address_id").agg(
        F.count_if(active).alias(names[0]), F.count_if(~active).alias(names[1])
    )
    placed = flags.join(db["address"].select("address_id", "city_id"), "address_id").join(
        db["city"].select("city_id", "city"), "city_id"
    )
    return placed.groupBy("city").agg(*(F.sum(n).alias(n) for n in names))


def clients_per_city(db: Database) -> DataFrame:
    """Active (1) and inactive (0) clients per city, most inactive first."""
    counted = _customers_per_city(db, F.col("active") == 1, ("active_clients", "inactive_clients"))
    return counted.orderBy(F.desc("inactive_clients"), "city")


def most_active_cities(db: Database, limit: int = 20) -> DataFrame:
    """The same by the boolean flag, most active first."""
    counted = _customers_per_city(db, F.col("activebool"), ("active_customers", "inactive_customers"))
    return top_rows(counted, limit, F.desc("active_customers"), F.col("city"))


def _cities(db: Database) -> DataFrame:
    """(customer_id, city)"""
    homes = db["customer"].select("customer_id", "address_id").join(db["address"].select("address_id", "city_id"), "address_id")
    return homes.join(db["city"].select("city_id", "city"), "city_id").select("customer_id", "city")


def best_categories_by_length(db: Database, prefix: str = "a") -> DataFrame:
    """Category with most film hours rented, for cities by initial and, otherwise, by hyphen."""
    initial, hyphen = F.col("city").startswith(prefix), F.col("city").contains("-")
    group = F.when(initial, f"Starts with {prefix}").when(hyphen, "Contains hyphen")
    cities = _cities(db).filter(initial | hyphen).select("customer_id", group.alias("city_group"))
    rented = db["rental"].select("customer_id", "inventory_id", F.lit(1).alias("n")).join(cities, "customer_id")
    per_film = _per_film(db, rented, "n", ("city_group",))
    minutes = per_film.join(db["film"].select("film_id", "length"), "film_id").withColumn("m", F.col("n") * F.col("length"))
    hours = minutes.join(_category_of(db), "film_id").groupBy("city_group", F.col("category").alias("category_name")).agg(
        (F.sum("m").cast("double") / F.lit(60.0)).alias("total_hours")
    )
    best = top_dense(hours, "total_hours", 1, ["city_group"])
    return best.select("city_group", "category_name", "total_hours").orderBy("city_group")


def best_category_by_time(db: Database, cities: Column) -> DataFrame:
    """Category with most hours between rental and return, for customers of the given cities.

    ``cities`` is a condition on the column ``city``, such as a LIKE pattern.
    """
    held = db["rental"].filter(F.col("return_date").isNotNull()).select(
        "customer_id", "inventory_id", hours_between(F.col("rental_date"), F.col("return_date")).alias("hours")
    )
    chosen = held.join(_cities(db).filter(cities).select("customer_id"), "customer_id", "left_semi")
    summed = _per_film(db, chosen, "hours").join(_category_of(db), "film_id").groupBy("category").agg(
        F.round(F.sum("hours"), 2).alias("total_rental_hours")
    )
    return top_rows(summed, 1, F.desc("total_rental_hours"), F.col("category"))


def _placed(db: Database, people: DataFrame) -> DataFrame:
    places = db["address"].join(db["city"], "city_id").join(db["country"], "country_id")
    return people.join(places.select("address_id", "address", "postal_code", "phone", "city", "country"), "address_id")


def customer_list(db: Database) -> DataFrame:
    notes = F.when(F.col("activebool"), "active").otherwise("")
    return _placed(db, db["customer"]).select(
        F.col("customer_id").alias("id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        "address", F.col("postal_code").alias("zip code"), "phone", "city", "country",
        notes.alias("notes"), F.col("store_id").alias("sid"),
    )


def staff_list(db: Database) -> DataFrame:
    return _placed(db, db["staff"]).select(
        F.col("staff_id").alias("id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("name"),
        "address", F.col("postal_code").alias("zip code"), "phone", "city", "country", F.col("store_id").alias("sid"),
    )


def film_list(db: Database, nicer: bool = False) -> DataFrame:
    """Films with their actors as one text; ``nicer`` writes the names in proper case, joined."""
    first, last = F.col("first_name"), F.col("last_name")
    shown = F.concat(proper(first), proper(last)) if nicer else full_name(first, last)
    cast = db["film_actor"].join(db["actor"].select("actor_id", shown.alias("_name")), "actor_id")
    actors = cast.groupBy("film_id").agg(F.expr("listagg(_name, ', ') WITHIN GROUP (ORDER BY _name)").alias("actors"))
    return _category_of(db).join(db["film"], "film_id").join(actors, "film_id").select(
        F.col("film_id").alias("fid"), "title", "description", "category", F.col("rental_rate").alias("price"),
        "length", "rating", "actors",
    )


def actor_info(db: Database) -> DataFrame:
    """Every actor with the titles played in, category by category."""
    titles = (
        db["film_actor"].select("actor_id", "film_id").join(_category_of(db), "film_id")
        .join(db["film"].select("film_id", "title"), "film_id")
    )
    lines = titles.groupBy("actor_id", "category").agg(
        F.expr("listagg(title, ', ') WITHIN GROUP (ORDER BY title)").alias("_titles")
    ).withColumn("_line", F.concat("category", F.lit(": "), "_titles"))
    info = lines.groupBy("actor_id").agg(F.expr("listagg(_line, ', ') WITHIN GROUP (ORDER BY _line)").alias("film_info"))
    return db["actor"].join(info, "actor_id", "left").select("actor_id", "first_name", "last_name", "film_info")


def sales_by_store(db: Database) -> DataFrame:
    per_item = _paid(db).groupBy("inventory_id").agg(F.sum("amount").alias("amount"))
    per_store = per_item.join(db["inventory"].select("inventory_id", "store_id"), "inventory_id").groupBy("store_id").agg(
        F.sum("amount").alias("amount")
    )
    managers = db["staff"].select(
        F.col("staff_id").alias("manager_staff_id"), full_name(F.col("first_name"), F.col("last_name")).alias("manager")
    )
    stores = _placed(db, db["store"].select("store_id", "address_id", "manager_staff_id"))
    return (
        per_store.join(stores, "store_id").join(managers, "manager_staff_id").orderBy("country", "city", "store_id")
        .select(F.concat("city", F.lit(","), "country").alias("store"), "manager", F.round("amount", 2).alias("total_sales"))
    )


def late_rentals(db: Database, as_of: Column, limit: int = 5) -> DataFrame:
    """Who has which film out, by title; ``as_of`` is the current date."""
    late = db["rental"].filter(F.col("return_date").isNull() & (F.col("rental_date") < as_of))
    titles = db["inventory"].select("inventory_id", "film_id").join(db["film"].select("film_id", "title"), "film_id")
    people = db["customer"].join(db["address"].select("address_id", "phone"), "address_id").select(
        "customer_id", "phone", F.concat_ws(", ", "last_name", "first_name").alias("customer")
    )
    found = late.join(titles, "inventory_id").join(people, "customer_id")
    return top_rows(found.select("customer", "phone", "title", "rental_id"), limit, F.col("title"), F.col("rental_id")).drop("rental_id")


def search_films(db: Database, *terms: str) -> DataFrame:
    """Films whose title and description hold every term as a word."""
    return db["film"].filter(mentions_all_terms(terms, F.col("title"), F.col("description")))
