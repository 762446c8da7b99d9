"""Store sales: two staged loads into core dimensions and facts, then a mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import us_date
from tidewater.operators import sampling as sp
from tidewater.operators import warehouse as wh

# Staging columns in file order, and the regions
STAGING = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name", "segment", "country",
    "city", "state", "postal_code", "region", "product_id", "category", "sub_category", "product_name", "sales",
    "quantity", "discount", "profit",
)
REGIONS = ("South", "West", "Central", "East")
LOCATION = ("country", "state", "city", "postal_code")
CORE_SCHEMAS = {
    "dim_locations": "location_id bigint, country string, state string, city string, postal_code string, region string",
    "dim_products": "product_id string, category string, sub_category string, product_name string",
    "dim_customers": "customer_sk bigint, customer_id string, customer_name string, segment string, "
    "valid_from timestamp, valid_to timestamp, is_current boolean",
    "fct_orders": "order_pk bigint, order_id string, order_date date, ship_date date, ship_mode string, customer_sk bigint, "
    "location_id bigint, product_id string, sales decimal(10,4), quantity int, discount decimal(4,2), "
    "profit decimal(10,4), source_row_id string",
}


def prepare_loads(rows: DataFrame, seed: int = 42, regions: Sequence[str] = REGIONS, percent: int = 80, new_share: float = 0.5,
                  repeated_rows: int = 50, renamed_rows: int = 20, moved_rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """Initial load (about ``percent`` %) and a second one to test the loads with.

    The second holds a share of the other rows, repeated rows, renamed customers and moved
    regions, in random order. All draws are hashes of the row id.
    """
    initial, rest = sp.bernoulli_split(rows, "row_id", percent, seed)
    new = sp.sample_fraction(rest, "row_id", new_share, seed + 1)
    repeated = sp.sample_rows(initial, "row_id", repeated_rows, seed + 2)
    renamed = sp.sample_rows(initial, "row_id", renamed_rows, seed + 3).withColumn(
        "customer_name", F.concat("customer_name", F.lit(" (Updated)"))
    )
    moved = sp.sample_rows(initial, "row_id", moved_rows, seed + 4).withColumn(
        "region", sp.other_choice(F.col("region"), regions, "row_id", seed)
    )
    second = new.unionByName(repeated).unionByName(renamed).unionByName(moved)
    return initial, sp.shuffle_rows(second, "row_id", seed)


def empty_core(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in CORE_SCHEMAS.items()}


def _next(table: DataFrame, key: str) -> Column:
    return F.coalesce(table.agg(F.max(key)).scalar(), F.lit(0))


def load_locations(core: Mapping[str, DataFrame], staged: DataFrame) -> DataFrame:
    """New locations, numbered; the region is an attribute, so a moved region adds none."""
    batch = staged.select(*LOCATION, "region").distinct()
    fresh = wh.insert_ignore_unique(core["dim_locations"], batch, LOCATION, ["region"])
    return wh.surrogate_keys(fresh, [*LOCATION, "region"], "location_id", _next(core["dim_locations"], "location_id"))


def load_products(core: Mapping[str, DataFrame], staged: DataFrame) -> DataFrame:
    batch = staged.select("product_id", "category", "sub_category", "product_name").distinct()
    order = ["category", "sub_category", "product_name"]
    return wh.insert_ignore(core["dim_products"], batch, ["product_id"], order).inserted


def renamed_customers(core: Mapping[str, DataFrame], staged: DataFrame) -> DataFrame:
    """Customers with the names of the load where they changed; of several the last in order."""
    return wh.overwrite_attribute(
        core["dim_customers"], staged, "customer_id", "customer_name", ["-customer_name"], F.col("is_current")
    )


def load_customers(core: Mapping[str, DataFrame], staged: DataFrame, as_of: Column) -> DataFrame:
    batch = staged.select("customer_id", "customer_name", "segment")
    fresh = wh.new_members(core["dim_customers"], batch, "customer_id")
    keys = ["customer_id", "customer_name", "segment"]
    numbered = wh.surrogate_keys(fresh, keys, "customer_sk", _next(core["dim_customers"], "customer_sk"))
    return numbered.withColumns(
        {"valid_from": as_of, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    )


def load_orders(core: Mapping[str, DataFrame], staged: DataFrame, by_state: bool = True) -> DataFrame:
    """Facts of rows not loaded before; a row without current customer or location is dropped.

    The first load finds locations by postal code, city and state, later ones by the first two.
    """
    place = ["postal_code", "city", "state"] if by_state else ["postal_code", "city"]
    customers = core["dim_customers"].filter("is_current").select("customer_id", "customer_sk")
    locations = core["dim_locations"].select(*place, "location_id")
    columns = {
        "order_id": F.col("order_id"),
        "order_date": us_date(F.col("order_date")),
        "ship_date": us_date(F.col("ship_date")),
        "ship_mode": F.col("ship_mode"),
        "customer_sk": F.col("customer_sk"),
        "location_id": F.col("location_id"),
        "product_id": F.col("product_id"),
        "sales": F.col("sales").cast("decimal(10,4)"),
        "quantity": F.col("quantity").cast("int"),
        "discount": F.col("discount").cast("decimal(4,2)"),
        "profit": F.col("profit").cast("decimal(10,4)"),
        "source_row_id": F.col("row_id"),
    }
    loaded = core["fct_orders"].select(F.col("source_row_id").alias("row_id"))
    fresh = wh.append_new_facts(loaded, staged, "row_id")
    facts = wh.lookup_facts(fresh, [(customers, ["customer_id"]), (locations, place)], columns)
    return wh.surrogate_keys(
        facts, ["source_row_id", "customer_sk", "location_id"], "order_pk", _next(core["fct_orders"], "order_pk")
    )


def load(core: Mapping[str, DataFrame], staged: DataFrame, as_of: Column, by_state: bool = True) -> dict[str, DataFrame]:
    """The core after one staged load; nothing is written."""
    after = dict(core)
    after["dim_locations"] = core["dim_locations"].unionByName(load_locations(core, staged))
    after["dim_products"] = core["dim_products"].unionByName(load_products(core, staged))
    after["dim_customers"] = renamed_customers(core, staged).unionByName(load_customers(core, staged, as_of))
    after["fct_orders"] = core["fct_orders"].unionByName(load_orders(after, staged, by_state))
    return after


def mart(core: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The star the reports read; publish each table to keep it."""
    facts = core["fct_orders"]
    return {
        "dim_products": core["dim_products"],
        "dim_customers": core["dim_customers"].filter("is_current").drop("valid_from", "valid_to"),
        "dim_locations": core["dim_locations"],
        "fact_sales": facts.select(
            "order_pk", "order_id", "order_date", "customer_sk", "location_id", "product_id", "sales", "quantity",
            "discount", "profit",
        ),
        "dim_calendar": wh.calendar(F.lit("2014-01-01").cast("date"), F.lit("2025-12-31").cast("date"), facts.sparkSession),
    }
