"""Purchase events to staging rows and a star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.values import amount_or_zero, line_total
from tidewater.operators.warehouse import Load, insert_ignore, placeholder_members

EVENT_SCHEMA = (
    "event_id string, event_type string, user_id string, game_id string, product_id string, product_name string, "
    "price double, quantity int, timestamp string, user_country string"
)


def stage_purchases(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("purchase_id"),
        "user_id",
        "game_id",
        "product_id",
        F.to_timestamp("timestamp").alias("purchase_timestamp"),
        "quantity",
        line_total(F.col("price"), F.col("quantity")).alias("total_amount"),
    )


def load_star(staged: DataFrame, users: DataFrame, games: DataFrame, products: DataFrame, facts: DataFrame) -> dict:
    """Rows to append to each table: stand-in dimension members, then facts not loaded before."""
    load: Load = insert_ignore(facts, staged, ["purchase_id"], ["purchase_timestamp", "user_id", "product_id"])
    return {
        "dim_games": placeholder_members(games, staged, "game_id", {"title": "Unknown Game"}),
        "dim_products": placeholder_members(
            products, staged, "product_id", {"name": "Unknown Product", "price": 0.0}
        ).withColumn("price", F.col("price").cast("decimal(10,2)")),
        "dim_users": placeholder_members(users, staged, "user_id", {"country": "Unknown"}),
        "fact_purchases": load.inserted,
    }


def preview(facts: DataFrame, key: str, limit: int = 100) -> DataFrame:
    """First sales by key, amounts as plain numbers."""
    return facts.withColumn("total_amount", amount_or_zero(F.col("total_amount"))).orderBy(key).limit(limit)
