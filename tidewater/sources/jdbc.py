"""Database tables over JDBC, read and written in parallel."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.tables import register_views


@dataclass(frozen=True)
class Split:
    """How a table is read in parallel: ranges of a numeric or date column."""

    column: str
    low: str
    high: str
    parts: int


def read_options(url: str, table: str, properties: Mapping[str, str], split: Split | None) -> dict[str, str]:
    options = {"url": url, "dbtable": table, **properties}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.low,
            "upperBound": split.high,
            "numPartitions": str(split.parts),
        }
    return options


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str], split: Split | None = None) -> DataFrame:
    """One table; filters and column choice reach the database."""
    return spark.read.format("jdbc").options(**read_options(url, table, properties, split)).load()


def register_tables(spark: SparkSession, url: str, tables: Mapping[str, Split | None], properties: Mapping[str, str]) -> None:
    """Reads each named table and registers it as a view of the same name."""
    register_views({name: read_table(spark, url, name, properties, split) for name, split in tables.items()})


def append_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch: int = 10_000, writers: int = 16) -> None:
    """Appends to a staging table; ``writers`` bounds the open connections."""
    writer = df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **properties)
    writer.option("batchsize", batch).option("numPartitions", writers).save()
