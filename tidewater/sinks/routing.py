"""Rows to target tables by the path they came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.values import without_empty

# Path part to target table, first match wins; station column per target
TARGETS = (
    ("metrics/daily", "DailyMetrics"),
    ("metrics/departures", "DeparturesData"),
    ("metrics/returns", "ReturnsData"),
)
STATIONS = {"DeparturesData": "station_dep", "ReturnsData": "station_ret"}


def target_table(path: Column) -> Column:
    """Target of a path, null for an unknown one."""
    target = F.lit(None).cast("string")
    for part, table in reversed(TARGETS):
        target = F.when(path.contains(part), table).otherwise(target)
    return target


def without_key(fields: Column, name: str) -> Column:
    return F.map_filter(fields, lambda k, _: k != name)


def routed_items(rows: DataFrame, path: str = "source_path") -> DataFrame:
    """(target, item): the non-empty fields of each row that has a target.

    Station counts name their station ``StationName``; a missing or blank one is 'Unknown'.
    """
    routed = rows.withColumn("target", target_table(F.col(path))).filter(F.col("target").isNotNull())
    names = [c for c in rows.columns if c != path]
    pairs = [x for c in names for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    item = without_empty(F.create_map(*pairs))
    for table, station in STATIONS.items():
        if station in names:
            value = F.coalesce(F.when(F.col(station) != "", F.col(station)), F.lit("Unknown"))
            others = without_key(item, station)
            named = F.map_concat(others, F.create_map(F.lit("StationName"), value))
            item = F.when(F.col("target") == table, named).otherwise(item)
    return routed.select("target", item.alias("item"))


def write_routed(rows: DataFrame, base: str, mode: str = "append", path: str = "source_path") -> None:
    """One folder of JSON items per target."""
    routed_items(rows, path).write.mode(mode).partitionBy("target").json(base)
