"""Bike trip metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.values import speed_kmh
from tidewater.operators.validation import first_present

# Column names of the trip files
DEPARTURE_NAMES = ("departure", "Departure time")
RENAMES = {
    "duration (sec.)": "duration_raw",
    "distance (m)": "distance_raw",
    "Air temperature (degC)": "temp_raw",
    "departure_name": "station_dep",
    "return_name": "station_ret",
}


def clean_trips(raw: DataFrame) -> DataFrame:
    """Typed trips from the all-text file columns, with the speed."""
    named = first_present(raw.withColumnsRenamed(RENAMES), DEPARTURE_NAMES, "departure_time_raw")
    return named.withColumns(
        {
            "date": F.to_timestamp("departure_time_raw"),
            "distance": F.col("distance_raw").cast("float"),
            "duration": F.col("duration_raw").cast("float"),
            "temperature": F.col("temp_raw").cast("float"),
        }
    ).withColumn("speed_kmh", speed_kmh(F.col("distance"), F.col("duration")))


def daily_metrics(trips: DataFrame) -> DataFrame:
    """Means and trip count per day; trips without a date form a group of their own."""
    return trips.groupBy(F.date_format("date", "yyyy-MM-dd").alias("Date")).agg(
        F.avg("distance").alias("AvgDistance"),
        F.avg("duration").alias("AvgDuration"),
        F.avg("speed_kmh").alias("AvgSpeed"),
        F.avg("temperature").alias("AvgTemp"),
        F.count("*").alias("TripCount"),
    )


def station_counts(trips: DataFrame, station: str, name: str) -> DataFrame:
    """Trips per station; a missing station is a group."""
    return trips.groupBy(station).agg(F.count("*").alias(name))


def chart_feed(daily: DataFrame, measure: str = "AvgTemp") -> DataFrame:
    """Sum of a measure per date; text with a decimal comma is accepted."""
    value = F.regexp_replace(F.col(measure).cast("string"), ",", ".").cast("double")
    return daily.groupBy("Date").agg(F.sum(value).alias(measure))
