"""Trip metrics: an event is a trip, its type the departure station, its user the return station."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import trips as tr
from tidewater.registry import query
from tidewater.sinks.routing import routed_items

TRIPS_SQL = """(SELECT ts AS date, event_type AS station_dep, CAST(user_id AS VARCHAR) AS station_ret,
    CAST(value AS FLOAT) AS duration, CAST(json_extract_string(props, '$.k') AS FLOAT) AS distance,
    CAST(value AS FLOAT) AS temperature FROM events)"""


def trips(t):
    raw = t.events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("departure"),
        F.col("event_type").alias("departure_name"),
        F.col("user_id").cast("string").alias("return_name"),
        F.col("value").cast("string").alias("duration (sec.)"),
        F.get_json_object("props", "$.k").alias("distance (m)"),
        F.col("value").cast("string").alias("Air temperature (degC)"),
    )
    return tr.clean_trips(raw)


@query(
    f"""SELECT strftime(date, '%Y-%m-%d') AS "Date", round(avg(distance), 4) AS "AvgDistance",
               round(avg(duration), 4) AS "AvgDuration",
               round(avg(CASE WHEN duration > 0 THEN (distance::DOUBLE / 1000) / (duration::DOUBLE / 3600) ELSE 0.0 END), 4) AS "AvgSpeed",
               round(avg(temperature), 4) AS "AvgTemp", CAST(count(*) AS BIGINT) AS "TripCount"
        FROM {TRIPS_SQL} GROUP BY 1"""
)
def daily_metrics(t):
    means = ("AvgDistance", "AvgDuration", "AvgSpeed", "AvgTemp")
    return tr.daily_metrics(trips(t)).withColumns({c: F.round(c, 4) for c in means})


@query(f'SELECT station_dep, CAST(count(*) AS BIGINT) AS "DepCount" FROM {TRIPS_SQL} GROUP BY 1')
def dep_counts(t):
    return tr.station_counts(trips(t), "station_dep", "DepCount")


@query(f'SELECT station_ret, CAST(count(*) AS BIGINT) AS "RetCount" FROM {TRIPS_SQL} GROUP BY 1')
def ret_counts(t):
    return tr.station_counts(trips(t), "station_ret", "RetCount")


@query(
    f"""SELECT "Date", round(sum(a), 4) AS "AvgTemp" FROM (
          SELECT strftime(date, '%Y-%m-%d') AS "Date", avg(temperature) AS a FROM {TRIPS_SQL} GROUP BY 1) GROUP BY 1"""
)
def chart_feed(t):
    return tr.chart_feed(tr.daily_metrics(trips(t))).withColumn("AvgTemp", F.round("AvgTemp", 4))


@query(
    """SELECT target, coalesce(nullif(station, ''), 'Unknown') AS station, CAST(sum(n) AS BIGINT) AS n FROM (
         SELECT 'DeparturesData' AS target, nullif(event_type, 'view') AS station, count(*) AS n FROM events GROUP BY ALL
         UNION ALL SELECT 'ReturnsData', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY ALL)
       GROUP BY ALL"""
)
def route_target(t):
    known = trips(t).withColumn("station_dep", F.expr("nullif(station_dep, 'view')"))
    departures = tr.station_counts(known, "station_dep", "n").select(
        F.lit("bucket/metrics/departures/part.csv").alias("source_path"), "station_dep", F.lit(None).cast("string").alias("station_ret"), "n"
    )
    returns = tr.station_counts(known, "station_ret", "n").select(
        F.lit("bucket/metrics/returns/part.csv").alias("source_path"), F.lit(None).cast("string").alias("station_dep"), "station_ret", "n"
    )
    elsewhere = departures.withColumn("source_path", F.lit("bucket/raw/part.csv"))
    items = routed_items(departures.unionByName(returns).unionByName(elsewhere))
    return items.select("target", F.col("item")["StationName"].alias("station"), F.col("item")["n"].cast("bigint").alias("n"))
