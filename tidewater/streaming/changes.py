"""Change-feed batches into dimensions, facts and an audit log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.dates import try_us_date
from tidewater.functions.text import full_name
from tidewater.operators.joins import not_in
from tidewater.operators.warehouse import audit_row
from tidewater.streaming.logs import read_if_present

FEED_SCHEMA = (
    "passenger_id string, first_name string, last_name string, gender string, age string, nationality string, "
    "airport_name string, country_name string, airport_continent string, departure_date string, "
    "flight_status string, ticket_type string, _action string"
)


class FlightWarehouse:
    """Loads one batch of flight changes into every table, or into none.

    Each batch writes its own folder of each table and, last, its audit row. Only batches
    with an audit row are read back, and a repeated batch overwrites its own folders, so a
    batch that failed half-way leaves nothing behind.
    """

    TABLES = ("dim_passengers", "dim_airports", "fact_flights")

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base

    def audit_log(self) -> DataFrame | None:
        return read_if_present(self.spark, f"{self.base}/audit_log")

    def table(self, name: str, before: int | None = None) -> DataFrame | None:
        """Committed rows of a table, of all batches or of those before one."""
        stored, log = read_if_present(self.spark, f"{self.base}/{name}"), self.audit_log()
        if stored is None or log is None:
            return None
        committed = log.select("batch").distinct()
        rows = stored.join(committed, "batch", "left_semi")
        return (rows if before is None else rows.filter(F.col("batch") < before)).drop("batch")

    def process(self, feed: DataFrame, batch_id: int) -> str:
        """One batch of the feed; returns a status text."""
        if feed.isEmpty():
            return "No data in stream"
        rows = feed.filter("_action = 'INSERT'").persist()
        try:
            passengers = rows.select(
                "passenger_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name"), "gender", "age",
                "nationality",
            ).distinct()
            airports = rows.select(
                "airport_name", "country_name", F.col("airport_continent").alias("continent")
            ).distinct()
            facts = rows.select(
                "passenger_id", "airport_name", try_us_date(F.col("departure_date")).alias("departure_date"),
                "flight_status", "ticket_type", F.current_timestamp().alias("load_timestamp"),
            )
            self._write("dim_passengers", self._unknown("dim_passengers", passengers, "passenger_id", batch_id), batch_id)
            self._write("dim_airports", self._unknown("dim_airports", airports, "airport_name", batch_id), batch_id)
            counted = Observation()
            self._write("fact_flights", facts.observe(counted, F.count("*").alias("n")), batch_id)
            inserted = counted.get["n"]
        finally:
            rows.unpersist()
        self._write("audit_log", audit_row(self.spark, "PROCESS_FLIGHTS", inserted, "INSERT_FACTS"), batch_id)
        return f"Processed Successfully. Facts inserted: {inserted}"

    def _unknown(self, name: str, members: DataFrame, key: str, batch_id: int) -> DataFrame:
        known = self.table(name, before=batch_id)
        return members if known is None else not_in(members, known, key, key)

    def _write(self, name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.base}/{name}/batch={batch_id}")

    def start(self, feed: DataFrame, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
        """Loads the feed batch by batch; the default trigger ends when all is read."""

        def load(batch: DataFrame, batch_id: int) -> None:
            self.process(batch, batch_id)

        writer = feed.writeStream.foreachBatch(load)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
