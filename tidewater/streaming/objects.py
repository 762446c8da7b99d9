"""Arriving metric files routed to their target tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.sinks.routing import routed_items
from tidewater.sources.files import DELIMITED, from_objects


def metric_files(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    """Rows of the CSV files that arrive anywhere under a folder, with their path."""
    reader = spark.readStream.schema(columns).options(**DELIMITED).option("enforceSchema", True)
    files = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(folder)
    return from_objects(files, suffix=".csv")


def route(rows: DataFrame, base: str, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Writes each micro-batch to one folder per target; a repeated batch overwrites its own.

    The default trigger ends when all is read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        items = routed_items(batch).withColumn("batch", F.lit(batch_id))
        for_batch = items.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        for_batch.partitionBy("target", "batch").json(base)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
