"""SDK log files as a stream: read once, parsed, counted, checked by the alert rules."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.dates import epoch_seconds
from tidewater.operators.alerts import ALERT_COLUMNS, KeySpikeRule, Rule, SpikeRule, write_alerts
from tidewater.operators.rolling import micros
from tidewater.operators.validation import require_columns
from tidewater.sources.files import LOG_OPTIONS, LOG_SCHEMA, fitting_records
from tidewater.sources.records import parse_records, records, text_lines

REQUIRED = ("severity", "date", "bundle_id")
LOGGER = logging.getLogger(__name__)


def log_stream(spark: SparkSession, folder: str, archive: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """New ``.csv`` files of a folder, each read once; with ``archive``, moved there when done."""
    reader = spark.readStream.schema(LOG_SCHEMA).options(**LOG_OPTIONS).option("pathGlobFilter", "*.csv")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return fitting_records(reader.csv(folder))


def log_line_stream(spark: SparkSession, folder: str, archive: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """The lines of new ``.csv`` files by byte ranges, for :meth:`AlertStream.start_lines`."""
    options = {"pathGlobFilter": "*.csv"}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if files_per_batch:
        options |= {"maxFilesPerTrigger": files_per_batch}
    return text_lines(spark, folder, stream=True, **options)


def clean_log(rows: DataFrame, metrics: str | None = "log_quality") -> DataFrame:
    """Parses the Unix-seconds ``date`` and drops rows without one; counts both as observed metrics.

    Spark reports such metrics batch by batch and keeps the last reports only; ``AlertStream`` keeps totals.
    """
    require_columns(rows, REQUIRED)
    parsed = rows.withColumn("date", epoch_seconds(F.col("date")))
    if metrics:
        parsed = parsed.observe(
            metrics,
            F.count("*").alias("rows_total"),
            F.count_if(F.col("date").isNull()).alias("rows_dropped_invalid_date"),
        )
    return parsed.filter(F.col("date").isNotNull())


class AlertStream:
    """Exact alert rules over a stream, whatever way the files cut the events.

    Each micro-batch is checked together with the tail: events that are younger than the widest
    window plus the allowed lateness, counted back from the newest event that is not ahead of the
    clock, and all events of the last ``patience`` batches. So a wrong time stamp in the future moves
    nothing, and one among older logs that are replayed can't push out what has just arrived.

    Tail, alerts and counters are written per batch under ``base`` (a shared folder); a repeated
    batch overwrites its own output. A count seen in an early batch can only grow, so the largest is
    the exact one. Tails take turns in two folders.
    """

    def __init__(
        self, base: str, rules: Sequence[Rule] = (SpikeRule(), KeySpikeRule()), lateness_us: int = 0, patience: int = 100
    ):
        self.base = base
        self.rules = list(rules)
        self.horizon_us = max(r.width_us for r in self.rules) + lateness_us
        self.patience = patience
        self.columns = sorted({c for r in self.rules for c in (r.ts, r.severity_col, getattr(r, "key", r.ts))})
        self.wanted = reduce(or_, (F.col(r.severity_col) == r.severity for r in self.rules))
        self.times = sorted({r.ts for r in self.rules})

    def process(self, batch: DataFrame, batch_id: int, counts: dict[str, int] | None = None) -> dict[str, str]:
        """One micro-batch; returns the errors of rules that could not be applied."""
        spark = batch.sparkSession
        fresh = batch.select(*self.columns).filter(self.wanted).withColumn("_batch", F.lit(batch_id))
        tail = read_if_present(spark, f"{self.base}/tail/{(batch_id - 1) % 2}") if batch_id else None
        events = (fresh if tail is None else fresh.unionByName(tail)).persist()
        try:
            now = F.unix_micros(F.current_timestamp())
            newest = events.agg(*(F.max(F.when(micros(t) <= now, micros(t))).alias(t) for t in self.times)).first()
            young = [micros(t) > F.lit(newest[t]) - F.lit(self.horizon_us) for t in self.times if newest[t] is not None]
            recent = F.col("_batch") > F.lit(batch_id - self.patience)
            events.filter(reduce(or_, young, recent)).write.mode("overwrite").parquet(f"{self.base}/tail/{batch_id % 2}")
            raised, errors = write_alerts(events.drop("_batch"), self.rules, f"{self.base}/alerts/batch={batch_id}")
        finally:
            events.unpersist()
        row = {"files_processed": 0, "rows_total": 0, "rows_dropped_invalid_date": 0} | (counts or {})
        row |= {"alerts_raised": raised, "rule_errors": len(errors)}
        counted = spark.range(1).select(*(F.lit(n).cast("long").alias(k) for k, n in row.items()))
        counted.write.mode("overwrite").json(f"{self.base}/counters/batch={batch_id}")
        return errors

    def start(self, rows: DataFrame, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
        """Checks a stream of log rows as ``log_stream`` gives them; the default trigger ends when all is read.

        ``trigger={"processingTime": "1 minute"}`` keeps watching the folder.
        """
        require_columns(rows, REQUIRED)
        named = rows.withColumn("_file", F.input_file_name())

        def check(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                clean = clean_log(batch, metrics=None)
                total, files = batch.agg(F.count("*"), F.count_distinct("_file")).first()
                counts = {"files_processed": files, "rows_total": total, "rows_dropped_invalid_date": total - clean.count()}
                for rule, error in self.process(clean, batch_id, counts).items():
                    LOGGER.error("rule %s failed on batch %s: %s", rule, batch_id, error)
            finally:
                batch.unpersist()

        writer = named.writeStream.foreachBatch(check)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def start_lines(self, lines: DataFrame, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
        """:meth:`start` for a stream of ``log_line_stream``: a large file is parsed by many tasks."""

        def check(batch: DataFrame, batch_id: int) -> None:
            rows = parse_records(records(batch)).persist()
            try:
                clean, total = clean_log(rows, metrics=None), rows.count()
                files = batch.agg(F.count_distinct("file")).first()[0]
                counts = {"files_processed": files, "rows_total": total, "rows_dropped_invalid_date": total - clean.count()}
                for rule, error in self.process(clean, batch_id, counts).items():
                    LOGGER.error("rule %s failed on batch %s: %s", rule, batch_id, error)
            finally:
                rows.unpersist()

        writer = lines.writeStream.foreachBatch(check)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def counters(self, spark: SparkSession) -> dict[str, int]:
        """Files, rows, dropped rows, alerts and rule errors of all batches; an alert counts in each batch that raises it."""
        sums = spark.read.json(f"{self.base}/counters").drop("batch")
        return sums.agg(*(F.sum(c).alias(c) for c in sums.columns)).first().asDict()

    def alerts(self, spark: SparkSession) -> DataFrame:
        """All alerts so far: one per minute of a global rule, one per key of a keyed rule."""
        found = spark.read.parquet(f"{self.base}/alerts")
        moment = F.when(F.col("key").isNull(), F.col("ts"))
        return (
            found.groupBy("rule", "key", moment.alias("_minute"))
            .agg(F.min("ts").alias("ts"), F.max("n").alias("n"), F.max_by("message", "n").alias("message"))
            .select(*ALERT_COLUMNS)
        )


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def sliding_counts(events: DataFrame, ts: str, width: str, step: str, lateness: str, keys: Sequence[str] = ()) -> DataFrame:
    """Counts per sliding window, emitted when the watermark closes it.

    An approximation of the rolling rules with engine-managed state: windows start at
    multiples of ``step``, so a burst is seen with that granularity. Rows older than the
    watermark are dropped and counted in the query progress.
    """
    grouped = events.withWatermark(ts, lateness).groupBy(F.window(ts, width, step), *keys)
    return grouped.count().select(F.col("window.end").alias("window_end"), *keys, F.col("count").alias("n"))


def without_repeats(events: DataFrame, key: str, ts: str, lateness: str) -> DataFrame:
    """The first event of each id within the watermark (a fact table's primary key)."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])
