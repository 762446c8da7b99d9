"""Readers for the file shapes the projects receive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One named option set for delimited loads: quoted fields, one header line
DELIMITED = {"sep": ",", "quote": '"', "escape": '"', "header": "true"}

# Columns of the SDK log, in file order
LOG_COLUMNS = (
    "error_code", "error_message", "severity", "log_location", "mode", "model", "graphics", "session_id", "sdkv",
    "test_mode", "flow_id", "flow_type", "sdk_date", "publisher_id", "game_id", "bundle_id", "appv", "language", "os",
    "adv_id", "gdpr", "ccpa", "country_code", "date",
)
LATIN_GAP = "".join(map(chr, range(0x80, 0xA0)))


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array over many lines. Such a file is not splittable: one task each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """Files of one JSON value per line; an array on a line gives one row per element."""
    return spark.read.schema(schema).json(glob)


def read_typed_csv(spark: SparkSession, path: str, schema: str | None = None, timestamp_format: str | None = None) -> DataFrame:
    """CSV with header. Without a schema the types are inferred by an extra pass over the file."""
    reader = spark.read.options(**DELIMITED)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "utf-8") -> DataFrame:
    """CSV with header, every column text; ``columns`` imposes the staging names by position."""
    reader = spark.read.options(**DELIMITED).option("encoding", encoding)
    if columns:
        return reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    return reader.csv(path)


def read_csv_any_encoding(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 text CSV, or windows-1252 when some line is not valid UTF-8."""
    if spark.read.text(path).filter(~F.is_valid_utf8("value")).isEmpty():
        return read_text_csv(spark, path)
    # the reader knows ISO-8859-1, which differs from windows-1252 in 0x80 to 0x9F only
    latin = read_text_csv(spark, path, encoding="iso-8859-1")
    meant = bytes(range(0x80, 0xA0)).decode("windows-1252", errors="replace")
    renamed = str.maketrans(LATIN_GAP, meant)
    return latin.select(*(F.translate(f"`{c}`", LATIN_GAP, meant).alias(c.translate(renamed)) for c in latin.columns))


def overlong(line: Column) -> Column:
    """True for a line with more fields than log columns: its commas, those in quotes aside, tell.

    A doubled quote inside quotes reads as two quoted runs side by side, which drops the same commas.
    """
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(F.regexp_replace(unquoted, "[^,]", "")) >= len(LOG_COLUMNS)


def parse_log(lines: DataFrame) -> DataFrame:
    """Log rows from text lines, all columns text; a line is a record. Files go through ``read_log``.

    Lines with too many fields and blank lines are dropped; short lines stay, padded with
    null. (The CSV reader marks long and short lines alike, hence the look at the text.)
    """
    fitting = lines.filter((F.trim("value") != "") & ~overlong(F.col("value")))
    schema = ", ".join(f"{c} string" for c in LOG_COLUMNS)
    return fitting.select(F.from_csv("value", schema, {"quote": '"', "escape": '"'}).alias("_l")).select("_l.*")


def overlong_log_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(overlong(F.col("value")))


# The reader keeps the text of records with too many or too few fields beside them
LOG_SCHEMA = ", ".join(f"{c} string" for c in (*LOG_COLUMNS, "_unfitting"))
LOG_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": "_unfitting"}


def fitting_records(records: DataFrame) -> DataFrame:
    """Log rows from records read with ``LOG_SCHEMA`` and ``LOG_OPTIONS``, by the rules of ``parse_log``."""
    text = F.col("_unfitting")
    dropped = overlong(text) | (F.trim(F.regexp_replace(text, "[\r\n]", "")) == "")
    # always true; Spark refuses a query, such as a count, that needs no field of a record
    read = F.coalesce(F.length(LOG_COLUMNS[0]), F.lit(0)) >= 0
    return records.filter((text.isNull() | ~dropped) & read).select(*LOG_COLUMNS)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A headerless SDK log with imposed column names; quoted fields may hold line breaks.

    For their sake a file is read by one task. ``records.read_log_ranges`` reads large files by many.
    """
    return fitting_records(spark.read.schema(LOG_SCHEMA).options(**LOG_OPTIONS).csv(path))


def read_vector(spark: SparkSession, path: str) -> DataFrame:
    """Numbers separated by commas, blanks allowed around them: (pos, value)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    cells = lines.select(F.posexplode(F.split("value", ",")).alias("pos", "cell"))
    return cells.select("pos", F.trim("cell").cast("double").alias("value"))


def is_empty(spark: SparkSession, path: str) -> bool:
    """True for a file without rows; a file that cannot be read counts as empty."""
    try:
        return read_text_csv(spark, path).isEmpty()
    except PySparkException:
        return True


def from_objects(df: DataFrame, prefix: str = "", suffix: str = "") -> DataFrame:
    """Rows of the objects whose path matches; files a running job left behind are skipped.

    ``df`` must come straight from a file source, batch or streaming.
    """
    path = F.col("_metadata.file_path")
    wanted = path.contains(prefix) & path.endswith(suffix)
    return df.withColumn("source_path", path).filter(wanted & ~path.contains("_temporary") & ~path.contains("_SUCCESS"))
