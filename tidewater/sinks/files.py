"""Writers: reports as JSON or XML, CSV files, monthly splits, documents."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.dates import month_label
from tidewater.operators.validation import decimals_to_double
from tidewater.session import shared_folder


def write_json(df: DataFrame, path: str, name: str) -> None:
    """A report of any size: one JSON object per line."""
    decimals_to_double(df).write.mode("overwrite").json(f"{path}/{name}")


def write_xml(df: DataFrame, path: str, name: str) -> None:
    """A report of any size: an element per row under the report root."""
    plain = decimals_to_double(df)
    plain.write.mode("overwrite").format("xml").option("rootTag", name).option("rowTag", "item").save(f"{path}/{name}")


EXPORTERS: dict[str, Callable[[DataFrame, str, str], None]] = {"json": write_json, "xml": write_xml}


def exporter(kind: str) -> Callable[[DataFrame, str, str], None]:
    if kind not in EXPORTERS:
        raise ValueError(f"unsupported format: {kind}")
    return EXPORTERS[kind]


def export_reports(reports: Mapping[str, DataFrame], path: str, kind: str) -> None:
    """One folder per report."""
    write = exporter(kind)
    for name, df in reports.items():
        write(df, path, name)


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """The files of a written folder that are not empty, in the order of the rows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().startswith("part-") and f.getLen())


def join_parts(spark: SparkSession, folder: str, target: str) -> None:
    """The parts of a document as one file, for who needs one: copied in order by this process, some KB at a time."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(target)
    out = path.getFileSystem(conf).create(path, True)
    try:
        for name in _parts(spark, folder):
            source = hadoop.fs.Path(name).getFileSystem(conf).open(hadoop.fs.Path(name))
            try:
                hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            finally:
                source.close()
    finally:
        out.close()


def _combined(reports: Mapping[str, DataFrame], path: str, row: Callable[[DataFrame], Column], around: Callable[[str], tuple[str, str]],
              ends: tuple[str, str], between: str) -> None:
    """One document of all reports: the parts of the folder, in the order of their names.

    Rows are numbered in their order and written down first, so that the number a row has stays; the
    least number of a report says which of its rows no separator goes before. Then rows and the texts
    around them are sorted by report and number, which Spark does by ranges: no process sees all rows.
    """
    spark = next(iter(reports.values())).sparkSession
    staging = f"{shared_folder(spark)}/combined-{uuid.uuid4().hex}"
    last = 2**63 - 1
    texts = [(-1, -1, ends[0])]
    for number, (name, df) in enumerate(reports.items()):
        plain = decimals_to_double(df)
        lines = plain.select(F.lit(number).alias("report"), F.monotonically_increasing_id().alias("at"), row(plain).alias("text"))
        lines.write.mode("append").parquet(staging)
        opened, closed = around(name)
        texts += [(number, -1, (between if number else "") + opened), (number, last, closed)]
    texts.append((len(reports), 0, ends[1]))
    schema = "report int, at long, text string"
    rows = spark.read.schema(schema).parquet(staging)
    # one row per report
    first = F.broadcast(rows.groupBy("report").agg(F.min("at").alias("first")))
    parted = rows.join(first, "report").select("report", "at", F.when(F.col("at") > F.col("first"), F.concat(F.lit(between), "text")).otherwise(F.col("text")).alias("text"))
    document = parted.unionByName(spark.createDataFrame(texts, schema)).orderBy("report", "at")
    document.select(F.col("text").alias("value")).write.mode("overwrite").text(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(staging)
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def combined_json(reports: Mapping[str, DataFrame], path: str) -> None:
    """Reports as one document ``{report: [rows]}``, whose parts are the files of a folder; rows keep the order of their frame."""
    def row(df: DataFrame) -> Column:
        return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})

    _combined(reports, path, row, lambda name: (f"{json.dumps(name, ensure_ascii=False)}:[", "]"), ("{", "}"), ",")


def combined_xml(reports: Mapping[str, DataFrame], path: str, root: str = "student_analysis") -> None:
    """Reports as one document, whose parts are the files of a folder: the root holds an element per report, with an ``item`` per row."""
    def row(df: DataFrame) -> Column:
        return F.to_xml(F.struct(*df.columns), {"rowTag": "item"})

    _combined(reports, path, row, lambda name: (f"<{name}>", f"</{name}>"), (f"<{root}>", f"</{root}>"), "")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; one file only on request, since one file means one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def split_by_month(df: DataFrame, ts: Column, path: str) -> None:
    """One folder per calendar month (``month=yyyy-MM``) with the original columns.

    Rows are rebalanced by month: a small month is one file, a large one several.
    """
    monthly = df.withColumn("month", month_label(ts)).hint("rebalance", "month")
    monthly.write.mode("overwrite").partitionBy("month").option("header", True).csv(path)


def documents(df: DataFrame) -> DataFrame:
    """Each row as one JSON document in a ``value`` column; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_documents(df: DataFrame, path: str) -> None:
    documents(df).write.mode("overwrite").text(path)


def insert_documents(df: DataFrame, insert_many: Callable[[list[str]], None], batch: int = 1000) -> None:
    """Hands documents to a store's bulk insert, in batches, from the executors.

    A retried task repeats its batches, so ``insert_many`` should be idempotent.
    """

    def send(rows):
        pending = []
        for row in rows:
            pending.append(row.value)
            if len(pending) == batch:
                insert_many(pending)
                pending = []
        if pending:
            insert_many(pending)

    documents(df).foreachPartition(send)
