"""Pieces the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import shared_folder

#: ASCII white space, the only thing that separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text as an array; null counts as no text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    The lineage ends there, so a lost executor costs no more than the tasks after it, and Spark
    knows the size of what it reads.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written in this context gives its shuffle files back as soon as it is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns alone, so that further columns of the input can't clash with ours."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
