"""Object-created notifications wrapped in queue messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORDS = "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
STRICT = {"mode": "FAILFAST"}


def created_objects(messages: DataFrame, body: str = "body") -> DataFrame:
    """(bucket, key) of every object a message announces.

    The body holds the event itself or, as text, in its ``Message`` field. Bodies that are
    not JSON fail the query; bodies without records give no rows; files of running jobs
    are skipped. Keys are URL-decoded.
    """
    envelope = F.from_json(body, f"Message string, {RECORDS}", STRICT)
    inner = F.from_json(F.col("_e.Message"), RECORDS, STRICT)
    records = messages.withColumn("_e", envelope).select(
        F.explode(F.when(F.col("_e.Message").isNotNull(), inner["Records"]).otherwise(F.col("_e.Records"))).alias("_r")
    )
    objects = records.select(
        F.col("_r.s3.bucket.name").alias("bucket"), F.url_decode(F.col("_r.s3.object.key")).alias("key")
    )
    return objects.filter(~F.col("key").contains("_temporary") & ~F.col("key").contains("_SUCCESS"))
