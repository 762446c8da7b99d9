"""A stored table in key buckets, changed bucket by bucket, with versions.

``data/v=7/bucket=12`` holds what version 7 wrote to bucket 12; files are never changed. The manifest has
one file per version with a row for each bucket it touched: the versions whose folders make up the bucket
from then on. That file is written last, in one piece, and is what makes a version exist, so a write
that fails before leaves the table as it was. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import warehouse as wh

#: Keys of a batch that are broadcast to the table; a larger batch is joined by shuffle.
BROADCAST_KEYS = 1_000_000

_MANIFEST = "version long, bucket int, folders array<long>, rows string"


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 256):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # -- versions

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def version(self) -> int:
        """The newest version, 0 for a table that is not there."""
        manifest = self._manifest()
        return (manifest.agg(F.max("version")).first()[0] or 0) if manifest is not None else 0

    def _state(self, version: int | None) -> tuple[dict[int, list[int]], T.StructType]:
        """The folders of each bucket as of a version, and the schema of the rows."""
        manifest = self._manifest()
        rows = [] if manifest is None else manifest.filter(F.col("version") <= version if version else F.lit(True)).collect()
        if not rows:
            raise LookupError(f"no version {version or ''} of {self.path}")
        newest = {}
        for row in sorted(rows, key=lambda r: r["version"]):
            newest[row["bucket"]] = row["folders"]
        schema = T.StructType.fromJson(json.loads(rows[0]["rows"]))
        return newest, schema

    def _read(self, folders: dict[int, list[int]], schema: T.StructType) -> DataFrame:
        paths = [f"{self.path}/data/v={v}/bucket={b}" for b, versions in sorted(folders.items()) for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        laid_out = T.StructType([*schema.fields, T.StructField("v", T.LongType()), T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(laid_out).option("basePath", f"{self.path}/data").parquet(*paths)
        return rows.select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest or of an earlier version."""
        return self._read(*self._state(version))

    def _publish(self, rows: DataFrame, folders: Callable[[int, int], list[int]], hit: Sequence[int] | None = None) -> int:
        """Writes ``rows`` as a new version; ``folders`` gives those of a bucket. Without rows a hit bucket has none of its own."""
        version = self.version() + 1
        schema = rows.schema
        rows.withColumn("bucket", self.bucket()).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v={version}")
        laid_out = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        written = self.spark.read.schema(laid_out).parquet(f"{self.path}/data/v={version}")
        filled = {r["bucket"] for r in written.select("bucket").distinct().collect()}
        entries = [(version, b, folders(b, version) if b in filled else folders(b, 0), schema.json()) for b in sorted(filled.union(hit or ()))]
        if not entries:  # an empty table
            entries = [(version, 0, [], schema.json())]
        entries = [(n, b, [v for v in f if v], s) for n, b, f, s in entries]
        self.spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return version

    # -- changes

    def create(self, rows: DataFrame) -> int:
        """The first version, or a version that replaces all buckets."""
        hit = range(self.buckets) if self.version() else ()
        # a bucket is written by one task, so it is one file
        return self._publish(rows.repartition(self.buckets, self.bucket()), lambda b, v: [v], hit)

    def hit(self, batch: DataFrame) -> list[int]:
        """The buckets that the keys of a batch lie in."""
        return sorted(r[0] for r in batch.select(self.bucket()).distinct().collect())

    def _touched(self, target: DataFrame, batch: DataFrame, how: str) -> DataFrame:
        """The target's rows with (``left_semi``) or without (``left_anti``) a key of the batch; the target is not shuffled."""
        keys = batch.select(*self.keys).distinct()
        if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        return target.join(keys, self.keys, how).select(*target.columns)

    def parts(self, batch: DataFrame) -> tuple[list[int], DataFrame, DataFrame]:
        """The buckets a batch hits, and their rows with and without a key of the batch."""
        folders, schema = self._state(None)
        hit = self.hit(batch)
        target = self._read({b: folders[b] for b in hit if b in folders}, schema)
        return hit, self._touched(target, batch, "left_semi"), self._touched(target, batch, "left_anti")

    def merge(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replaces the rows that share a key with ``batch`` by ``change(rows, batch)``; only hit buckets are written.

        ``change`` may add rows of the batch's keys and must return the columns of the table.
        """
        hit, rows, rest = self.parts(batch)
        if not hit:
            return self.version()
        changed = change(rows, batch).select(*rest.columns)
        return self._publish(rest.unionByName(changed), lambda b, v: [v], hit)

    def add(self, batch: DataFrame, load: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Adds ``load(rows that share a key with the batch, batch)``; a bucket gets a folder more, nothing is rewritten."""
        hit, rows, _ = self.parts(batch)
        if not hit:
            return self.version()
        folders, _ = self._state(None)
        return self._publish(load(rows, batch).select(*rows.columns), lambda b, v: [*folders.get(b, []), v])

    def insert_ignore(self, batch: DataFrame, order: Sequence[str]) -> int:
        """``warehouse.insert_ignore`` on the stored table."""
        return self.add(batch, lambda rows, new: wh.insert_ignore(rows, new, self.keys, order).inserted)

    def overwrite_attribute(self, batch: DataFrame, attribute: str, order: Sequence[str], **options) -> int:
        """``warehouse.overwrite_attribute`` (type 1) on the stored table."""
        return self.merge(batch, lambda rows, new: wh.overwrite_attribute(rows, new, self.keys[0], attribute, order, **options))

    def new_versions(self, batch: DataFrame, attributes: Sequence[str], as_of: Column, order: Sequence[str]) -> int:
        """``warehouse.versioned_dimension`` (type 2) on the stored table."""
        return self.merge(batch, lambda rows, new: wh.versioned_dimension(rows, new, self.keys[0], attributes, as_of, order))
