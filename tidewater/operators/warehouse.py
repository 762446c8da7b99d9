"""Warehouse loads: what to insert, update, close or reject, as DataFrames.

Loads return only the rows to append plus the rejected rows, so a large target is read
for its keys and never rewritten by an insert.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.ranking import first_per_key

# Keys that are numbered together, about; a row of a list of bucket sizes for each bucket
NUMBERED = 100_000
REPEATS = 10_000


@dataclass(frozen=True)
class Load:
    """Rows to append and rows turned away by the load rule."""

    inserted: DataFrame
    rejected: DataFrame

    def applied_to(self, target: DataFrame) -> DataFrame:
        return target.unionByName(self.inserted)


def _no_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def _repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as a column says, without one long array for a row that is repeated very often."""
    runs = df.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / REPEATS))))
    last = F.least(F.lit(REPEATS), F.col(times) - F.col("_run") * REPEATS)
    return runs.withColumn("_one", F.explode(F.sequence(F.lit(1).cast("bigint"), last))).drop("_run", "_one", times)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Load:
    """Insert on a primary key: present rows win, the first of the batch (in ``order``) enters.

    Every other row is rejected, so inserted and rejected rows make up the batch; rows with a null key
    are rejected too, as a primary key demands. Equal rows are counted first and rejected by number.
    """
    rows = batch.groupBy(*batch.columns).agg(F.count("*").alias("_n"))
    first = first_per_key(rows.filter(_no_null(keys)).drop("_n"), keys, [*order, *(c for c in batch.columns if c not in order)])
    known = target.select(*keys).distinct()
    inserted = first.join(known, list(keys), "left_anti").select(*batch.columns)
    whole = F.struct(*batch.columns)
    winners = inserted.select(*keys, whole.alias("_winner"))
    entered = F.coalesce(whole.eqNullSafe(F.col("_winner")), F.lit(False)).cast("bigint")
    turned = rows.join(winners, list(keys), "left").withColumn("_n", F.col("_n") - entered).filter("_n > 0")
    return Load(inserted, _repeated(turned, "_n").select(*batch.columns))


def insert_ignore_unique(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                         nulls_equal: bool = False) -> DataFrame:
    """Insert on a composite unique constraint; returns the rows to append.

    A key with a null part conflicts with nothing, so all such rows enter, unless
    ``nulls_equal`` treats null as a value.
    """
    if nulls_equal:
        first = first_per_key(batch, keys, order)
        renamed = target.select(*(F.col(k).alias(f"_t_{k}") for k in keys)).distinct()
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys))
        return first.join(renamed, same, "left_anti")
    first = first_per_key(batch.filter(_no_null(keys)), keys, order)
    fresh = first.join(target.select(*keys).distinct(), list(keys), "left_anti").select(*batch.columns)
    return fresh.unionByName(batch.filter(~_no_null(keys)))


def surrogate_keys(df: DataFrame, keys: Sequence[str], name: str, start: int | Column = 0,
                   bucket: Column | None = None, buckets: int | None = None) -> DataFrame:
    """Numbers unique natural keys densely from ``start + 1``, the same on every run.

    Numbering in one global order is one task. Keys are numbered inside buckets (a hash of
    the key by default) and shifted by the sizes of the lower buckets, so the only table a
    single task sees is the list of bucket sizes, at most one row per bucket. The number of
    buckets is part of the numbering; by default it follows the number of rows, which is counted.
    """
    if bucket is None and buckets is None:
        buckets = 1 + df.count() // NUMBERED
    if bucket is None:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    bucketed = df.withColumn("_bucket", F.coalesce(bucket, F.lit(-1)))
    lower = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size")).select(
        "_bucket", F.coalesce(F.sum("_size").over(lower), F.lit(0)).alias("_shift")
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        bucketed.withColumn("_place", place).join(shifts, "_bucket")
        .withColumn(name, (first + F.col("_shift") + F.col("_place")).cast("bigint"))
        .drop("_bucket", "_place", "_shift")
    )


def fk_load(target: DataFrame, batch: DataFrame, keys: Sequence[str], parent: DataFrame, fk: str, parent_key: str,
            order: Sequence[str]) -> Load:
    """Insert-ignore that also needs a parent row; a null foreign key is allowed."""
    parents = parent.select(F.col(parent_key).alias("_p")).distinct()
    checked = batch.join(parents, F.col(fk) == F.col("_p"), "left")
    valid = F.col("_p").isNotNull() | F.col(fk).isNull()
    load = insert_ignore(target, checked.filter(valid).drop("_p"), keys, order)
    return Load(load.inserted, load.rejected.unionByName(checked.filter(~valid).drop("_p")))


def placeholder_members(dim: DataFrame, facts: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Stand-in members for fact keys the dimension does not know."""
    unseen = facts.filter(F.col(key).isNotNull()).select(key).distinct().join(dim.select(key), key, "left_anti")
    return unseen.select(key, *(F.lit(v).alias(c) for c, v in defaults.items()))


def overwrite_attribute(dim: DataFrame, batch: DataFrame, key: str, attribute: str, order: Sequence[str],
                        current: Column | None = None, stamp: tuple[str, Column] | None = None) -> DataFrame:
    """Type 1 change: current members take the batch's value where it differs.

    Of several batch rows that differ from a member the first in ``order`` counts. A null on
    either side does not differ. ``stamp`` sets a last-update column on changed rows.
    """
    present = F.lit(True) if current is None else F.coalesce(current, F.lit(False))
    members = dim.filter(present).select(F.col(key).alias("_key"), F.col(attribute).alias("_old")).distinct()
    differing = batch.join(members, (F.col(key) == F.col("_key")) & (F.col(attribute) != F.col("_old")))
    first = first_per_key(differing, ["_key", "_old"], order).select("_key", "_old", F.col(attribute).alias("_new"))
    joined = dim.join(first, present & (F.col(key) == F.col("_key")) & (dim[attribute] == F.col("_old")), "left")
    changes = F.col("_new").isNotNull()
    if stamp:
        joined = joined.withColumn(stamp[0], F.when(changes, stamp[1]).otherwise(F.col(stamp[0])))
    return joined.withColumn(attribute, F.when(changes, F.col("_new")).otherwise(F.col(attribute))).select(*dim.columns)


def new_members(dim: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Distinct batch rows whose key the dimension lacks (NOT EXISTS)."""
    return batch.distinct().join(dim.select(key).distinct(), key, "left_anti").select(*batch.columns)


def append_new_facts(facts: DataFrame, batch: DataFrame, source_id: str) -> DataFrame:
    """Batch rows not loaded before, by source row id; rows without an id always enter."""
    return batch.join(facts.select(source_id).distinct(), source_id, "left_anti").select(*batch.columns)


def versioned_dimension(dim: DataFrame, batch: DataFrame, key: str, attributes: Sequence[str], as_of: Column,
                        order: Sequence[str]) -> DataFrame:
    """Type 2 change: closes changed current rows, opens their successors, adds new members.

    ``dim`` has the key, the attributes, ``valid_from``, ``valid_to`` and ``is_current``. A batch row
    without a key names no member and is left out.
    """
    incoming = first_per_key(batch.filter(_no_null([key])), [key], order).select(key, F.struct(*attributes).alias("_new"))
    current = F.coalesce("is_current", F.lit(False))
    closed_type = dim.schema["valid_to"].dataType

    def version(values: Column, valid_from: Column, valid_to: Column, is_current: Column) -> Column:
        return F.struct(
            F.col(key),
            *(values[a].alias(a) for a in attributes),
            valid_from.cast(dim.schema["valid_from"].dataType).alias("valid_from"),
            valid_to.cast(closed_type).alias("valid_to"),
            is_current.alias("is_current"),
        )

    members = dim.filter(current).select(key, F.struct(*attributes).alias("_old"), "valid_from", "valid_to")
    joined = members.join(incoming, key, "full")
    opens = F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))
    before = version(F.col("_old"), F.col("valid_from"), F.when(opens, as_of).otherwise(F.col("valid_to")), ~opens)
    after = version(F.col("_new"), as_of, F.lit(None), F.lit(True))
    rows = F.array_compact(F.array(F.when(F.col("_old").isNotNull(), before), F.when(opens, after)))
    versions = joined.select(F.inline(rows))
    return versions.unionByName(dim.filter(~current).select(*versions.columns))


def lookup_facts(staged: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str]]],
                 columns: dict[str, Column]) -> DataFrame:
    """Fact rows: staged rows joined to dimensions by name and projected; unknown members drop the row."""
    for dim, on in lookups:
        staged = staged.join(dim, list(on))
    return staged.select(*(c.alias(n) for n, c in columns.items()))


def audit_row(spark, procedure: str, affected: int, operation: str, at: Column | None = None) -> DataFrame:
    return spark.range(1).select(
        F.lit(procedure).alias("procedure_name"),
        F.lit(affected).cast("bigint").alias("affected_rows"),
        F.lit(operation).alias("operation_type"),
        (F.current_timestamp() if at is None else at).alias("logged_at"),
    )


def calendar(first: Column, last: Column, spark, padded: bool = True) -> DataFrame:
    """One row per day with its calendar parts; names blank-padded to 9 unless told otherwise."""
    days = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_key"))

    def named(pattern: str) -> Column:
        text = F.date_format("date_key", pattern)
        return F.rpad(text, 9, " ") if padded else text

    return days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter"),
        F.month("date_key").alias("month_num"),
        named("MMMM").alias("month_name"),
        named("EEEE").alias("day_name"),
        F.extract(F.lit("DOW_ISO"), F.col("date_key")).alias("day_of_week"),
    )


def integrity_report(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One row per check with the number of violations."""
    parts = [frame.agg(F.lit(name).alias("check_name"), F.count("*").alias("violations")) for name, frame in checks]
    return reduce(DataFrame.unionAll, parts)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(_no_null(keys)).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(~_no_null(keys))


def orphans(child: DataFrame, fk: str, parent: DataFrame, parent_key: str) -> DataFrame:
    known = parent.select(F.col(parent_key).alias("_p")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("_p"), "left_anti")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of one (table_name, cnt) row per frame."""
    return reduce(
        DataFrame.unionAll,
        (f.agg(F.lit(n).alias("table_name"), F.count("*").alias("cnt")) for n, f in frames.items()),
    )


def publish(df: DataFrame, base: str, version: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Writes a table version to a folder of its own and returns it as read back.

    A version never overwrites the files its plan reads; pass the same version to repeat
    a failed write. Rows are rebalanced by the partition columns first: adaptive execution
    gives a small partition one file and splits a large one over tasks.
    """
    path = f"{base}/version={version}"
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def clear(df: DataFrame, path: str) -> None:
    """Truncate: an empty table of the same schema."""
    df.limit(0).write.mode("overwrite").parquet(path)


class StoredView:
    """A view defined now and filled by ``refresh`` (created without data)."""

    def __init__(self, name: str, plan: Callable[[], DataFrame], base: str):
        self.name, self.plan, self.base = name, plan, base

    def refresh(self, version: str) -> DataFrame:
        stored = publish(self.plan(), f"{self.base}/{self.name}", version)
        stored.createOrReplaceTempView(self.name)
        return stored
