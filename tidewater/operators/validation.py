"""Row rules: domains, required columns, lenient parsing and visibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def when_column(df: DataFrame, column: str, step) -> DataFrame:
    """Applies ``step`` only where the column exists; a schema check, no job."""
    return step(df) if column in df.columns else df


def first_present(df: DataFrame, names: Sequence[str], alias: str) -> DataFrame:
    """One column from whichever of several source names exist; the first non-null wins."""
    present = [n for n in names if n in df.columns]
    if not present:
        raise ValueError(f"none of the columns {list(names)} is present")
    value = F.coalesce(*(F.col(f"`{n}`") for n in present))
    return df.withColumn("_picked", value).drop(*present).withColumnRenamed("_picked", alias)


def with_errors(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``_errors``: names of the rules a row breaks. A rule is the condition a valid row meets."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("_errors", F.array_compact(F.array(*broken)))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``_errors``), both from one pass over the rules."""
    checked = with_errors(df, rules)
    return checked.filter(F.size("_errors") == 0).drop("_errors"), checked.filter(F.size("_errors") > 0)


def fill_all_nulls(df: DataFrame, text: str = "-") -> DataFrame:
    """Every null becomes the text; columns of other types become text for it."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit(text)).alias(c) for c in df.columns))


def visible_to(role: str, allowed: Sequence[str]) -> Column:
    """Row policy: all rows for an allowed role, none otherwise."""
    return F.lit(role in allowed)


def not_all_equal(elements: Column) -> Column:
    return F.size(F.array_distinct(elements)) > 1


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Casts every decimal to double, also inside arrays, structs and maps."""
    from pyspark.sql import types as T

    def target(dt: T.DataType) -> T.DataType:
        if isinstance(dt, T.DecimalType):
            return T.DoubleType()
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(target(dt.elementType), dt.containsNull)
        if isinstance(dt, T.MapType):
            return T.MapType(target(dt.keyType), target(dt.valueType), dt.valueContainsNull)
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, target(f.dataType), f.nullable) for f in dt])
        return dt

    return df.select(
        *(F.col(f.name) if target(f.dataType) == f.dataType else F.col(f.name).cast(target(f.dataType)).alias(f.name)
          for f in df.schema)
    )
