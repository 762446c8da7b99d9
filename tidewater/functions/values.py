"""Expressions on numbers, arrays, maps and JSON."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_total(price: Column, quantity: Column) -> Column:
    """price x quantity in money precision; null if either is null."""
    return (price * quantity).cast("decimal(10,2)")


def units(amount: Column, decimals: int = 4) -> Column:
    """A floating amount as whole units of its last decimal, to be summed exactly.

    Sums of doubles depend on the order the partial sums arrive in; sums of whole units do
    not, so every run gives the same report. They cost little and do not overflow.
    """
    return F.rint(amount * F.lit(10.0**decimals)).cast("bigint").cast("decimal(18,0)")


def from_units(total: Column, decimals: int = 4) -> Column:
    """The amount as a double. The decimal point is moved in decimals, so only the last step rounds."""
    whole = total.cast("decimal(28,0)")
    return (whole * F.lit(Decimal(1).scaleb(-decimals))).cast("double")


def whole_number(text: Column, kind: str = "bigint") -> Column:
    """Text to an integer type, null on a bad text.

    Text that does not even begin like a number is told apart first: a failed try_cast
    raises and catches an exception inside, far dearer than this look.
    """
    return F.when(text.rlike(r"^[\x00-\x20]*[+-]?[0-9]"), text.try_cast(kind))


def speed_kmh(meters: Column, seconds: Column) -> Column:
    """0.0 where the duration is zero, negative or unknown."""
    return F.when(seconds > 0, (meters / 1000) / (seconds / 3600)).otherwise(0.0)


def amount_or_zero(amount: Column) -> Column:
    return F.coalesce(amount.cast("double"), F.lit(0.0))


def flip_between(x: Column, low: float, high: float) -> Column:
    """Changes the sign of values strictly between two bounds."""
    return F.when((x > low) & (x < high), -x).otherwise(x)


def differences(vector: Column) -> Column:
    """Next minus current element; one element shorter."""
    shifted = F.slice(vector, F.lit(2), F.greatest(F.size(vector) - 1, F.lit(0)))
    heads = F.slice(vector, F.lit(1), F.greatest(F.size(vector) - 1, F.lit(0)))
    return F.zip_with(shifted, heads, lambda b, a: b - a)


def without_empty(fields: Column) -> Column:
    """Drops map entries whose value is null or blank text."""
    return F.map_filter(fields, lambda _, v: v.isNotNull() & (v != ""))


def rename_key(fields: Column, old: str, new: str) -> Column:
    return F.transform_keys(fields, lambda k, _: F.when(k == old, F.lit(new)).otherwise(k))
