"""Date and time expressions; the current date is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.values import whole_number


def whole_years(start: Column, end: Column) -> Column:
    """Completed years; someone born on 29 February completes a year on 1 March."""
    return F.timestamp_diff("YEAR", start, end)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))) / 3600


def us_date(text: Column) -> Column:
    """month/day/year with one or two digits; a bad text is an error."""
    return F.to_date(text, "M/d/yyyy")


def try_us_date(text: Column) -> Column:
    """The same, null on a bad text."""
    return F.try_to_date(text, "M/d/yyyy")


def epoch_seconds(text: Column) -> Column:
    """Unix seconds to a timestamp, null on a bad text."""
    return F.timestamp_seconds(whole_number(text))


def month_back(as_of: Column, months: int) -> Column:
    """First day of the month that many months earlier."""
    return F.trunc(F.add_months(as_of, -months), "MM")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
