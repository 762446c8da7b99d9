"""Review rows: nulls filled, sorted, text cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import clean_text_column
from tidewater.operators.validation import fill_all_nulls, when_column


def clean_reviews(rows: DataFrame) -> DataFrame:
    """Ready for a document store. Equal dates are ordered by all columns, which spreads them."""
    filled = fill_all_nulls(rows)
    ordered = when_column(
        filled, "created_date", lambda df: df.orderBy(F.asc_nulls_last("created_date"), *(c for c in df.columns if c != "created_date"))
    )
    return clean_text_column(ordered, "content")
