"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what stays is letters, digits, underscore, blanks and . , ? ! -
SPECIAL_CHARS = r"(?U)[^\p{L}\p{N}_\s.,?!-]"
TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def clean_text(text: Column) -> Column:
    return F.regexp_replace(text, SPECIAL_CHARS, "")


def clean_text_column(df: DataFrame, column: str) -> DataFrame:
    """Cleans a column if it exists and holds text; anything else passes through."""
    if column in df.columns and df.schema[column].dataType.typeName() == "string":
        return df.withColumn(column, clean_text(F.col(column)))
    return df


def tokens(*texts: Column) -> Column:
    """Lower-case words of the texts, without stemming; may begin and end with an empty one."""
    return F.split(F.lower(F.concat_ws(" ", *texts)), TOKEN_BREAK)


def has_all_terms(words: Column, terms: Sequence[str]) -> Column:
    """True where every term is among the words of a stored token column."""
    wanted = sorted({t.lower() for t in terms})
    return F.size(F.array_intersect(F.array(*(F.lit(t) for t in wanted)), words)) == len(wanted)


def mentions_all_terms(terms: Sequence[str], *texts: Column) -> Column:
    """The same on the texts themselves: each term is sought as a whole word, no word list is built."""
    lowered = F.lower(F.concat_ws(" ", *texts))
    found = F.lit(True)
    for term in terms:
        if not term.isalnum():
            raise ValueError(f"a term is one word of letters and digits: {term!r}")
        found = found & lowered.rlike(rf"(?<![\p{{L}}\p{{N}}]){term.lower()}(?![\p{{L}}\p{{N}}])")
    return found


def proper(text: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2**31 - 1)))


def full_name(first: Column, last: Column) -> Column:
    """Null if either part is null."""
    return F.concat(first, F.lit(" "), last)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share)
