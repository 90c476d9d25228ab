"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the accepted e-mail syntax, tested on trimmed lower-case text.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def is_email(column: Column) -> Column:
    """Whether the value looks like an e-mail address; NULL stays NULL."""
    return column.rlike(EMAIL_PATTERN)


def capitalise(column: Column) -> Column:
    """First letter upper case, the rest lower case (inner words untouched)."""
    rest = column.substr(F.lit(2), F.length(column))
    return F.concat(F.upper(column.substr(1, 1)), F.lower(rest))


def words(column: Column) -> Column:
    """Split on a single blank; two blanks in a row give an empty word."""
    return F.split(column, " ", -1)


def tokens(column: Column) -> Column:
    """Distinct lower-case search tokens: runs of letters and digits."""
    parts = F.split(F.lower(column), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(parts, lambda t: t != ""))


def null_tokens(df: DataFrame, string_token: str = "null", other_token: str = "null") -> DataFrame:
    """All columns as text, NULL replaced by one token per kind of column."""
    exportable = [f for f in df.schema if not isinstance(f.dataType, T.BinaryType)]
    return df.select(
        *[
            F.coalesce(
                F.col(f"`{f.name}`").cast("string"),
                F.lit(string_token if isinstance(f.dataType, T.StringType) else other_token),
            ).alias(f.name)
            for f in exportable
        ]
    )
