"""Text, number and time expressions shared by both data flows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed

# Every character that counts as white space at the ends of a text. Plain
# trim() only removes blanks.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def sql_text(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def as_text(col: Column) -> Column:
    """Any scalar as text, null as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def non_empty(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def clean_name(col: Column) -> Column:
    """Replace characters a list item may not hold, then squeeze blanks."""
    spaced = F.regexp_replace(col, fixed.INVALID_NAME_CHARACTERS, " ")
    return strip(F.regexp_replace(spaced, " {2,}", " "))


def epoch_ms_text(col: Column) -> Column:
    """Epoch milliseconds as UTC ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.timestamp_millis(col), "yyyy-MM-dd HH:mm:ss")


def epoch_s_iso(col: Column) -> Column:
    """Epoch seconds as UTC ``yyyy-MM-ddTHH:mm:ssZ``."""
    return F.date_format(F.timestamp_seconds(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def load_id(event_ms: Column, index: Column) -> Column:
    """Event second followed by the nine-digit index."""
    second = ((event_ms - event_ms % 1000) / 1000).cast("long")
    return F.concat(second.cast("string"), F.lpad(index.cast("string"), 9, "0"))


def record_id(
    model_id: Column, date_time: Column, user: Column, description: Column, ordinal: Column
) -> Column:
    """Sixteen hex digits that identify one row of one export."""
    source = F.concat_ws(":", model_id, date_time, user, description, ordinal.cast("string"))
    return F.substring(F.sha2(source, 256), 1, 16)


def flag(col: Column) -> Column:
    """A boolean as 1/0."""
    return col.cast("int")
