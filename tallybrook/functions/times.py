"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds as TIMESTAMP."""
    return F.timestamp_millis(ms)


def day(ts: Column) -> Column:
    """``yyyy-MM-dd`` in the session time zone."""
    return F.date_format(ts, "yyyy-MM-dd")


def hour(ts: Column) -> Column:
    """Two-digit hour of day."""
    return F.date_format(ts, "HH")


def minute(ts: Column) -> Column:
    """Two-digit minute."""
    return F.date_format(ts, "mm")


def date_of_text(text: Column) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def hour_of_text(text: Column) -> Column:
    """Hour part of ``yyyy-MM-dd HH:mm:ss`` text; null if there is no time part."""
    clock = F.split_part(text, F.lit(" "), F.lit(2))
    return F.nullif(F.split_part(clock, F.lit(":"), F.lit(1)), F.lit(""))


def statement_time(ts: Column) -> Column:
    """Stamp of a result row, ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
