"""Dates and times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_or_null(text: Column, pattern: str | None = None) -> Column:
    """Text as a date; null where it does not fit the pattern (ISO by default)."""
    return F.try_to_date(text, pattern) if pattern else F.try_to_date(text)


def as_date(df: DataFrame, name: str, pattern: str | None = None) -> Column:
    """A date from a text, date or timestamp column; the pattern matters for text only."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return date_or_null(F.col(name), pattern)
    return F.col(name).cast("date")


def as_timestamp(df: DataFrame, name: str, pattern: str | None = None) -> Column:
    """A timestamp from a text, date or timestamp column; the pattern matters for text only."""
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.col(name)
        return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
    return F.col(name).cast("timestamp")


def later_than(date: Column, text: str) -> Column:
    """``date > text``; a text that is no date compares as null, so no row passes."""
    return date > F.try_to_date(F.lit(text))


def weekday(time: Column) -> Column:
    """Full English day name."""
    return F.date_format(time, "EEEE")


def day_window(time: Column) -> Column:
    """Tumbling one-day bucket as a struct of start and end; same in batch and stream."""
    return F.window(time, "1 day")
