"""Null handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_present(*columns: Column) -> Column:
    """First non-null value as text, whatever the types of the columns."""
    return F.coalesce(*[column.cast("string") for column in columns])
