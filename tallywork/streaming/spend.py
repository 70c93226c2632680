"""Spend per customer and day; the same code runs on a table and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.dates import day_window
from tallywork.functions.numbers import money


def daily_spend(
    events: DataFrame, customer: str, time: str, cost: str, watermark: str | None = None
) -> DataFrame:
    """Summed cost by customer and one-day window: customer, ``day``, ``total_cost``.

    Without a watermark every group stays in the state, as fits a finite input. With one, a
    window is dropped once it is that far behind, as an endless stream needs. Sums are exact
    decimals, so they do not depend on how the rows fall into micro-batches.
    """
    rows = events.select(customer, F.col(time).alias("_time"), money(F.col(cost)).alias("_cost"))
    if watermark:
        # Watermarks are defined on timestamps with a zone only.
        rows = rows.withColumn("_time", F.col("_time").cast("timestamp"))
        rows = rows.withWatermark("_time", watermark)
    return (
        rows.groupBy(customer, day_window(F.col("_time")).alias("_day"))
        .agg(F.sum("_cost").alias("total_cost"))
        .select(customer, F.col("_day.start").alias("day"), "total_cost")
    )
