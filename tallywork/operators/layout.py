"""Partitions and caching."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def partitions_for(df: DataFrame, rows: int, at_least: int = 1) -> int:
    """How many partitions of about ``rows`` rows the frame fills. Counts it once.

    ``at_least`` keeps all cores busy on a table that fills few.
    """
    return max(at_least, -(-df.count() // rows))


SAMPLE_SHARE = 0.02  # of the rows, whose widths stand for all


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as text."""
    return F.octet_length(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def text_bytes(df: DataFrame, share: float = SAMPLE_SHARE) -> int:
    """About how many bytes the rows take as text, from the widths of a share of them.

    Which rows are measured follows from their hash, so that the same frame gives the same size.
    """
    width = row_bytes(df)
    hashed = [F.col(f"`{f.name}`") for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    drawn = F.pmod(F.xxhash64(*hashed), F.lit(10_000)) < int(share * 10_000)
    rows, measured, widths = df.agg(
        F.count("*"), F.count_if(drawn), F.coalesce(F.sum(F.when(drawn, width)), F.lit(0))
    ).first()
    if not measured:  # too few rows for a share: all of them
        widths, measured = df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0], max(rows, 1)
    return round(widths * rows / measured)


def partitions_for_bytes(df: DataFrame, target: int = 128 * 1024 * 1024, at_least: int = 1) -> int:
    """How many partitions of about ``target`` bytes the frame fills, wide rows or narrow."""
    return max(at_least, -(-text_bytes(df) // target))


def spread(df: DataFrame, column: str, partitions: int | None = None, salts: int = 1) -> DataFrame:
    """Bring equal values together, while a hot value may still fill several partitions.

    Without a number AQE sizes the partitions and splits the large ones. With a number,
    ``salts`` says over how many partitions one value may spread.
    """
    if partitions is None:
        return df.hint("rebalance", column)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    return df.repartition(partitions, column, salt)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition, to see skew; counted inside the tasks."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for several uses and release it afterwards; it spills to disk."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
