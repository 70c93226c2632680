"""Sorts, top rows and rankings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.operators.sizes import reads_little
from tallywork.session import scratch_path


def top_groups(df: DataFrame, key: str, measure: str, k: int, total: str) -> DataFrame:
    """The ``k`` keys with the largest sums; equal sums are ordered by key.

    Sort and limit together keep ``k`` rows per task instead of sorting the table.
    """
    return (
        df.groupBy(key)
        .agg(F.sum(measure).alias(total))
        .orderBy(F.desc(total), F.asc(key))
        .limit(k)
    )


def top_rows(df: DataFrame, measure: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest measure; ``ties`` makes the order total."""
    return df.orderBy(F.desc(measure), *ties).limit(k)


def _join_same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Equi-join on equal names in which null equals null; the names are kept once."""
    renamed = right.withColumnsRenamed({name: f"_same_{name}" for name in names})
    same = [
        # Plain equality has half the join keys where no null is possible.
        F.col(name).eqNullSafe(F.col(f"_same_{name}"))
        if left.schema[name].nullable
        else F.col(name) == F.col(f"_same_{name}")
        for name in names
    ]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same))
    return joined.drop(*[f"_same_{name}" for name in names])


def value_ranks(
    df: DataFrame, keys: Sequence[str], order: str, bucket: Column | None = None
) -> DataFrame:
    """``rank``, ``dense_rank`` and ``running_max`` of each distinct value within its keys.

    The order is descending with nulls last. Rows are first counted per value, with map-side
    sums, so a window sorts distinct values and never rows. Where the frame reads much, the
    counted values are first cut into ranges of about equal size (see ``_in_ranges``), so that no
    task gets all values of a key that has very many.

    ``bucket`` takes the place of these ranges: an expression of the order column that never
    falls as the value rises (say ``floor(price / 100)``). Values are ranked within a bucket and
    shifted by the totals of the higher buckets.
    """
    counts = df.groupBy(*keys, order).agg(F.count("*").alias("_n"))
    if bucket is not None:
        counts = counts.withColumn("_bucket", bucket)
    elif reads_little(df):
        return _ranked_counts(counts, keys, order).drop("_n")
    else:
        counts = _in_ranges(counts, keys, order)

    local = _ranked_counts(counts, [*keys, "_bucket"], order)
    totals = counts.groupBy(*keys, "_bucket").agg(
        F.sum("_n").alias("_rows"), F.count("*").alias("_values"), F.max(order).alias("_top")
    )
    higher = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("_bucket"))
    before = higher.rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_above"),
        F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_values_above"),
        F.max("_top").over(before).alias("_max_above"),
    )
    return _join_same(local, shifts, [*keys, "_bucket"]).select(
        *keys,
        order,
        (F.col("rank") + F.col("_rows_above")).alias("rank"),
        (F.col("dense_rank") + F.col("_values_above")).alias("dense_rank"),
        F.greatest("running_max", "_max_above").alias("running_max"),
    )


def _in_ranges(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Counted values with ``_bucket``: the range of keys and values that each lies in.

    Spark draws the ranges from a sample of the values, of any type that has an order, so a key
    with very many values fills several and no caller has to know its distribution. Ranks within
    and totals above a range must agree on where it ends, so the values are written to the
    shared folder once and read from there.
    """
    ranged = counts.repartitionByRange(*keys, F.desc_nulls_last(order))
    path = scratch_path(counts.sparkSession, "ranges")
    # Ranges are numbered along the falling values; a bucket's number rises with them.
    ranged.withColumn("_bucket", -F.spark_partition_id()).write.parquet(path)
    fields = T.StructType([*counts.schema, T.StructField("_bucket", T.IntegerType())])
    return counts.sparkSession.read.schema(fields).parquet(path)


def _ranked_counts(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    falling = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
    before = falling.rowsBetween(Window.unboundedPreceding, -1)
    so_far = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        *counts.columns,
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias("rank"),
        F.row_number().over(falling).cast("bigint").alias("dense_rank"),
        F.max(order).over(so_far).alias("running_max"),
    )


def with_ranks(
    df: DataFrame, keys: Sequence[str], order: str, bucket: Column | None = None
) -> DataFrame:
    """The rows of ``df`` with the three columns of ``value_ranks``.

    Rows meet their ranks in an equi-join on keys and value, which AQE can split where one
    value is hot; a window over the rows themselves would sort each key in a single task. That
    window reads the rows once instead of twice, and is used where the frame reads little.
    """
    if bucket is None and reads_little(df):
        return _ranked_rows(df, keys, order)
    return _join_same(df, value_ranks(df, keys, order, bucket), [*keys, order])


def _ranked_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    falling = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
    so_far = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        *df.columns,
        F.rank().over(falling).cast("bigint").alias("rank"),
        F.dense_rank().over(falling).cast("bigint").alias("dense_rank"),
        F.max(order).over(so_far).alias("running_max"),
    )


def with_row_numbers(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """The rows with their consecutive numbers, from 1, in a total order of the whole frame.

    A window without keys would sort everything in one task. Here the rows are sorted in ranges
    over all tasks and written to the shared folder with their place, so that a repeated task
    cannot number them anew; only the ranges' sizes meet, in the driver, one number for each.
    Rows that are equal in ``order`` are numbered in any order. Names of columns must not start
    with ``_place``.
    """
    if name in df.columns or "_place" in df.columns:
        raise ValueError(f"rename before numbering: {name} or _place")
    path = scratch_path(df.sparkSession, "numbered")
    # The upper bits of a place hold the range's number, the lower 33 count its rows from 0.
    df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    fields = T.StructType([*df.schema, T.StructField("_place", T.LongType())])
    placed = df.sparkSession.read.schema(fields).parquet(path)
    part = F.shiftright("_place", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*")).collect())
    starts = accumulate((n for _, n in sizes[:-1]), initial=1)
    first = df.sparkSession.createDataFrame(
        [(p, start) for (p, _), start in zip(sizes, starts)], "_place_part long, _place_start long"
    )
    numbered = placed.join(F.broadcast(first), part == F.col("_place_part"))
    within = F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    return numbered.select(*df.columns, (F.col("_place_start") + within).alias(name))
