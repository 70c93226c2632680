"""Sketches of frequent values, filled by every task from its own rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_GROUPS = 64  # sketches are merged in so many tasks before they meet in one


def frequent_estimates(df: DataFrame, columns: dict[str, Column], k: int, tracked: int) -> DataFrame:
    """``column_name``, ``item`` and ``estimate``: the ``k`` most frequent values of each column.

    Columns must be of one type. A task's memory and what it sends are bounded by ``tracked``,
    however many values there are. A value with a share above about 3.5 / ``tracked`` is not
    missed, an estimate is never below the true count, and none is reported that does not occur.
    Nulls count like a value. No rows give no rows.
    """
    names = {name: f"_sketch_{i}" for i, name in enumerate(columns)}
    made = df.select(*[c.alias(f"_value_{i}") for i, c in enumerate(columns.values())])
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_part")
    filled = made.groupBy(part).agg(
        *[F.expr(f"approx_top_k_accumulate(_value_{i}, {tracked})").alias(s) for i, s in enumerate(names.values())]
    )
    # Grouped by a constant: without groups, tasks with no sketch would fail.
    merged = filled.groupBy(F.lit(0).alias("_all")).agg(
        *[F.expr(f"approx_top_k_combine({s}, {tracked})").alias(s) for s in names.values()]
    )
    found = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.expr(f"approx_top_k_estimate({s}, {k})").alias("items"))
            for name, s in names.items()
        ]
    )
    by_column = merged.select(F.inline(found))
    return by_column.select("column_name", F.inline("items")).withColumnRenamed("count", "estimate")
