"""Aggregations beyond a plain ``groupBy``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallywork.operators.sketches import frequent_estimates

AGGREGATES = {
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "max": F.max,
    "min": F.min,
    "stddev_pop": F.stddev_pop,
    "stddev_samp": F.stddev_samp,
    "sum": F.sum,
    "sum_distinct": F.sum_distinct,
    "var_pop": F.var_pop,
    "var_samp": F.var_samp,
}


def aggregate_pairs(
    df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]]
) -> DataFrame:
    """Aggregates given as (column, function name) pairs, named ``<function>_<column>``.

    A list of pairs, unlike a dict, may name one column several times.
    """
    columns = [AGGREGATES[name](column).alias(f"{name}_{column}") for column, name in pairs]
    return df.groupBy(*keys).agg(*columns)


def count_distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows without a null in any column, as SQL's ``COUNT(DISTINCT *)``."""
    return df.na.drop().distinct().agg(F.count("*").alias("distinct_rows"))


def distinct_estimate(df: DataFrame, column: str, rsd: float) -> DataFrame:
    """Estimated distinct count: one small sketch per task is all that is shuffled."""
    return df.agg(F.approx_count_distinct(column, rsd).alias("estimate"))


def first_last(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """The column's value on the first and the last row of a stated order."""
    position = F.struct(*order)
    return df.agg(
        F.min_by(column, position).alias(f"first_{column}"),
        F.max_by(column, position).alias(f"last_{column}"),
    )


def value_lists(
    df: DataFrame, keys: Sequence[str], value: str, position: str, width: int
) -> DataFrame:
    """All values per key (``values``), by position and without nulls.

    ``position`` is a unique whole number. A list covers ``width`` positions, numbered by
    ``chunk``, and so never holds more than ``width`` values however large the key is. The
    lists of a key in chunk order are its whole list.
    """
    # Whole-number arithmetic: large positions would lose digits as doubles.
    chunk = F.expr(f"(`{position}` - pmod(`{position}`, {width})) div {width}").alias("chunk")
    pairs = F.when(F.col(value).isNotNull(), F.struct(position, value))
    return (
        df.groupBy(*keys, chunk)
        .agg(F.array_sort(F.collect_list(pairs)).alias("_pairs"))
        .select(*keys, "chunk", F.col(f"_pairs.{value}").alias("values"))
    )


def value_sets(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per key in one sorted ``value_set``, nulls left out.

    Values are made distinct before they are collected, so a key with very many rows comes to
    its task as its few values.
    """
    distinct = df.select(*keys, value).distinct()
    return distinct.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("value_set"))


def _level_sums(
    df: DataFrame, keys: Sequence[str], measure: str, kind: str, combine_first: bool
) -> DataFrame:
    if combine_first:
        df = df.groupBy(*keys).agg(F.sum(measure).alias(measure))
    grouped = df.rollup(*keys) if kind == "rollup" else df.cube(*keys)
    return grouped.agg(
        F.grouping_id().alias("level"), F.sum(measure).alias(f"total_{measure}")
    )


def rollup_sums(
    df: DataFrame, keys: Sequence[str], measure: str, combine_first: bool = True
) -> DataFrame:
    """Sums of every leading part of the keys down to the grand total.

    ``level`` is the grouping id, which tells a subtotal's null from a null in the data.
    Every row is multiplied by the number of levels. ``combine_first`` sums to the full keys
    before that, which pays where many rows share their keys; switch it off where few do, as
    it costs a shuffle.
    """
    return _level_sums(df, keys, measure, "rollup", combine_first)


def cube_sums(
    df: DataFrame, keys: Sequence[str], measure: str, combine_first: bool = True
) -> DataFrame:
    """As ``rollup_sums`` for every subset of the keys."""
    return _level_sums(df, keys, measure, "cube", combine_first)


OTHER = "other"


def _listed(column: str, values: Sequence) -> tuple[Column, list[str]]:
    """The column's value as text if it is listed, else ``other``; and all these names."""
    names = [str(v) for v in values]
    if OTHER in names:
        raise ValueError(f"the name {OTHER!r} is for values that are not listed")
    text = F.col(column).cast("string")
    return F.when(text.isin(names), text).otherwise(OTHER), [*names, OTHER]


def pivot_sums(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence, measures: Sequence[str]
) -> DataFrame:
    """Values become columns named ``<value>_sum_<measure>``.

    Nulls and values that are not listed add up in ``other_sum_<measure>``, so a row of columns
    always has the whole total. For an open set of values group by it and leave it long.
    """
    place, names = _listed(column, values)
    sums = [F.sum(measure).alias(f"sum_{measure}") for measure in measures]
    wide = df.withColumn("_place", place).groupBy(*keys).pivot("_place", names).agg(*sums)
    if len(measures) > 1:
        return wide
    # With one aggregate Spark names the column by the value alone.
    return wide.withColumnsRenamed({v: f"{v}_sum_{measures[0]}" for v in names})


def pair_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """The long form of a crosstab: ``row``, ``column`` and ``n``, for any number of values."""
    return df.groupBy(row, column).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Pair counts with one column per value, zero where a pair does not occur.

    Nulls and values that are not listed count as ``other``. Complete for any number of rows;
    Spark's own ``crosstab`` gathers its table in the driver.
    """
    place, names = _listed(column, values)
    counted = pair_counts(df.withColumn("_place", place), row, "_place")
    wide = counted.groupBy(row).pivot("_place", names).agg(F.sum("n"))
    return wide.na.fill(0, subset=names)


def frequent_items(df: DataFrame, columns: Sequence[str], support: float = 0.01) -> DataFrame:
    """Values found in at least ``support`` of all rows: ``column_name``, ``item``, ``n``.

    Exact, where Spark's ``freqItems`` may add false positives, and nulls count as a value. Two
    passes: sketches of bounded size name every value that may be frequent, at most some
    2 / ``support`` a column; then only these are counted. Counting all values at once would
    shuffle each distinct one.
    """
    total = df.select(F.count("*")).scalar()
    texts = {name: F.col(name).cast("string") for name in columns}
    # A frequent value is estimated at the support or more, another one only if its true share
    # lies within the sketch's error of it, less than half the support.
    k, tracked = math.ceil(2 / support), math.ceil(8 / support)
    likely = frequent_estimates(df, texts, k, tracked).where(F.col("estimate") >= F.lit(support) * total)
    likely = F.broadcast(likely.select(F.col("column_name").alias("_name"), F.col("item").alias("_item")))
    same = (F.col("column_name") == F.col("_name")) & F.col("item").eqNullSafe(F.col("_item"))
    return (
        df.select(*[text.alias(name) for name, text in texts.items()])
        .unpivot([], list(columns), "column_name", "item")
        .join(likely, same, "left_semi")
        .groupBy("column_name", "item")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= F.lit(support) * total)
    )


def describe_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column (all by default): count, mean, sample deviation, least and greatest.

    A single pass over the data. Mean and deviation are null but for numbers; least and
    greatest are text as the columns differ in type.
    """
    nothing = F.lit(None).cast("double")
    facts = []
    for field in df.select(*(columns or df.columns)).schema:
        name, is_number = field.name, isinstance(field.dataType, NumericType)
        facts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(name).alias("n"),
                (F.avg(name) if is_number else nothing).alias("mean"),
                (F.stddev_samp(name) if is_number else nothing).alias("stddev"),
                F.min(name).cast("string").alias("least"),
                F.max(name).cast("string").alias("greatest"),
            )
        )
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def moments(column: str | Column) -> dict[str, Column]:
    """Spread and shape of one column; skewness and kurtosis are the population forms."""
    return {
        "var_pop": F.var_pop(column),
        "var_samp": F.var_samp(column),
        "stddev_pop": F.stddev_pop(column),
        "stddev_samp": F.stddev_samp(column),
        "skewness": F.skewness(column),
        "kurtosis": F.kurtosis(column),
    }
