"""Rankings against Spark's own window functions, sorts and top rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import plan, rows, same_rows
from tallywork.operators import sizes
from tallywork.operators.ranking import (
    _in_ranges,
    top_groups,
    top_rows,
    value_ranks,
    with_ranks,
    with_row_numbers,
)
from tallywork.sources.tables import flights, retail


def by_window(df, keys, order):
    falling = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(order))
    running = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(
        *df.columns,
        F.rank().over(falling).cast("bigint").alias("rank"),
        F.dense_rank().over(falling).cast("bigint").alias("dense_rank"),
        F.max(order).over(running).alias("running_max"),
    )


def sales(spark):
    """One customer has a third of the rows; some amounts and customers are null."""
    number = F.col("id")
    return spark.range(6_000).select(
        F.when(number % 3 == 0, 1)
        .when(number % 41 == 0, F.lit(None))
        .otherwise(number % 50)
        .alias("customer"),
        F.when(number % 17 != 0, number * 7919 % 200 - 100).alias("amount"),
        number.alias("row"),
    )


@pytest.fixture
def large(monkeypatch):
    """Treat every input as one that reads much."""
    monkeypatch.setattr(sizes, "SMALL_INPUT_BYTES", 0)


def test_ranks_equal_those_of_a_window(spark, large):
    df = sales(spark)
    ranked = with_ranks(df, ["customer"], "amount")
    assert ranked.count() == 6_000
    assert same_rows(ranked, by_window(df, ["customer"], "amount"))


def test_little_input_is_ranked_in_one_pass(tables):
    dated = retail(tables, "customer_id", "quantity")
    ranked = with_ranks(dated, ["customer_id"], "quantity")
    assert plan(ranked, "simple").count("FileScan") == plan(dated, "simple").count("FileScan") == 2
    assert same_rows(ranked, by_window(dated, ["customer_id"], "quantity"))


@pytest.mark.parametrize("kind", ["BIGINT", "DOUBLE", "STRING", "DATE"])
def test_no_task_ranks_all_values_of_a_key(spark, large, settings, kind):
    # One key has a third of the rows, each with a value of its own; no bucket is given.
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"})
    value = {"DATE": "date_add(DATE'1900-01-01', CAST(id AS INT))"}.get(kind, f"CAST(id * 7919 % 60013 AS {kind})")
    df = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 1, id % 50) AS customer", f"if(id % 17 = 0, null, {value}) AS amount", "id AS row"
    )
    counts = df.groupBy("customer", "amount").agg(F.count("*").alias("_n"))
    ranges = _in_ranges(counts, ["customer"], "amount").groupBy("customer", "_bucket").count()
    assert ranges.where("customer = 1").count() >= 3
    assert ranges.agg(F.max("count")).first()[0] < 60_000 / 6
    assert same_rows(with_ranks(df, ["customer"], "amount"), by_window(df, ["customer"], "amount"))


def test_ranks_of_no_rows_and_of_one_key(spark, large):
    df = sales(spark)
    assert with_ranks(df.where("false"), ["customer"], "amount").collect() == []
    one = df.where("customer = 1")
    assert same_rows(with_ranks(one, ["customer"], "amount"), by_window(one, ["customer"], "amount"))


def test_ranks_in_buckets_equal_those_of_a_window(spark):
    df = sales(spark)
    bucket = F.floor(F.col("amount") / 16)
    ranked = with_ranks(df, ["customer"], "amount", bucket)
    assert same_rows(ranked, by_window(df, ["customer"], "amount"))


def test_rank_has_gaps_and_dense_rank_has_none(spark, large):
    df = spark.createDataFrame([("a", 9), ("a", 9), ("a", 5), ("b", 1)], "k string, v int")
    assert rows(with_ranks(df, ["k"], "v")) == [
        ("a", 5, 3, 2, 9),
        ("a", 9, 1, 1, 9),
        ("a", 9, 1, 1, 9),
        ("b", 1, 1, 1, 1),
    ]


def test_the_window_sees_counted_values_only(spark, large):
    text = plan(value_ranks(sales(spark), ["customer"], "amount"), "simple")
    # The counted values are read back from the ranges they were written in.
    assert "ranges-" in text and "Range (0, 6000" not in text
    in_buckets = value_ranks(sales(spark), ["customer"], "amount", F.floor(F.col("amount") / 16))
    text = plan(in_buckets, "simple")
    assert text.index("Window") < text.index("HashAggregate")


def test_top_groups_keeps_only_k_rows_per_task(tables):
    top = top_groups(flights(tables), "dest_country_name", "count", 5, "total")
    assert "TakeOrderedAndProject" in plan(top)


def test_top_rows_breaks_ties_by_the_given_columns(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "k string, v int")
    assert [tuple(r) for r in top_rows(df, "v", 3, ["k"]).collect()] == [
        ("c", 3),
        ("a", 2),
        ("b", 2),
    ]


def test_text_with_desc_is_an_alias(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "count int")
    assert [r[0] for r in df.orderBy(F.expr("count desc")).collect()] == [1, 2, 3]
    assert [r[0] for r in df.orderBy(F.desc("count")).collect()] == [3, 2, 1]


def test_sort_places_nulls(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 2), (None, 1)], "k string, v int")
    ordered = df.orderBy(F.desc("v"), F.asc_nulls_first("k")).collect()
    assert [tuple(r) for r in ordered] == [(None, 2), ("b", 2), (None, 1), ("a", 1)]
    last = df.orderBy(F.desc_nulls_last("k"), "v").collect()
    assert [r[0] for r in last] == ["b", "a", None, None]


def test_registered_sorts_are_in_order(spark, tables):
    from tallywork.plans.rows import sort_asc, sort_desc_nulls, sort_within

    prices = [r.o_totalprice for r in sort_asc(tables).collect()]
    assert prices == sorted(prices)
    quantities = [r.quantity for r in sort_desc_nulls(tables).collect()]
    assert quantities == sorted(quantities, reverse=True)
    within = sort_within(tables)
    assert "Exchange" not in plan(within)
    numbered = within.select(F.spark_partition_id().alias("p"), "l_extendedprice").collect()
    for partition in {r.p for r in numbered}:
        own = [r.l_extendedprice for r in numbered if r.p == partition]
        assert own == sorted(own)


def test_window_query_runs_on_dates_of_any_source(tables):
    dated = retail(tables, "customer_id", "invoice_ts", "quantity")
    assert dated.where("customer_id IS NULL").count() > 0


def test_row_numbers_are_those_of_a_window(spark, settings):
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(5_000).selectExpr("if(id % 3 = 0, null, id * 7919 % 100) AS a", "id AS b", "id AS _n").repartition(7, "_n")
    order = [F.desc_nulls_last("a"), "b"]
    numbered = with_row_numbers(df, order)
    assert numbered.columns == ["a", "b", "_n", "row_number"]
    window = df.withColumn("row_number", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert same_rows(numbered, window)
    assert numbered.select(F.spark_partition_id()).distinct().count() > 1
    # Read again, and from another frame built on it, the numbers are the same.
    assert same_rows(numbered.where("row_number % 10 = 0"), window.where("row_number % 10 = 0"))


def test_row_numbers_of_odd_frames(spark):
    df = spark.range(10).selectExpr("id % 2 AS a")
    assert rows(with_row_numbers(df.where("false"), ["a"])) == []
    assert rows(with_row_numbers(df, ["a"]), "row_number") == sorted([(n,) for n in range(1, 11)], key=str)
    assert rows(with_row_numbers(df.limit(1), ["a"], "n"), "n") == [(1,)]
    with pytest.raises(ValueError, match="rename"):
        with_row_numbers(df, ["a"], "a")
