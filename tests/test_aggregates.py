"""Aggregates against brute force, with nulls and hot keys."""

import math
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from support import plan, rows, same_rows
from tallywork.functions.numbers import money_sum, number_or_null
from tallywork.operators.aggregates import (
    aggregate_pairs,
    count_distinct_rows,
    crosstab,
    cube_sums,
    describe_long,
    distinct_estimate,
    first_last,
    frequent_items,
    moments,
    pair_counts,
    pivot_sums,
    rollup_sums,
    value_lists,
    value_sets,
)

VALUES = [3, -1, 4, 1, -5, 9, 2, 6, None, 5]


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame([(v,) for v in VALUES], "v int")


@pytest.fixture
def sales(spark):
    data = [
        ("d1", "x", 1), ("d1", "x", 2), ("d1", "y", 4), ("d2", "x", 8), ("d2", None, 16),
    ]
    return spark.createDataFrame(data, "day string, country string, quantity int")


def test_moments(numbers):
    known = [v for v in VALUES if v is not None]
    found = numbers.agg(*[c.alias(n) for n, c in moments("v").items()]).first().asDict()
    mean, n = statistics.fmean(known), len(known)
    m2, m3, m4 = (sum((v - mean) ** p for v in known) / n for p in (2, 3, 4))
    assert math.isclose(found["var_pop"], statistics.pvariance(known))
    assert math.isclose(found["var_samp"], statistics.variance(known))
    assert math.isclose(found["stddev_pop"], statistics.pstdev(known))
    assert math.isclose(found["stddev_samp"], statistics.stdev(known))
    assert math.isclose(found["skewness"], m3 / m2**1.5)
    assert math.isclose(found["kurtosis"], m4 / m2**2 - 3)


def test_sample_variance_of_one_value_is_null(spark):
    one = spark.createDataFrame([(1,)], "v int").agg(F.var_samp("v"), F.var_pop("v")).first()
    assert tuple(one) == (None, 0.0)


def test_money_sums_are_exact(spark):
    cents = spark.range(1, 1001).select((F.col("id") / 100).alias("v"))
    assert cents.agg(money_sum(F.col("v"))).first()[0] == 5005.0


def test_distinct_rows_leave_out_rows_with_a_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "b")], "n int, s string")
    assert count_distinct_rows(df).first()[0] == 2
    df.createOrReplaceTempView("some_rows")
    assert spark.sql("SELECT count(DISTINCT *) FROM some_rows").first()[0] == 2
    assert df.distinct().count() == 3


def test_estimate_is_within_its_error(spark):
    df = spark.range(20_000).select((F.col("id") % 4070).alias("code"))
    estimate = distinct_estimate(df, "code", 0.1)
    assert abs(estimate.first()[0] - 4070) <= 0.3 * 4070
    # One exchange, of sketches: nothing is grouped by the values.
    assert plan(estimate, "simple").count("Exchange") == 1


def test_first_and_last_by_a_stated_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, s string").repartition(3)
    assert tuple(first_last(df, "s", ["n"]).first()) == ("a", "c")


def test_pairs_may_repeat_a_column(sales):
    found = aggregate_pairs(sales, ["day"], [("quantity", "avg"), ("quantity", "stddev_pop")])
    assert found.columns == ["day", "avg_quantity", "stddev_pop_quantity"]
    assert rows(found)[1] == ("d2", 12.0, 4.0)


def test_correlation_ignores_ids_that_are_no_numbers(spark):
    data = [("1", 2.0), ("2", 4.0), ("C3", 100.0), ("4", 8.0)]
    df = spark.createDataFrame(data, "invoice string, quantity double")
    assert math.isclose(
        df.agg(F.corr(number_or_null(F.col("invoice")), "quantity")).first()[0], 1.0
    )


@pytest.mark.parametrize("combine_first", [True, False])
def test_cube_tells_subtotals_from_data_nulls(sales, combine_first):
    found = rows(cube_sums(sales, ["day", "country"], "quantity", combine_first))
    assert found == sorted(
        [
            ("d1", "x", 0, 3), ("d1", "y", 0, 4), ("d2", "x", 0, 8), ("d2", None, 0, 16),
            ("d1", None, 1, 7), ("d2", None, 1, 24),
            (None, "x", 2, 11), (None, "y", 2, 4), (None, None, 2, 16),
            (None, None, 3, 31),
        ],
        key=lambda row: [(v is not None, str(v)) for v in row],
    )


@pytest.mark.parametrize("combine_first", [True, False])
def test_rollup_has_leading_keys_only(sales, combine_first):
    found = rollup_sums(sales, ["day", "country"], "quantity", combine_first)
    levels = Counter(row.level for row in found.collect())
    assert levels == {0: 4, 1: 2, 3: 1}
    built_in = sales.rollup("day", "country").agg(F.sum("quantity").alias("total_quantity"))
    assert same_rows(found.drop("level"), built_in)


def test_pivot_names_and_nulls(sales):
    wide = pivot_sums(sales, ["day"], "country", ["x", "y"], ["quantity"])
    assert wide.columns == ["day", "x_sum_quantity", "y_sum_quantity", "other_sum_quantity"]
    assert rows(wide) == [("d1", 3, 4, None), ("d2", 8, None, 16)]
    two = sales.withColumn("lines", F.lit(1))
    wide = pivot_sums(two, ["day"], "country", ["x"], ["quantity", "lines"])
    names = ["x_sum_quantity", "x_sum_lines", "other_sum_quantity", "other_sum_lines"]
    assert wide.columns == ["day", *names]
    assert rows(wide) == [("d1", 3, 2, 4, 1), ("d2", 8, 1, 16, 1)]


def test_unlisted_values_and_nulls_stay_in_the_totals(spark):
    # More values than columns, one of them null.
    data = [("p", 1), ("q", 2), (None, 4)] + [(f"v{i}", 1) for i in range(1_200)]
    df = spark.createDataFrame(data, "k string, n int").withColumn("row", F.lit("r"))
    wide = pivot_sums(df, ["row"], "k", ["p"], ["n"]).first()
    assert (wide.p_sum_n, wide.other_sum_n) == (1, 1_206)
    tab = crosstab(df, "row", "k", ["p", "q"]).first()
    assert (tab.p, tab.q, tab.other) == (1, 1, 1_201)
    assert pair_counts(df, "row", "k").count() == 1_203
    with pytest.raises(ValueError):
        crosstab(df, "row", "k", ["other"])


def test_a_set_has_each_value_once_per_key(spark):
    df = spark.range(3_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 7).alias("v"))
    df = df.union(spark.range(1).select(F.lit(0).cast("long"), F.lit(None).cast("long")))
    found = {r.k: r.value_set for r in value_sets(df, ["k"], "v").collect()}
    assert found == {0: list(range(7)), 1: list(range(7))}


def test_crosstab_equals_the_built_in_one(sales):
    known = sales.na.drop()
    built_in = known.stat.crosstab("day", "country").withColumnRenamed("day_country", "day")
    found = crosstab(known, "day", "country", ["x", "y"])
    assert rows(found, "other") == [(0,), (0,)]
    assert same_rows(found.drop("other"), built_in)


def test_frequent_items_are_exact_and_within_the_built_in_ones(spark):
    # One value holds a third of the rows, another just reaches the support.
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 100 == 1, "just")
        .otherwise(F.col("id").cast("string"))
        .alias("code"),
        F.lit(5).alias("n"),
    )
    # Of the 3000 ids, 20 are 1 mod 100 and no multiple of 3.
    found = rows(frequent_items(df, ["code", "n"], 20 / 3000))
    assert found == [("code", "hot", 1000), ("code", "just", 20), ("n", "5", 3000)]
    built_in = df.stat.freqItems(["code"], 20 / 3000).first()[0]
    assert {"hot", "just"} <= set(built_in)


def test_describe_matches_the_built_in_summary(spark):
    df = spark.createDataFrame([(1.5, "b"), (2.5, "a"), (None, "c")], "v double, s string")
    found = {r.column_name: r for r in describe_long(df).collect()}
    summary = {r.summary: r for r in df.describe().collect()}
    assert found["v"].n == int(summary["count"].v) and found["s"].n == 3
    assert math.isclose(found["v"].mean, float(summary["mean"].v))
    assert math.isclose(found["v"].stddev, float(summary["stddev"].v))
    assert (found["v"].least, found["v"].greatest) == ("1.5", "2.5")
    assert (found["s"].least, found["s"].greatest) == ("a", "c")
    assert found["s"].mean is None


def test_lists_are_whole_and_bounded(spark):
    # A third of the values belong to one key; every list stays within the width.
    df = spark.range(3_000).select(
        F.col("id").alias("position"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.when(F.col("id") % 10 != 0, F.col("id") % 13).alias("v"),
    )
    found = value_lists(df, ["k"], "v", "position", width=500).orderBy("k", "chunk").collect()
    assert max(len(r["values"]) for r in found) <= 500
    whole = [v for r in found if r.k == "hot" for v in r["values"]]
    expected = [i % 13 for i in range(0, 3000, 3) if i % 10]
    assert whole == expected
    assert rows(value_sets(df, ["k"], "v").where("k = 'hot'"), "value_set") == [(sorted(set(expected)),)]


def test_collect_skips_nulls(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "a", 2)], "p int, k string, v int")
    assert value_lists(df, ["k"], "v", "p", 10).first()["values"] == [2]


def test_sums_combine_before_the_shuffle(sales):
    text = plan(cube_sums(sales, ["day", "country"], "quantity"), "simple")
    assert text.count("partial_sum") == 2


def test_frequent_items_are_exact_beyond_the_sketch(spark):
    # Far more values than a sketch tracks, some just above and some just below the bound.
    value = "CASE WHEN id % 20 = 0 THEN 'a' WHEN id % 33 = 1 THEN 'b' WHEN id % 49 = 2 THEN NULL WHEN id % 51 = 3 THEN 'd' ELSE CAST(id AS STRING) END"
    df = spark.range(0, 200_000, 1, 9).selectExpr(f"{value} AS text", "id % 40 AS number", "id AS single")
    found = frequent_items(df, ["text", "number", "single"], 0.02)
    texts = df.groupBy("text").count().where("count >= 0.02 * 200000")
    expected = {("text", r["text"], r["count"]) for r in texts.collect()}
    expected |= {("number", str(n), 5_000) for n in range(40)}
    assert {tuple(r) for r in found.select("column_name", "item", "n").collect()} == expected
    assert frequent_items(df.where("false"), ["text"], 0.5).collect() == []


def test_frequent_items_shuffle_candidates_only(spark):
    df = spark.range(0, 300_000, 1, 4).selectExpr("if(id % 3 = 0, -1, id) AS v")
    found = frequent_items(df, ["v"], 0.1)
    assert [tuple(r) for r in found.collect()] == [("v", "-1", 100_000)]
    assert "LeftSemi" in plan(found) and "approx_top_k" in plan(found).lower()
