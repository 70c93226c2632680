"""Join types on the people tables, duplicate names, containment, and hot keys."""

import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from people import persons, programs, statuses
from support import SMALL_SKEW, final_plan, plan, rows, same_rows
from tallywork.operators import sizes
from tallywork.operators.joins import (
    all_pairs,
    broadcast_if_small,
    contains_join,
    having_match,
    hot_keys,
    is_small,
    outer_join,
    spread_outer_join,
    without_match,
)

PERSON_PROGRAM = [("graduate_program", "id")]


@pytest.fixture
def people(spark):
    return persons(spark).withColumnRenamed("id", "person_id")


@pytest.fixture
def degrees(spark):
    return programs(spark)


def test_inner_and_conditional_cross(people, degrees):
    same = people["graduate_program"] == degrees["id"]
    assert people.join(degrees, same).count() == 3
    assert same_rows(people.join(degrees, same, "cross"), people.join(degrees, same, "inner"))


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins_equal_the_built_in_ones(people, degrees, how):
    built_in = people.join(degrees, people["graduate_program"] == degrees["id"], how)
    assert same_rows(outer_join(people, degrees, PERSON_PROGRAM, how), built_in)
    swapped = outer_join(degrees, people, [("id", "graduate_program")], how)
    assert swapped.count() == (3 if how == "right" else 4)


def test_outer_join_sql_forms(spark, people, degrees):
    for how, words in (("left", "LEFT OUTER"), ("right", "RIGHT OUTER"), ("full", "FULL OUTER")):
        in_sql = spark.sql(
            f"SELECT * FROM {{p}} p {words} JOIN {{d}} d ON p.graduate_program = d.id",
            p=people,
            d=degrees,
        )
        assert same_rows(outer_join(people, degrees, PERSON_PROGRAM, how), in_sql)


def test_outer_join_keeps_null_keys_and_repeats(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (3, "c")], "k int, x string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (None, "r"), (4, "s")], "j int, y string")
    for how in ("left", "right", "full"):
        built_in = left.join(right, left["k"] == right["j"], how)
        assert same_rows(outer_join(left, right, [("k", "j")], how), built_in)


def test_outer_join_asks_for_distinct_names(people):
    with pytest.raises(ValueError, match="rename"):
        outer_join(people, people, [("person_id", "person_id")], "left")


def test_semi_keeps_repeated_left_rows(spark, people):
    on = [("id", "graduate_program")]
    assert rows(having_match(programs(spark), people, on), "id") == [(0,), (1,)]
    repeated = programs(spark, repeated=True)
    assert rows(having_match(repeated, people, on), "id") == [(0,), (0,), (1,)]
    in_sql = spark.sql(
        "SELECT * FROM {d} d LEFT SEMI JOIN {p} p ON d.id = p.graduate_program",
        d=repeated,
        p=people,
    )
    assert same_rows(having_match(repeated, people, on), in_sql)


def test_anti_keeps_null_keys(spark, people):
    unmatched = without_match(programs(spark), people, [("id", "graduate_program")])
    assert rows(unmatched, "id") == [(2,)]
    left = spark.createDataFrame([(None,), (1,)], "k int")
    right = spark.createDataFrame([(None,), (1,)], "j int")
    assert rows(without_match(left, right, [("k", "j")])) == [(None,)]


def test_keys_of_unlike_types_still_match(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,)], "j bigint")
    assert rows(having_match(left, right, [("k", "j")])) == [(2,)]
    assert rows(without_match(left, right, [("k", "j")])) == [(1,)]


def test_all_pairs_of_two_tables_of_any_size(spark, people, degrees):
    assert all_pairs(people, degrees).count() == 9
    assert all_pairs(people, spark.range(1_500)).count() == 4_500


def test_contains_join_equals_the_nested_loop(spark, people):
    by_condition = people.join(statuses(spark), F.expr("array_contains(spark_status, id)"))
    pairwise = ("NestedLoopJoin", "CartesianProduct")
    assert any(word in plan(by_condition) for word in pairwise)
    joined = contains_join(people, "spark_status", statuses(spark), "id")
    assert joined.count() == 6
    assert same_rows(joined, by_condition)
    assert not any(word in plan(joined) for word in pairwise)


def test_contains_join_with_repeats_and_nulls(spark):
    left = spark.createDataFrame(
        [(1, [5, 5, 6]), (2, []), (3, None), (4, [None, 6])], "n int, a array<int>"
    )
    right = spark.createDataFrame([(5,), (6,), (6,), (None,)], "e int")
    naive = left.join(right, F.expr("array_contains(a, e)"))
    assert same_rows(contains_join(left, "a", right, "e"), naive)


def test_duplicate_names(people, degrees):
    renamed = degrees.withColumnRenamed("id", "graduate_program")
    same = people["graduate_program"] == renamed["graduate_program"]
    with pytest.raises(AnalysisException, match="AMBIGUOUS_REFERENCE"):
        people.join(renamed, same).select("graduate_program")
    by_name = people.join(renamed, "graduate_program").select("graduate_program")
    dropped = people.join(renamed, same).drop(people["graduate_program"])
    assert rows(by_name) == rows(dropped, "graduate_program") == [(0,), (1,), (1,)]


def test_broadcast_only_within_the_checked_size(spark, people, degrees):
    same = people["graduate_program"] == degrees["id"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(people.join(broadcast_if_small(degrees), same))
        too_many = broadcast_if_small(degrees, max_rows=2)
        assert "BroadcastHashJoin" not in plan(people.join(too_many, same))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not is_small(degrees, max_rows=10, max_bytes=20)
    assert is_small(degrees.limit(0), max_rows=0, max_bytes=0)


# --- one key holds a third of the rows -----------------------------------------------------


@pytest.fixture
def hot(spark, settings):
    settings(SMALL_SKEW)
    settings({"spark.sql.shuffle.partitions": "16"})
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    facts = spark.range(120_000, numPartitions=8).select(
        key.alias("fk"), F.col("id").alias("v"), F.md5(F.col("id").cast("string")).alias("pad")
    )
    names = spark.range(4000, 9000).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    return facts, names.union(spark.sql("SELECT 7L AS k, 'seven' AS name"))


def largest_share(df):
    """Of the rows, the share in the fullest partition of the joined frame."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_spreads_a_hot_key_in_one_pass(hot, settings, how):
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    facts, names = hot
    joined = spread_outer_join(names, facts, [("k", "fk")], how, hot_rows=2_000)
    built_in = names.join(facts, F.col("k") == F.col("fk"), how)
    assert same_rows(joined, built_in)
    text = final_plan(joined)
    # Both sides are shuffled once each; the other exchanges carry sketches and hot keys.
    assert len(re.findall(r"Exchange hashpartitioning\((?:k|fk)#", text)) == 2
    assert largest_share(joined) < 0.2
    if how == "full":
        assert largest_share(built_in) > 0.3


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_join_spreads_keys_hot_on_either_side(spark, how):
    # Hot on the left only, on the right only, on both, with and without partners; nulls; repeats.
    def side(numbers, key, value):
        rows = [(k, f"{k}-{n}") for k, count in numbers.items() for n in range(count)]
        return spark.createDataFrame(rows + rows[-3:], f"{key} int, {value} string").repartition(5)

    left = side({1: 300, 2: 3, 3: 60, 4: 200, 6: 2, None: 100, 8: 1}, "k", "x")
    right = side({1: 2, 2: 400, 3: 70, 5: 250, 6: 1, None: 90, 9: 1}, "j", "y")
    joined = spread_outer_join(left, right, [("k", "j")], how, hot_rows=10)
    assert same_rows(joined, left.join(right, left["k"] == right["j"], how))


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_spread_outer_join_on_several_keys(spark, how):
    left = spark.range(3_000).selectExpr(
        "if(id % 3 = 0, 0, id % 7) AS a", "if(id % 6 = 0, -0.0D, CAST(id % 3 AS DOUBLE)) AS b", "id AS _salt", "map(1, id) AS m"
    )
    right = spark.range(40).selectExpr("id % 8 AS c", "CAST(id % 5 AS DOUBLE) AS d", "id AS _hot", "if(id > 30, null, id) AS z")
    on = [("a", "c"), ("b", "d")]
    joined = spread_outer_join(left, right, on, how, hot_rows=20)
    built_in = left.join(right, (left["a"] == right["c"]) & (left["b"] == right["d"]), how)
    assert same_rows(joined, built_in)


def test_outer_join_of_little_input_is_the_built_in_one(tables, monkeypatch):
    customers = tables.customer.select("c_custkey", "c_name")
    orders = tables.orders.select("o_custkey", "o_orderkey")
    on = [("c_custkey", "o_custkey")]
    little = outer_join(customers, orders, on, "full")
    assert plan(little, "simple").count("FileScan") == 2 and "approx_top_k" not in plan(little)
    monkeypatch.setattr(sizes, "SMALL_INPUT_BYTES", 0)
    spread = outer_join(customers, orders, on, "full", hot_rows=5)
    assert "approx_top_k" in plan(spread)
    assert same_rows(little, spread)


def test_hot_keys_are_those_with_many_rows(spark):
    numbers = spark.range(0, 100_000, 1, 7).selectExpr("if(id % 3 = 0, 7, if(id % 5 = 0, null, id)) AS k")
    found = rows(hot_keys(numbers, F.col("k"), 1_000), "key", "parts")
    assert found == [(7, 34)]


def test_semi_join_splits_a_key_hot_on_both_sides(hot):
    facts, _ = hot
    others = facts.select(F.col("fk").alias("g")).where("g < 4000")
    joined = having_match(facts, others, [("fk", "g")])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == facts.where("fk < 4000").count()


def test_contains_join_splits_a_hot_element(hot):
    facts, _ = hot
    arrays = facts.select("v", F.array(F.col("fk").cast("string"), F.lit("x")).alias("a"))
    counts = arrays.select(F.explode("a").alias("w")).groupBy("w").count()
    joined = contains_join(arrays, "a", counts, "w")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 240_000
