"""The composed operators against Spark's built-in ones on random small tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import same_rows
from tallywork.operators.aggregates import cube_sums, frequent_items
from tallywork.operators.joins import contains_join, having_match, outer_join, without_match
from tallywork.operators.ranking import with_ranks

FEW = settings(
    max_examples=4,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
KEY = st.one_of(st.none(), st.integers(0, 3))
ROWS = st.lists(st.tuples(KEY, st.integers(-2, 2)), max_size=12)


@FEW
@given(left=ROWS, right=ROWS)
def test_joins(spark, left, right):
    a = spark.createDataFrame(left, "k int, x int").coalesce(1)
    b = spark.createDataFrame(right, "j int, y int").coalesce(1)
    same = F.col("k") == F.col("j")
    for how in ("left", "right", "full"):
        assert same_rows(outer_join(a, b, [("k", "j")], how), a.join(b, same, how))
    assert same_rows(having_match(a, b, [("k", "j")]), a.join(b, same, "left_semi"))
    assert same_rows(without_match(a, b, [("k", "j")]), a.join(b, same, "left_anti"))


@FEW
@given(
    left=st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.lists(KEY, max_size=4))),
                  max_size=8),
    right=st.lists(st.tuples(KEY), max_size=5),
)
def test_containment(spark, left, right):
    a = spark.createDataFrame(left, "n int, a array<int>").coalesce(1)
    b = spark.createDataFrame(right, "e int").coalesce(1)
    assert same_rows(contains_join(a, "a", b, "e"), a.join(b, F.expr("array_contains(a, e)")))


@FEW
@given(data=st.lists(st.tuples(KEY, st.one_of(st.none(), st.integers(-40, 40))), max_size=20))
def test_ranks(spark, data):
    df = spark.createDataFrame(data, "k int, v int").coalesce(1)
    falling = Window.partitionBy("k").orderBy(F.desc_nulls_last("v"))
    running = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = df.select(
        "*",
        F.rank().over(falling).cast("bigint").alias("rank"),
        F.dense_rank().over(falling).cast("bigint").alias("dense_rank"),
        F.max("v").over(running).alias("running_max"),
    )
    assert same_rows(with_ranks(df, ["k"], "v"), expected)
    assert same_rows(with_ranks(df, ["k"], "v", F.floor(F.col("v") / 8)), expected)


@FEW
@given(data=st.lists(st.tuples(KEY, KEY, st.integers(-5, 5)), max_size=15))
def test_cube(spark, data):
    df = spark.createDataFrame(data, "a int, b int, v int").coalesce(1)
    expected = df.cube("a", "b").agg(
        F.grouping_id().alias("level"), F.sum("v").alias("total_v")
    )
    for first in (True, False):
        assert same_rows(cube_sums(df, ["a", "b"], "v", first), expected)


@FEW
@given(data=st.lists(st.tuples(st.integers(0, 3)), min_size=1, max_size=30))
def test_frequent_items(spark, data):
    df = spark.createDataFrame(data, "v int").coalesce(1)
    counts = {v: sum(1 for (x,) in data if x == v) for (v,) in data}
    expected = {str(v): n for v, n in counts.items() if n >= 0.3 * len(data)}
    found = {r.item: r.n for r in frequent_items(df, ["v"], 0.3).collect()}
    assert found == expected
