"""Samples, splits, partitions, ids and caching."""

from pyspark.sql import functions as F

from support import plan, rows, same_rows
from tallywork.operators.layout import (
    kept,
    partition_profile,
    partitions_for,
    partitions_for_bytes,
    row_bytes,
    spread,
    text_bytes,
)
from tallywork.operators.sampling import hash_parts, hash_sample, hash_split
from tallywork.session import scratch_path


def test_sample_size_and_repeatability(spark):
    df = spark.range(100_000)
    sample = hash_sample(df, ["id"], 0.01, seed=12345)
    assert 800 < sample.count() < 1200
    other_layout = hash_sample(df.repartition(7), ["id"], 0.01, seed=12345)
    assert same_rows(sample, other_layout)
    assert not same_rows(sample, hash_sample(df, ["id"], 0.01, seed=54321))
    assert "Exchange" not in plan(sample)


def test_portable_sample(spark):
    sample = hash_sample(spark.range(100_000), ["id"], 0.05, seed=1, portable=True)
    assert 4500 < sample.count() < 5500


def test_split_is_disjoint_and_complete(spark):
    df = spark.range(20_000)
    quarter, rest = hash_split(df, ["id"], [0.25, 0.75], seed=12345)
    assert 4500 < quarter.count() < 5500
    assert same_rows(quarter.union(rest), df)
    parts = hash_parts(df, ["id"], [1, 1, 2], seed=1).groupBy("part").count()
    sizes = dict(rows(parts))
    assert set(sizes) == {0, 1, 2} and 9500 < sizes[2] < 10500


def test_built_in_sample_and_split(spark):
    df = spark.range(10_000)
    assert 50 < df.sample(False, 0.01, 12345).count() < 150
    small, large = df.randomSplit([0.25, 0.75], 12345)
    assert small.count() + large.count() == 10_000


def test_partition_profile_shows_skew(spark):
    df = spark.range(900).repartition(4, F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    sizes = [n for _, n in rows(partition_profile(df))]
    assert sum(sizes) == 900 and max(sizes) > 300


def test_spread_divides_a_hot_value(spark, settings):
    settings({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    df = spark.range(9_000).select(F.lit("hot").alias("k"), "id")
    plain = partition_profile(df.repartition(8, "k"))
    salted = partition_profile(spread(df, "k", partitions=8, salts=8))
    assert plain.agg(F.max("n")).first()[0] == 9_000
    assert salted.agg(F.max("n")).first()[0] < 6_000
    assert salted.agg(F.sum("n")).first()[0] == 9_000


def test_rebalance_splits_a_hot_value(spark, settings):
    settings({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB"})
    df = spark.range(60_000, numPartitions=8).select(
        F.lit("hot").alias("k"), F.md5(F.col("id").cast("string")).alias("pad")
    )
    path = scratch_path(spark, "spread")
    spread(df, "k").write.parquet(path)
    written = spark.read.parquet(path)
    assert len(written.inputFiles()) > 4 and written.count() == 60_000


def test_partitions_follow_the_rows(spark):
    assert partitions_for(spark.range(0), 10) == 1
    assert partitions_for(spark.range(101), 10) == 11


def test_kept_is_released(spark):
    with kept(spark.range(10)) as df:
        assert df.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_cached_view_and_release(spark):
    spark.range(3).createOrReplaceTempView("a_view")
    spark.sql("CACHE TABLE a_view")
    assert spark.catalog.isCached("a_view")
    spark.sql("UNCACHE TABLE a_view")
    assert not spark.catalog.isCached("a_view")


def test_row_ids_are_unique_and_rise_within_a_partition(spark):
    df = spark.range(1_000, numPartitions=4).select(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("row_id"), "id"
    )
    found = df.collect()
    assert len({r.row_id for r in found}) == 1_000
    for partition in range(4):
        own = [r.row_id for r in found if r.p == partition]
        assert own == sorted(own)


def test_chained_filters_give_one_plan(spark, tables):
    chained = tables.orders.where("o_totalprice < 100000").where("o_orderstatus = 'F'")
    joined = tables.orders.where("o_totalprice < 100000 AND o_orderstatus = 'F'")
    assert chained.sameSemantics(joined) or plan(chained).count("Filter (") == plan(joined).count(
        "Filter ("
    )


def test_sql_and_dataframe_forms_give_one_plan(spark, tables):
    tables.orders.createOrReplaceTempView("orders")
    in_sql = spark.sql("SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY o_orderstatus")
    in_python = tables.orders.groupBy("o_orderstatus").count()
    operators = [
        [line.split("#")[0] for line in plan(df, "simple").splitlines()]
        for df in (in_sql, in_python)
    ]
    assert operators[0] == operators[1]


def test_partitions_follow_the_bytes(spark):
    narrow = spark.range(100_000)
    wide = spark.range(2_000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 100).alias("pad"))
    for df in (narrow, wide, narrow.limit(3)):
        exact = df.agg(F.sum(row_bytes(df))).first()[0]
        assert 0.8 * exact < text_bytes(df) < 1.2 * exact
        assert text_bytes(df) == text_bytes(df)
    assert partitions_for_bytes(wide, 64_000) in range(80, 140)
    assert partitions_for_bytes(spark.range(0), 10) == 1 and partitions_for_bytes(narrow, 10**9, 8) == 8
