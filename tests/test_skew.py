"""Registered queries on tables in which single keys hold a third of the rows."""

import pytest
from pyspark.sql import functions as F

from compare import TABLES, connect, difference, spark_rows, sql_rows
from support import final_plan
from tallywork.operators import joins, sizes
from tallywork.plans.catalog import REGISTRY
from tallywork.session import scratch_path
from tallywork.sources.tables import Tables, flights, retail

NAMES = [
    "agg_collect",
    "agg_count_distinct_star",
    "agg_cube",
    "agg_freq_items",
    "agg_group_count",
    "agg_pivot",
    "agg_sum",
    "join_anti",
    "join_array_contains",
    "join_full",
    "join_left",
    "join_right",
    "join_semi",
    "nest_explode",
    "random_split",
    "st_daily_spend",
    "topk_group",
    "win_combined",
    "win_sql",
]


def third(column, value, number):
    """``value`` in a third of the rows."""
    return F.when(F.pmod(F.xxhash64(*number), F.lit(3)) == 0, value).otherwise(F.col(column))


@pytest.fixture(scope="module")
def folder(spark, tables):
    path = scratch_path(spark, "skewed")
    changed = {
        "orders": tables.orders.withColumn("o_custkey", third("o_custkey", 77, ["o_orderkey"])),
        "events": tables.events.withColumn("user_id", third("user_id", 8, ["event_id"])),
        "lineitem": tables.lineitem.withColumns(
            {
                "l_orderkey": third("l_orderkey", 7, ["l_extendedprice", "l_partkey"]),
                "l_partkey": third("l_partkey", 99, ["l_extendedprice", "l_tax"]),
                "l_suppkey": third("l_suppkey", 5, ["l_extendedprice", "l_discount"]),
            }
        ),
    }
    for name in TABLES:
        frame = changed.get(name, getattr(tables, name))
        # One file under the plain name, as the given tables have.
        frame.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder, "/*.parquet")


@pytest.mark.parametrize("name", NAMES)
def test_result_on_skewed_tables(spark, connection, folder, name, monkeypatch):
    # The tables are small; the operators are to treat them as they treat large ones.
    monkeypatch.setattr(sizes, "SMALL_INPUT_BYTES", 0)
    monkeypatch.setattr(joins.outer_join, "__defaults__", (100,))
    found = spark_rows(REGISTRY[name](spark, folder))
    assert difference(found, sql_rows(connection, REGISTRY[name].oracle)) is None


def test_derived_tables_split_their_hot_keys(spark, folder, settings):
    settings(
        {
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        }
    )
    # Several input files, as a large table has: a partition is split between map tasks.
    spread = scratch_path(spark, "spread")
    for name in ("lineitem", "orders", "part", "customer", "supplier", "nation"):
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        rows.repartition(8).write.parquet(f"{spread}/{name}.parquet")
    tables = Tables(spark, spread)
    settings({"spark.sql.files.maxPartitionBytes": "16KB", "spark.sql.files.openCostInBytes": "1"})
    by_order = retail(tables, "country", "quantity", "stock_code")
    by_part = retail(tables, "unit_price", "quantity", "invoice_no")
    for frame in (by_order, by_part, flights(tables)):
        assert "skew=true" in final_plan(frame)
