"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.functions.nested import words
from tallywork.operators.joins import (
    all_pairs,
    broadcast_if_small,
    contains_join,
    having_match,
    outer_join,
    without_match,
)
from tallywork.plans.registry import query
from tallywork.sources.tables import Tables

# Both sides have rows without a partner.
_SIDES_SQL = """
WITH customers AS (
  SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal > 0
),
filled AS (
  SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
)
"""
ON_CUSTOMER = [("c_custkey", "o_custkey")]


def _customers(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey")


def _filled(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "join_inner", _SIDES_SQL + "SELECT * FROM customers JOIN filled ON c_custkey = o_custkey"
)
def join_inner(t: Tables) -> DataFrame:
    customers, filled = _customers(t), _filled(t)
    return customers.join(filled, customers["c_custkey"] == filled["o_custkey"], "inner")


@query(
    "join_full",
    _SIDES_SQL + "SELECT * FROM customers FULL OUTER JOIN filled ON c_custkey = o_custkey",
)
def join_full(t: Tables) -> DataFrame:
    return outer_join(_customers(t), _filled(t), ON_CUSTOMER, "full")


@query(
    "join_left",
    _SIDES_SQL + "SELECT * FROM customers LEFT JOIN filled ON c_custkey = o_custkey",
)
def join_left(t: Tables) -> DataFrame:
    return outer_join(_customers(t), _filled(t), ON_CUSTOMER, "left")


@query(
    "join_right",
    _SIDES_SQL + "SELECT * FROM customers RIGHT JOIN filled ON c_custkey = o_custkey",
)
def join_right(t: Tables) -> DataFrame:
    return outer_join(_customers(t), _filled(t), ON_CUSTOMER, "right")


@query(
    "join_semi",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    """,
)
def join_semi(t: Tables) -> DataFrame:
    # Repeated left rows are all kept; repeated right rows add none.
    orders = having_match(t.orders, _customers(t), [("o_custkey", "c_custkey")])
    customers = having_match(t.customer, _filled(t), ON_CUSTOMER)
    return orders.select("o_orderkey", "o_custkey").union(
        customers.select("c_custkey", F.col("c_nationkey").cast("bigint"))
    )


@query(
    "join_anti",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
)
def join_anti(t: Tables) -> DataFrame:
    return without_match(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")]).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "join_cross_cond",
    _SIDES_SQL + "SELECT * FROM customers CROSS JOIN filled WHERE c_custkey = o_custkey",
)
def join_cross_cond(t: Tables) -> DataFrame:
    # A cross join with an equality is an inner join, and Spark plans it as one.
    customers, filled = _customers(t), _filled(t)
    return customers.join(filled, customers["c_custkey"] == filled["o_custkey"], "cross")


@query(
    "join_cross",
    """
    SELECT n_name, r_name, coalesce(customers, 0) AS customers
    FROM nation CROSS JOIN region
    LEFT JOIN (
      SELECT n_nationkey AS key, n_regionkey AS region, count(*) AS customers
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
    ) ON key = n_nationkey AND region = r_regionkey
    """,
)
def join_cross(t: Tables) -> DataFrame:
    # Customers by nation and region on the full grid of both small tables.
    counted = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    named = t.nation.join(counted, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    own_region = F.col("n_regionkey") == F.col("r_regionkey")
    return all_pairs(named, t.region).select(
        "n_name",
        "r_name",
        F.when(own_region, F.coalesce("n", F.lit(0))).otherwise(0).alias("customers"),
    )


@query(
    "join_array_contains",
    """
    WITH named AS (SELECT p_partkey, string_split(p_name, ' ') AS name_words FROM part),
    word_counts AS (
      SELECT word, count(*) AS parts
      FROM (SELECT DISTINCT p_partkey, unnest(name_words) AS word FROM named) GROUP BY 1
    )
    SELECT p_partkey, word, parts FROM named JOIN word_counts ON list_contains(name_words, word)
    """,
)
def join_array_contains(t: Tables) -> DataFrame:
    named = t.part.select("p_partkey", words(F.col("p_name")).alias("name_words"))
    word_counts = (
        named.select(F.explode(F.array_distinct("name_words")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("parts"))
    )
    return contains_join(named, "name_words", word_counts, "word").drop("name_words")


_NAMED_SQL = """
SELECT c_custkey AS custkey, c_name, o_orderkey
FROM customer JOIN orders ON c_custkey = o_custkey
"""


def _one_name(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers and orders whose key has the same name on both sides."""
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    orders = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return customers, orders


@query("join_dup_string", _NAMED_SQL)
def join_dup_string(t: Tables) -> DataFrame:
    customers, orders = _one_name(t)
    return customers.join(orders, "custkey")


@query("join_dup_drop", _NAMED_SQL)
def join_dup_drop(t: Tables) -> DataFrame:
    customers, orders = _one_name(t)
    same = customers["custkey"] == orders["custkey"]
    return customers.join(orders, same).drop(orders["custkey"])


@query(
    "join_dup_rename",
    """
    SELECT c_custkey AS custkey, c_name, o_custkey AS buyer, o_orderkey
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def join_dup_rename(t: Tables) -> DataFrame:
    customers, orders = _one_name(t)
    renamed = orders.withColumnRenamed("custkey", "buyer")
    return customers.join(renamed, customers["custkey"] == renamed["buyer"])


@query(
    "join_broadcast",
    """
    SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def join_broadcast(t: Tables) -> DataFrame:
    nations = broadcast_if_small(t.nation.select("n_nationkey", "n_name"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_name"
    )
