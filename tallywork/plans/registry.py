"""Queries by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallywork.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of the tables under a name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = Query(name, build, oracle)
        return build

    return register


# The derived tables of tallywork.sources.tables, stated in SQL.
_RETAIL = """
retail AS (
  SELECT l_orderkey AS invoice_no,
         CAST(l_partkey AS VARCHAR) AS stock_code,
         CASE WHEN p_partkey % 50 <> 0 THEN upper(p_name) END AS description,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER)
           AS quantity,
         o_orderdate AS invoice_ts,
         p_retailprice AS unit_price,
         CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS customer_id,
         n_name AS country
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_FLIGHTS = """
flights AS (
  SELECT d.n_name AS dest_country_name, o.n_name AS origin_country_name, count(*) AS "count"
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation d ON c_nationkey = d.n_nationkey
  JOIN nation o ON s_nationkey = o.n_nationkey
  GROUP BY 1, 2
)"""


_STOCK = """
stock AS (
  SELECT CAST(p_partkey AS VARCHAR) AS stock_code,
         CASE WHEN p_partkey % 50 <> 0 THEN upper(p_name) END AS description,
         p_retailprice AS unit_price
  FROM part
)"""


def on_stock(select: str) -> str:
    return f"WITH {_STOCK.strip()}\n{select.strip()}"


def on_retail(select: str) -> str:
    return f"WITH {_RETAIL.strip()}\n{select.strip()}"


def on_flights(select: str) -> str:
    return f"WITH {_FLIGHTS.strip()}\n{select.strip()}"
