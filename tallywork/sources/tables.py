"""The given Parquet tables and the two tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """Parquet tables below one folder, opened on first use: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """The table's path as a glob: the stream source refuses that of a single file."""
        return f"{self.folder}/{name[:-1]}[{name[-1]}].parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


# Where each retail column comes from; a look-up is joined only if a column of it is wanted.
_FROM_LINE = {"invoice_no", "stock_code", "quantity"}
_FROM_ORDER = {"invoice_ts", "customer_id", "country"}
_FROM_PART = {"description", "unit_price"}
RETAIL_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_ts",
    "unit_price",
    "customer_id",
    "country",
)


def signed_quantity() -> Column:
    """Returned lines count as negative quantities."""
    quantity = F.col("l_quantity")
    return F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).cast("int")


def stock(tables: Tables) -> DataFrame:
    """One row per part: code, description (null for some) and price."""
    return tables.part.select(
        F.col("p_partkey").cast("string").alias("stock_code"),
        F.when(F.col("p_partkey") % 50 != 0, F.upper("p_name")).alias("description"),
        F.col("p_retailprice").alias("unit_price"),
        "p_partkey",
    )


def order_facts(tables: Tables, *columns: str) -> DataFrame:
    """One row per order: key, time, customer (null for some) and the customer's country."""
    facts = tables.orders.select(
        "o_orderkey",
        F.col("o_orderdate").alias("invoice_ts"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("customer_id"),
        "o_custkey",
    )
    if "country" in columns:
        countries = tables.customer.join(
            tables.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select("c_custkey", F.col("n_name").alias("country"))
        facts = facts.join(countries, F.col("o_custkey") == F.col("c_custkey"), "left")
    return facts.select("o_orderkey", *columns)


def retail(tables: Tables, *columns: str, distinct_lines: bool = False) -> DataFrame:
    """One row per line item with the wanted retail columns (all of them by default).

    Every look-up is a left join on a unique key, so leaving one out keeps the rows as they
    are: a query on quantities alone never shuffles the line items. ``distinct_lines`` drops
    lines that repeat another's invoice, part and quantity ahead of the look-ups, which follow
    from these.
    """
    wanted = columns or RETAIL_COLUMNS
    unknown = [name for name in wanted if name not in RETAIL_COLUMNS]
    if unknown:
        raise ValueError(f"no such retail columns: {', '.join(unknown)}")
    df = tables.lineitem.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_orderkey").alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        signed_quantity().alias("quantity"),
    )
    if distinct_lines:
        df = df.distinct()
    from_part = [name for name in wanted if name in _FROM_PART]
    if from_part:
        parts = stock(tables).select("p_partkey", *from_part)
        df = df.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    from_order = [name for name in wanted if name in _FROM_ORDER]
    if from_order:
        facts = order_facts(tables, *from_order)
        df = df.join(facts, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return df.select(*wanted)


def order_totals(tables: Tables, *columns: str) -> DataFrame:
    """Quantity and line count per order with the wanted order columns.

    Line items shrink to one row per order before they meet the orders. The grouping leaves
    them partitioned by the join key, so the join itself adds no shuffle of the lines, and
    map-side sums keep a hot order to one row per task.
    """
    totals = (
        tables.lineitem.select("l_orderkey", signed_quantity().alias("quantity"))
        .groupBy("l_orderkey")
        .agg(F.sum("quantity").alias("quantity"), F.count("*").alias("lines"))
    )
    facts = order_facts(tables, *columns)
    return totals.join(facts, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.col("l_orderkey").alias("invoice_no"), *columns, "quantity", "lines"
    )


def flights(
    tables: Tables, origin: Column | None = None, destination: Column | None = None
) -> DataFrame:
    """Line items counted from the supplier's nation to the customer's nation.

    Counting runs on the two nation keys; names are looked up on the counted rows only.
    ``origin`` and ``destination`` are conditions on ``n_name``. They cut the suppliers and the
    customers to the kept nations before the line items meet them; as conditions on the result
    they would be tried after all lines were joined and counted.
    """
    suppliers = tables.supplier.select("s_suppkey", "s_nationkey")
    customers = tables.customer.select("c_custkey", "c_nationkey")
    if origin is not None:
        kept = tables.nation.where(origin).select("n_nationkey")
        suppliers = suppliers.join(kept, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    if destination is not None:
        kept = tables.nation.where(destination).select("n_nationkey")
        customers = customers.join(kept, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    lines = tables.lineitem.select("l_orderkey", "l_suppkey").join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    orders = tables.orders.select("o_orderkey", "o_custkey").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    counted = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count("*").alias("count"))
    )
    destination = tables.nation.select(
        F.col("n_nationkey").alias("d_key"), F.col("n_name").alias("dest_country_name")
    )
    origin = tables.nation.select(
        F.col("n_nationkey").alias("o_key"), F.col("n_name").alias("origin_country_name")
    )
    return (
        counted.join(destination, F.col("c_nationkey") == F.col("d_key"))
        .join(origin, F.col("s_nationkey") == F.col("o_key"))
        .select("dest_country_name", "origin_country_name", "count")
    )
