"""Sources and sinks. File formats are tried on files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.operators.layout import spread
from tallywork.plans.registry import on_flights, query
from tallywork.session import scratch_path
from tallywork.sources.readers import (
    bind,
    load_or_empty,
    read_csv,
    read_csv_guessed,
    read_json,
    read_parquet,
    split_malformed,
)
from tallywork.sources.tables import Tables, flights
from tallywork.sources.writers import write_csv, write_json, write_parquet
from tallywork.streaming.files import append_files, keep_updates, latest_updates, read_files

# Files per micro-batch: a rate limit, in proportion to a source of many files.
FILES_PER_TRIGGER = 1_000
MICRO_BATCHES = 8

FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("dest_country_name", T.StringType(), True),
        T.StructField("origin_country_name", T.StringType(), True),
        T.StructField("count", T.LongType(), False, metadata={"unit": "flights"}),
    ]
)
CUSTOMER_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ]
)

_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, o_orderpriority
FROM orders
"""
_EVENTS_SQL = """
SELECT event_id, CAST(ts AS VARCHAR) AS event_time, user_id, event_type, value, props FROM events
"""


def _orders_out(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        "o_totalprice",
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        "o_orderpriority",
    )


def _events_out(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").cast("string").alias("event_time"),
        "user_id",
        "event_type",
        "value",
        "props",
    )


@query(
    "src_range",
    """
    SELECT b.bucket, count(l_orderkey) AS lines
    FROM (SELECT unnest(range(0, 10000)) AS bucket) b
    LEFT JOIN lineitem ON l_orderkey % 10000 = b.bucket
    GROUP BY 1
    """,
)
def src_range(t: Tables) -> DataFrame:
    # Lines by the last four digits of their order; the range makes digits without lines show.
    digits = t.spark.range(10_000).toDF("bucket")
    lines = t.lineitem.groupBy((F.col("l_orderkey") % 10_000).alias("digits")).agg(
        F.count("*").alias("lines")
    )
    return digits.join(lines, F.col("bucket") == F.col("digits"), "left").select(
        "bucket", F.coalesce("lines", F.lit(0)).alias("lines")
    )


@query("src_csv_infer", _ORDERS_SQL)
def src_csv_infer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-csv")
    write_csv(t.orders, path)
    return _orders_out(read_csv(t.spark, path, infer=True))


@query(
    "src_csv_strings",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer
    """,
)
def src_csv_strings(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t.customer, path)
    return read_csv(t.spark, path)


@query("src_csv_schema", "SELECT * FROM supplier")
def src_csv_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "supplier-csv")
    write_csv(t.supplier, path)
    return read_csv(t.spark, path, schema=t.supplier.schema, mode="FAILFAST")


# Lines as an export may have them: some amounts are words, some lines lack their last field.
PAYMENT = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)
_PAYMENT_LINES = """
SELECT c_custkey, c_custkey % 13 = 0 OR c_custkey % 17 = 0 AS bad,
       concat(CAST(c_custkey AS VARCHAR(20)), ',',
              CASE WHEN c_custkey % 13 = 0 THEN 'much' ELSE CAST(c_custkey % 1000 AS VARCHAR(20)) END,
              CASE WHEN c_custkey % 17 = 0 THEN '' ELSE concat(',', c_mktsegment) END) AS line,
       CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 1000 AS DOUBLE) END AS c_acctbal,
       CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS c_mktsegment
FROM customer
"""


def _payment_file(t: Tables) -> str:
    """The lines as text files, each with a header."""
    path = scratch_path(t.spark, "payments")
    t.customer.createOrReplaceTempView("customer")
    lines = t.spark.sql(_PAYMENT_LINES).select(F.col("line").alias("c_custkey,c_acctbal,c_mktsegment"))
    # Quoting is off, so that a line is written as it is.
    lines.write.option("header", True).option("quote", "").option("sep", "\u0001").csv(path)
    return path


@query(
    "src_csv_guessed",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 5 THEN o_custkey + 0.25 ELSE o_custkey END::DOUBLE AS amount,
           CASE WHEN o_orderkey % 991 = 7 THEN 'none' ELSE CAST(o_custkey AS VARCHAR) END AS code, o_orderstatus
    FROM orders
    """,
)
def src_csv_guessed(t: Tables) -> DataFrame:
    # Few values are no whole numbers or no numbers at all, so a sample of the files misses them.
    path = scratch_path(t.spark, "orders-csv")
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 997 == 5, F.concat("o_custkey", F.lit(".25"))).otherwise(F.col("o_custkey").cast("string")).alias("amount"),
        F.when(F.col("o_orderkey") % 991 == 7, "none").otherwise(F.col("o_custkey").cast("string")).alias("code"),
        "o_orderstatus",
    )
    write_csv(rows.repartition(16, "o_orderkey"), path)
    found = read_csv_guessed(t.spark, path, scratch_path(t.spark, "orders-typed"), sample_files=2)
    return found.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    "src_csv_quarantine",
    f"""
    SELECT CASE WHEN NOT bad THEN c_custkey END AS c_custkey, CASE WHEN NOT bad THEN c_acctbal END AS c_acctbal,
           CASE WHEN NOT bad THEN c_mktsegment END AS c_mktsegment, CASE WHEN bad THEN line END AS line
    FROM ({_PAYMENT_LINES})
    """,
)
def src_csv_quarantine(t: Tables) -> DataFrame:
    # Good rows and bad lines from one pass; none is lost.
    good, bad = split_malformed(t.spark, _payment_file(t), PAYMENT, scratch_path(t.spark, "checked"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in PAYMENT]
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad.select(*nothing, "line"))


@query("src_csv_permissive", f"SELECT c_custkey, c_acctbal, c_mktsegment FROM ({_PAYMENT_LINES})")
def src_csv_permissive(t: Tables) -> DataFrame:
    return read_csv(t.spark, _payment_file(t), schema=PAYMENT, mode="PERMISSIVE")


@query(
    "src_csv_dropmalformed",
    f"SELECT c_custkey, c_acctbal, c_mktsegment FROM ({_PAYMENT_LINES}) WHERE NOT bad",
)
def src_csv_dropmalformed(t: Tables) -> DataFrame:
    return read_csv(t.spark, _payment_file(t), schema=PAYMENT, mode="DROPMALFORMED")


@query("src_csv_glob", _ORDERS_SQL)
def src_csv_glob(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders-by-priority")
    write_csv(spread(t.orders, "o_orderpriority"), path)
    return _orders_out(read_csv(t.spark, f"{path}/*.csv", schema=t.orders.schema))


@query("src_json_infer", _EVENTS_SQL)
def src_json_infer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-json")
    write_json(t.events, path)
    return _events_out(read_json(t.spark, path))


@query("src_json_schema", on_flights('SELECT * FROM flights'))
def src_json_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "flights-json")
    write_json(flights(t), path)
    return read_json(t.spark, path, schema=FLIGHT_SCHEMA, mode="FAILFAST")


@query("src_json_glob", _EVENTS_SQL)
def src_json_glob(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-by-type")
    write_json(spread(t.events, "event_type"), path)
    return _events_out(read_json(t.spark, f"{path}/*.json", schema=t.events.schema))


@query(
    "src_parquet",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-07-01 00:00:00'
    """,
)
def src_parquet(t: Tables) -> DataFrame:
    lines = read_parquet(t.spark, t.path("lineitem"))
    return lines.where("l_shipdate >= timestamp_ntz'1998-07-01 00:00:00'").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


@query(
    "src_rows_schema",
    """
    SELECT n_nationkey, n_name, n_regionkey, customers
    FROM (SELECT * FROM nation UNION ALL VALUES (100, 'NEW NATION', 0), (101, NULL, 1)) n
    LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c
      ON c_nationkey = n_nationkey
    """,
)
def src_rows_schema(t: Tables) -> DataFrame:
    added = t.spark.createDataFrame(
        [(100, "NEW NATION", 0), (101, None, 1)], schema=t.nation.schema
    )
    customers = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    return (
        t.nation.union(added)
        .join(customers, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .drop("c_nationkey")
    )


@query(
    "src_rows_infer",
    """
    SELECT meaning, count(*) AS orders
    FROM orders JOIN (VALUES ('F', 'filled'), ('O', 'open'), ('P', 'in progress'))
      s(status, meaning) ON o_orderstatus = status
    GROUP BY 1
    """,
)
def src_rows_infer(t: Tables) -> DataFrame:
    statuses = t.spark.createDataFrame(
        [("F", "filled"), ("O", "open"), ("P", "in progress")], ["status", "meaning"]
    )
    counted = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
    return counted.join(statuses, F.col("o_orderstatus") == F.col("status")).select(
        "meaning", "orders"
    )


@query(
    "src_typed",
    "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part",
)
def src_typed(t: Tables) -> DataFrame:
    record = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_size", T.LongType()),
        ]
    )
    return bind(t.part, record)


@query(
    "src_guarded",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS customer, c_name AS name, CAST(c_nationkey AS VARCHAR)
      AS nation
    FROM customer WHERE c_nationkey % 2 = 0
    """,
)
def src_guarded(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer-csv")
    write_csv(t.customer, path)
    found = load_or_empty(t.spark, lambda: read_csv(t.spark, path), CUSTOMER_TEXT)
    absent = load_or_empty(t.spark, lambda: read_csv(t.spark, f"{path}-absent"), CUSTOMER_TEXT)
    renamed = found.union(absent).select(
        F.col("c_custkey").alias("customer"),
        F.col("C_Name").alias("name"),
        F.col("c_nationkey").alias("nation"),
    )
    return renamed.where("nation % 2 = 0")


@query("src_stream_files", _EVENTS_SQL)
def src_stream_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-stream")
    stream = read_files(
        t.spark, t.stream_path("events"), t.events.schema, files_per_trigger=FILES_PER_TRIGGER
    )
    append_files(stream, path, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return _events_out(t.spark.read.schema(t.events.schema).parquet(path))


@query("sink_csv_tsv", "SELECT * FROM part")
def sink_csv_tsv(t: Tables) -> DataFrame:
    comma, tab = scratch_path(t.spark, "part-csv"), scratch_path(t.spark, "part-tsv")
    schema = t.part.schema
    write_csv(t.part, comma)
    write_csv(read_csv(t.spark, comma, schema=schema, mode="FAILFAST"), tab, sep="\t")
    return read_csv(t.spark, tab, schema=schema, sep="\t", mode="FAILFAST")


@query(
    "sink_csv_json2csv",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date
    FROM orders
    """,
)
def sink_csv_json2csv(t: Tables) -> DataFrame:
    source, target = scratch_path(t.spark, "orders-json"), scratch_path(t.spark, "orders-csv")
    dated = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    write_json(dated, source)
    read_back = read_json(t.spark, source, schema=dated.schema, mode="FAILFAST")
    for _ in range(2):  # the second write replaces the first
        write_csv(read_back, target, date_format="yyyy-MM-dd")
    return read_csv(t.spark, target)


@query("sink_parquet", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_parquet(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "documents")
    write_parquet(t.documents, path)
    return read_parquet(t.spark, path)


@query(
    "sink_stream_memory",
    """
    SELECT event_type, count(*) AS n,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_value
    FROM events GROUP BY 1
    """,
)
def sink_stream_memory(t: Tables) -> DataFrame:
    # The running result under a name, held by the restartable sink and not by the driver. The
    # events come as several files, one a micro-batch, so groups carry over between batches.
    source, results = scratch_path(t.spark, "events"), scratch_path(t.spark, "by-type")
    t.events.repartition(MICRO_BATCHES, "event_id").write.parquet(source)
    totals = read_files(t.spark, source, t.events.schema, files_per_trigger=1).groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")
    )
    checkpoint = scratch_path(t.spark, "checkpoint")
    keep_updates(totals, results, checkpoint, ["event_type"], merge_every=3).awaitTermination()
    latest = latest_updates(t.spark, results, totals.schema, ["event_type"])
    latest.createOrReplaceTempView("events_by_type")
    return t.spark.table("events_by_type").withColumn("total_value", F.col("total_value").cast("double"))


@query(
    "view_df_to_sql",
    """
    SELECT o_orderstatus, orders, round(orders / sum(orders) OVER (), 6) AS share FROM (
      SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_totalprice > 1000 GROUP BY 1
    )
    """,
)
def view_df_to_sql(t: Tables) -> DataFrame:
    large = t.orders.where(F.col("o_totalprice") > 1000)
    counted = t.spark.sql(
        "SELECT o_orderstatus, count(*) AS orders FROM {large} GROUP BY o_orderstatus",
        large=large,
    )
    total = counted.agg(F.sum("orders")).scalar()
    return counted.withColumn("share", F.round(F.col("orders") / total, 6))
