"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables (default /root/testdata/sf0.1), BENCH_CPUS the
local threads (default 8). ``queries`` holds the faster of two warm runs of each query, ``cold``
the first run; ``value`` is the sum of the warm ones. Some results are also computed in the form
one would first write down, from the same columns; ``ratio`` is the plain total over ours for
these queries (above 1: ours is faster). ``--no-plain`` leaves that out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallywork.plans.catalog import REGISTRY  # noqa: E402
from tallywork.plans.matching import _customers, _filled  # noqa: E402
from tallywork.plans.summaries import WINDOW_KEYS, _dated_sales  # noqa: E402
from tallywork.session import build_session  # noqa: E402
from tallywork.sources.tables import Tables, retail  # noqa: E402

HEADLINES = [
    "topk_group",
    "proj_dynamic",
    "flt_boolcol",
    "distinct_rows",
    "random_split",
    "sort_desc_nulls",
    "agg_count_distinct",
    "agg_count_distinct_star",
    "agg_sum",
    "agg_sum_distinct",
    "agg_skew_kurt",
    "agg_corr",
    "agg_rollup",
    "agg_cube",
    "agg_grouping_id",
    "agg_pivot",
    "agg_crosstab",
    "agg_freq_items",
    "agg_describe",
    "win_combined",
    "join_inner",
    "join_full",
    "join_semi",
    "join_anti",
    "join_array_contains",
    "fn_months_between",
    "nest_explode",
    "udf_sql",
    "src_csv_infer",
    "sink_parquet",
    "st_daily_spend",
    "ml_kmeans",
]


def _plain_window(t):
    falling = Window.partitionBy(*WINDOW_KEYS).orderBy(F.desc_nulls_last("quantity"))
    running = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _dated_sales(t).select(
        *WINDOW_KEYS,
        "quantity",
        F.rank().over(falling).alias("rank"),
        F.dense_rank().over(falling).alias("dense_rank"),
        F.max("quantity").over(running).alias("running_max"),
    ).orderBy(*WINDOW_KEYS, "rank")


def _plain_contains(t):
    named = t.part.select("p_partkey", F.split("p_name", " ").alias("name_words"))
    counts = named.select(F.explode("name_words").alias("word")).groupBy("word").count()
    return named.join(counts, F.expr("array_contains(name_words, word)"))


def _plain_levels(t, kind):
    rows = retail(t, "invoice_ts", "country", "quantity").withColumn("date", F.col("invoice_ts").cast("date"))
    return getattr(rows, kind)("date", "country").agg(F.grouping_id(), F.sum("quantity"))


def _plain_top(t):
    customers = t.customer.join(
        t.nation.select("n_nationkey", F.col("n_name").alias("destination")),
        F.col("c_nationkey") == F.col("n_nationkey"),
    )
    suppliers = t.supplier.join(
        t.nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("origin")),
        F.col("s_nationkey") == F.col("key"),
    )
    pairs = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("destination", "origin")
        .count()
    )
    return pairs.groupBy("destination").sum("count").orderBy(F.desc("sum(count)")).limit(5)


def _plain_semi(t):
    customer_of = F.col("o_custkey") == F.col("c_custkey")
    orders = t.orders.join(_customers(t), customer_of, "left_semi")
    customers = t.customer.join(_filled(t), customer_of, "left_semi")
    return orders.select("o_orderkey", "o_custkey").union(
        customers.select("c_custkey", F.col("c_nationkey").cast("bigint"))
    )


PLAIN = {
    "topk_group": _plain_top,
    "agg_rollup": lambda t: _plain_levels(t, "rollup"),
    "agg_cube": lambda t: _plain_levels(t, "cube"),
    "agg_sum_distinct": lambda t: retail(t, "unit_price").agg(F.sum_distinct("unit_price")),
    "agg_crosstab": lambda t: t.lineitem.stat.crosstab("l_partkey", "l_returnflag"),
    "win_combined": _plain_window,
    "join_full": lambda t: _customers(t).join(
        _filled(t), F.col("c_custkey") == F.col("o_custkey"), "full"
    ),
    "join_semi": _plain_semi,
    "join_anti": lambda t: t.orders.join(
        t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    ),
    "join_array_contains": _plain_contains,
}


def run(build) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="tallywork-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    run(lambda: spark.range(10))  # start the executors' threads before the first timing

    wanted = [name for name in sys.argv[1:] if not name.startswith("-")] or HEADLINES
    cold, warm, plain = {}, {}, {}
    for name in wanted:
        times = [run(lambda: REGISTRY[name](spark, folder)) for _ in range(3)]
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
        if "--no-plain" not in sys.argv and name in PLAIN:
            plain[name] = round(min(run(lambda: PLAIN[name](tables)) for _ in range(3)), 3)
    report = {
        "metric": "headline_queries_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": Path(folder).name.removeprefix("sf"),
        "cold": cold,
        "cpus": int(cpus),
    }
    if plain:
        report["plain"] = plain
        report["ratio"] = round(sum(plain.values()) / sum(warm[name] for name in plain), 3)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
