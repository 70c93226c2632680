"""Streaming queries, run over all given files and checked against the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.plans.registry import query
from tallywork.session import scratch_path
from tallywork.sources.tables import Tables
from tallywork.streaming.files import append_files, keep_updates, latest_updates, read_files
from tallywork.streaming.spend import daily_spend


@query(
    "st_schema_reuse",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
)
def st_schema_reuse(t: Tables) -> DataFrame:
    static = t.events
    stream = read_files(t.spark, t.stream_path("events"), static.schema)
    purchases = stream.where("event_type = 'purchase'").select("event_id", "user_id", "value")
    path = scratch_path(t.spark, "purchases")
    append_files(purchases, path, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return t.spark.read.schema(purchases.schema).parquet(path)


# Files per micro-batch: a rate limit, in proportion to a source of many files.
FILES_PER_TRIGGER = 1_000
KEYS = ["user_id", "day"]


def _running_spend(t: Tables) -> DataFrame:
    stream = read_files(
        t.spark, t.stream_path("events"), t.events.schema, files_per_trigger=FILES_PER_TRIGGER
    )
    spend = daily_spend(stream, "user_id", "ts", "value")
    path = scratch_path(t.spark, "spend")
    keep_updates(spend, path, scratch_path(t.spark, "checkpoint"), KEYS).awaitTermination()
    return latest_updates(t.spark, path, spend.schema, KEYS)


def _readable(spend: DataFrame) -> DataFrame:
    return spend.select(
        "user_id",
        F.col("day").cast("string").alias("day"),
        F.col("total_cost").cast("double").alias("total_cost"),
    )


_SPEND_SQL = """
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP)::VARCHAR AS day,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_cost
FROM events GROUP BY user_id, date_trunc('day', ts)
"""


@query("st_daily_spend", _SPEND_SQL)
def st_daily_spend(t: Tables) -> DataFrame:
    return _readable(_running_spend(t))


@query("st_query_result", _SPEND_SQL + "ORDER BY total_cost DESC, user_id, day LIMIT 5")
def st_query_result(t: Tables) -> DataFrame:
    largest = t.spark.sql(
        "SELECT * FROM {spend} ORDER BY total_cost DESC, user_id, day LIMIT 5",
        spend=_running_spend(t),
    )
    return _readable(largest)


# Events reach us up to ten days late, by a number that follows from their id, in batches of
# arrivals over eight days. A day's window closes three days after the latest event seen before.
DELAY_DAYS = 3
_ARRIVALS = """
SELECT *, CAST(floor((date_diff('day', (SELECT min(ts) FROM events), ts) + event_id * 7919 % 11) / 8) AS INTEGER) AS batch
FROM events
"""


def _arrived(t: Tables) -> DataFrame:
    first = t.events.agg(F.min("ts")).scalar()
    days = F.datediff("ts", first) + F.col("event_id") * 7919 % 11
    return t.events.withColumn("batch", F.floor(days / 8).cast("int"))


@query(
    "st_late_events",
    f"""
    WITH arrived AS ({_ARRIVALS}),
    marked AS (
      SELECT *, (SELECT max(ts) FROM arrived b WHERE b.batch < a.batch) - INTERVAL {DELAY_DAYS} DAY AS watermark
      FROM arrived a
    ),
    in_time AS (
      SELECT * FROM marked
      WHERE watermark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > watermark
    )
    SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP)::VARCHAR AS day,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_cost
    FROM in_time GROUP BY user_id, date_trunc('day', ts)
    """,
)
def st_late_events(t: Tables) -> DataFrame:
    # Every batch of arrivals is one run of the query, which goes on from its checkpoint: windows
    # that the watermark has passed are dropped from the state, and rows for them are too late.
    arrivals, source = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "events")
    path, checkpoint = scratch_path(t.spark, "spend"), scratch_path(t.spark, "checkpoint")
    _arrived(t).write.partitionBy("batch").parquet(arrivals)
    staged = t.spark.read.parquet(arrivals)
    for (batch,) in sorted(staged.select("batch").distinct().collect()):
        staged.where(F.col("batch") == batch).select(*t.events.columns).write.mode("append").parquet(source)
        stream = read_files(t.spark, source, t.events.schema)
        spend = daily_spend(stream, "user_id", "ts", "value", f"{DELAY_DAYS} days")
        keep_updates(spend, path, checkpoint, KEYS, merge_every=2).awaitTermination()
    return _readable(latest_updates(t.spark, path, spend.schema, KEYS))
