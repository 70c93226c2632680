"""Streams against batch results, over several micro-batches and across a restart."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import rows, same_rows
from tallywork.session import drop_scratch, scratch_path
from tallywork.streaming.files import (
    append_files,
    keep_updates,
    latest_updates,
    merge_updates,
    read_files,
    to_memory_table,
)
from tallywork.streaming.spend import daily_spend

KEYS = ["user_id", "day"]


@pytest.fixture
def event_files(spark, tables):
    """The events in five files, cut across days and users."""
    path = scratch_path(spark, "events")
    tables.events.repartition(5, "event_id").write.parquet(path)
    return path


def spend_of(df, watermark=None):
    return daily_spend(df, "user_id", "ts", "value", watermark)


def test_daily_spend_over_five_batches_equals_batch(spark, tables, event_files):
    stream = read_files(spark, event_files, tables.events.schema, files_per_trigger=1)
    assert stream.isStreaming
    spend = spend_of(stream)
    path = scratch_path(spark, "spend")
    query = keep_updates(spend, path, scratch_path(spark, "checkpoint"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows > 0]) == 5
    result = latest_updates(spark, path, spend.schema, KEYS)
    assert same_rows(result, spend_of(tables.events))


def test_daily_spend_goes_on_after_a_restart(spark, tables, event_files):
    source, path = scratch_path(spark, "source"), scratch_path(spark, "spend")
    checkpoint = scratch_path(spark, "checkpoint")
    events = spark.read.parquet(event_files)
    parts = [events.where(F.col("event_id") % 2 == half) for half in (0, 1)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        spend = spend_of(read_files(spark, source, tables.events.schema, files_per_trigger=1))
        keep_updates(spend, path, checkpoint).awaitTermination()
    result = latest_updates(spark, path, spend.schema, KEYS)
    assert same_rows(result, spend_of(tables.events))


def test_memory_table_in_complete_mode(spark, tables, event_files):
    stream = read_files(spark, event_files, tables.events.schema, files_per_trigger=1)
    by_type = stream.groupBy("event_type").agg(F.count("*").alias("n"))
    to_memory_table(by_type, "events_by_type", scratch_path(spark, "cp")).awaitTermination()
    batch = tables.events.groupBy("event_type").agg(F.count("*").alias("n"))
    assert same_rows(spark.table("events_by_type"), batch)


def test_appended_rows_survive_a_restart_once(spark, tables, event_files):
    path, checkpoint = scratch_path(spark, "rows"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = read_files(spark, event_files, tables.events.schema, files_per_trigger=2)
        append_files(stream, path, checkpoint).awaitTermination()
    assert same_rows(spark.read.parquet(path), tables.events)


def test_watermark_closes_windows_in_append_mode(spark, tables):
    # In time order no row comes late, so each closed window holds its whole day.
    source, path = scratch_path(spark, "source"), scratch_path(spark, "spend")
    for fifth in range(5):
        part = tables.events.where(F.floor(F.dayofmonth("ts") / 6.5) == fifth)
        part.coalesce(1).write.mode("append").parquet(source)
    stream = read_files(spark, source, tables.events.schema, files_per_trigger=1)
    spend = spend_of(stream, watermark="1 day")
    append_files(spend, path, scratch_path(spark, "checkpoint")).awaitTermination()
    closed = spark.read.parquet(path)
    batch = spend_of(tables.events.withColumn("ts", F.col("ts").cast("timestamp")))
    days = closed.select("day").distinct().count()
    assert 0 < days < batch.select("day").distinct().count()
    assert same_rows(closed, batch.join(closed.select("day").distinct(), "day").select(*closed.columns))


def test_csv_stream_takes_its_schema_from_a_static_read(spark, tables):
    path = scratch_path(spark, "csv")
    tables.orders.select("o_orderkey", "o_totalprice").write.option("header", True).csv(path)
    static = spark.read.option("header", True).option("inferSchema", True).csv(path)
    stream = read_files(spark, f"{path}/*.csv", static.schema, "csv", header="true")
    out = scratch_path(spark, "out")
    append_files(stream, out, scratch_path(spark, "checkpoint")).awaitTermination()
    assert same_rows(spark.read.parquet(out), static)


def test_no_batch_means_no_rows(spark, tables):
    spend = spend_of(tables.events)
    path = scratch_path(spark, "nothing")
    found = latest_updates(spark, path, spend.schema, KEYS)
    assert found.columns == spend.columns and found.isEmpty()


def test_batches_that_are_not_committed_are_not_read(spark, tables, event_files):
    path = scratch_path(spark, "spend")
    spend = spend_of(read_files(spark, event_files, tables.events.schema, files_per_trigger=1))
    assert latest_updates(spark, path, spend.schema, KEYS).count() == 0
    keep_updates(spend, path, scratch_path(spark, "cp")).awaitTermination()
    before = latest_updates(spark, path, spend.schema, KEYS).collect()
    half = spend_of(tables.events).withColumn("total_cost", F.lit(0).cast(spend.schema["total_cost"].dataType))
    quiet = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    half.write.option(quiet, "false").parquet(f"{path}/batch_id=99")
    assert sorted(latest_updates(spark, path, spend.schema, KEYS).collect()) == sorted(before)


def test_a_scratch_folder_can_be_dropped(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert drop_scratch(spark, path) and not drop_scratch(spark, path)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/elsewhere")


def folders(spark, path, kind):
    from tallywork.streaming.files import _folders

    return sorted(_folders(spark, path, kind))


def test_reading_cost_does_not_grow_with_the_batches(spark, tables):
    source, path, checkpoint = (scratch_path(spark, n) for n in ("source", "spend", "cp"))
    tables.events.repartition(24, "event_id").write.parquet(source)
    stream = read_files(spark, source, tables.events.schema, files_per_trigger=1)
    spend = spend_of(stream)
    keep_updates(spend, path, checkpoint, KEYS, merge_every=4).awaitTermination()
    result = latest_updates(spark, path, spend.schema, KEYS)
    assert same_rows(result, spend_of(tables.events))
    snapshots, batches = folders(spark, path, "upto"), folders(spark, path, "batch_id")
    assert 1 <= len(snapshots) <= 2 and len([b for b in batches if b > snapshots[-1]]) < 4 * 10
    assert len(batches) < 24  # the first ones are merged and gone
    # What a reader opens: one snapshot and the few batches after it.
    opened = {f.rsplit("/", 2)[1] for f in result.inputFiles()}
    assert len(opened) <= 1 + len([b for b in batches if b > snapshots[-1]])


def test_merged_results_go_on_after_a_restart(spark, tables):
    source, path, checkpoint = (scratch_path(spark, n) for n in ("source", "spend", "cp"))
    for part in range(6):
        arrived = tables.events.where(F.col("event_id") % 6 == part)
        arrived.coalesce(1).write.mode("append").parquet(source)
        spend = spend_of(read_files(spark, source, tables.events.schema, files_per_trigger=1))
        keep_updates(spend, path, checkpoint, KEYS, merge_every=2).awaitTermination()
        so_far = spend_of(tables.events.where(F.col("event_id") % 6 <= part))
        assert same_rows(latest_updates(spark, path, spend.schema, KEYS), so_far)
    assert folders(spark, path, "upto")


def test_a_merge_cut_off_changes_nothing(spark, tables):
    path, quiet = scratch_path(spark, "spend"), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    schema = T.StructType.fromDDL("k BIGINT, v BIGINT")

    def batch(number, rows):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    batch(0, [(1, 10), (2, 20)])
    batch(1, [(2, 21), (3, 30)])
    # A snapshot that a lost driver left half written has no mark: it is not read, and is replaced.
    spark.createDataFrame([(9, 9, 1)], "k long, v long, batch_id long").write.option(quiet, "false").parquet(f"{path}/upto=1")
    assert rows(latest_updates(spark, path, schema, ["k"])) == [(1, 10), (2, 21), (3, 30)]
    assert merge_updates(spark, path, schema, ["k"], 2) and folders(spark, path, "upto") == [1]
    assert rows(latest_updates(spark, path, schema, ["k"])) == [(1, 10), (2, 21), (3, 30)]
    # A batch that is repeated after its merge is covered already.
    batch(1, [(2, 21), (3, 30)])
    assert rows(latest_updates(spark, path, schema, ["k"])) == [(1, 10), (2, 21), (3, 30)]
    assert not merge_updates(spark, path, schema, ["k"], 2)
    for number in range(2, 6):
        batch(number, [(number, number), (1, 100 + number)])
        merge_updates(spark, path, schema, ["k"], 2)
    assert rows(latest_updates(spark, path, schema, ["k"])) == [(1, 105), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert folders(spark, path, "upto") == [3, 5] and folders(spark, path, "batch_id") == [4, 5]


def test_late_events_are_left_out(spark, tables):
    from tallywork.plans.streams import st_daily_spend, st_late_events

    all_of_them = st_daily_spend(tables).agg(F.sum("total_cost")).first()[0]
    in_time = st_late_events(tables).agg(F.sum("total_cost")).first()[0]
    assert 0.5 * all_of_them < in_time < 0.98 * all_of_them
