"""Directories as unbounded tables, and sinks that survive a restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """A directory or glob as a stream. The schema must be given, say that of a static read."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows, or closed windows, as Parquet; exactly once through the sink's log."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


MERGE_EVERY = 10  # batches after which their folders are merged
SNAPSHOTS_KEPT = 2  # so that whoever reads the last but one can finish


def keep_updates(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None, merge_every: int = MERGE_EVERY
) -> StreamingQuery:
    """Write the groups that each micro-batch changed below ``batch_id=<n>``.

    A repeated batch overwrites its own folder, so a restart leaves no duplicates. Work per
    batch follows the changed groups; ``complete`` mode would rewrite the whole result.

    With ``keys``, the batches since the last merge are merged into a new ``upto=<n>`` folder once
    they are ``merge_every`` and not much smaller than the result, or ten times as many. So what
    a reader opens does not grow with the number of batches, and a large result is not rewritten
    for a few changes.
    """
    schema = stream.schema

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys is not None:
            merge_updates(batch.sparkSession, path, schema, keys, merge_every)

    return (
        stream.writeStream.foreachBatch(save)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folders(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Committed folders ``<kind>=<number>`` by number: those whose writer has put its mark there."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}=*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(s.getPath().getParent()) for s in files.globStatus(pattern) or []]
    return {int(f.rsplit("=", 1)[1]): f for f in found}


def _size(spark: SparkSession, folders: list[str]) -> int:
    total = 0
    for folder in folders:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return total


def _drop(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def merge_updates(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str], merge_every: int = MERGE_EVERY
) -> bool:
    """Merge the batches since the last snapshot into a new one, if it is time for it.

    A snapshot holds the last row of each key up to its batch. It counts once the mark that
    Spark's writer leaves at the end is there, so a merge that is cut off changes nothing and is
    done again. Folders that the last but one snapshot covers are then removed.
    """
    snapshots, batches = (_folders(spark, path, kind) for kind in ("upto", "batch_id"))
    newest = max(snapshots, default=-1)
    since = [batches[n] for n in sorted(batches) if n > newest]
    much = newest < 0 or 4 * _size(spark, since) >= _size(spark, [snapshots[newest]])
    if len(since) < merge_every or not (much or len(since) >= 10 * merge_every):
        return False
    last = max(batches)
    _latest(spark, path, schema, keys).write.mode("overwrite").parquet(f"{path}/upto={last}")
    snapshots[last] = f"{path}/upto={last}"
    kept = sorted(snapshots)[-SNAPSHOTS_KEPT:]
    for number, folder in snapshots.items():
        if number not in kept:
            _drop(spark, folder)
    for number, folder in batches.items():
        if len(kept) == SNAPSHOTS_KEPT and number <= kept[0]:
            _drop(spark, folder)
    return True


def _latest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The last row of each key, with the ``batch_id`` it came in."""
    with_batch = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    snapshots = _folders(spark, path, "upto")
    newest = max(snapshots, default=-1)
    later = [f for n, f in sorted(_folders(spark, path, "batch_id").items()) if n > newest]
    updates = spark.createDataFrame([], with_batch)
    if later:
        updates = spark.read.schema(with_batch).option("basePath", path).parquet(*later)
    if newest >= 0:
        updates = updates.unionByName(spark.read.schema(with_batch).parquet(snapshots[newest]))
    rest = [name for name in schema.fieldNames() if name not in keys]
    return (
        updates.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch_id").alias("_last"), F.max("batch_id").alias("batch_id"))
        .select(*keys, "_last.*", "batch_id")
    )


def latest_updates(
    spark: SparkSession, path: str, schema: T.StructType, keys: list[str]
) -> DataFrame:
    """The running result: for each key the row of the last batch that changed it.

    No batch yet means no rows. A batch counts once its folder is committed, so one that a lost
    driver left half written is not read before it is repeated. Reads the newest snapshot, if
    batches are merged, and the batches after it.
    """
    return _latest(spark, path, schema, keys).drop("batch_id")


def to_memory_table(stream: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """The whole running result as a named table in the driver.

    Only for results of a known small size, such as one row per event type; use
    ``keep_updates`` otherwise.
    """
    return (
        stream.writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
