"""Helpers that several operators of this package use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywork.session import scratch_root


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


BATCH_ROWS = 1_000  # whole texts that travel between Spark and Python at a time
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def with_texts(df: DataFrame) -> DataFrame:
    """The frame, in a session that hands no more than ``BATCH_ROWS`` rows at a time to Python.

    Texts are long: Spark's usual ten thousand would take a task hundreds of megabytes. The
    session keeps the setting, as plans run after the call that builds them; a smaller one of
    the caller's stays.
    """
    conf = df.sparkSession.conf
    now = int(conf.get(_BATCH_SETTING))
    if now <= 0 or now > BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return df


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage with a copy that outlives any executor; used where a frame is read more
    than once, or where an iteration would otherwise grow its plan.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tallywork/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def added(schema: T.StructType, name: str) -> T.StructType:
    """The schema with one more column of doubles."""
    return T.StructType([*schema.fields, T.StructField(name, T.DoubleType())])


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def whole_groups(
    batches: Iterator[pa.RecordBatch], names: tuple[str, ...], most: int = 20_000
) -> Iterator[pa.Table]:
    """Sorted batches dealt anew, so that rows with equal ``names`` come together.

    Hands on once ``most`` rows wait; a group beyond that is waited for, so groups must be bounded.
    """
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in waiting) < most:
            continue
        rows = pa.concat_tables(waiting)
        last = [rows.column(n)[-1].as_py() for n in names]
        cut = _first_of_last(rows, names, last)
        if cut:
            yield rows.slice(0, cut)
        waiting = [rows.slice(cut)]
    if waiting:
        yield pa.concat_tables(waiting)


def _first_of_last(rows: pa.Table, names: tuple[str, ...], last: list) -> int:
    """Number of the first row of the last group; groups lie together, so a bisection finds it."""
    low, high = 0, rows.num_rows - 1
    while low < high:
        middle = (low + high) // 2
        if [rows.column(n)[middle].as_py() for n in names] == last:
            high = middle
        else:
            low = middle + 1
    return low


def held_out(id_column: str, folds: int, fold: int):
    """Whether crc32 of the id as text falls into the fold that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(folds)) == fold, F.lit(False))


def components(links: DataFrame, nodes: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Connected components of undirected links: ``node`` and the smallest node it reaches.

    Alternating rounds hang every node's greater neighbours, then its smaller ones, on the
    smallest node known to it. Every round costs shuffles of the links only, keeps at most as
    many links as before, and is written to the shared folder. A node with very many links is
    met by aggregates with map-side combination and by joins that can be split, never by a
    list in one task. Ends when a round changes nothing.
    """
    a, b = (F.col(n) for n in nodes)
    edges = written(
        links.where(a != b)
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    total = _fingerprint(edges)
    while total[0]:
        # Every neighbour that is greater than a node goes to the least of all its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # Then the node and all smaller neighbours go to the least of these.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = written(small, "links")
        now = _fingerprint(edges)
        if now == total:
            break
        total = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))
    ).first()
    return tuple(row)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    target: str,
    folds: int,
    fold: int,
    per_class: tuple[int, int],
    chars: tuple[int, int],
    text: str = "text",
    key: str = "doc_id",
) -> tuple[list[tuple[str, int]], float | None]:
    """Labelled texts to learn from, in the driver, and the share of label 1.

    Rows of the held-out fold never get here. At most ``per_class`` documents of label 0 and 1
    are drawn by the hash of their id; their whole texts are taken in that order as long as the
    ``chars`` of a class last, and one that is longer than what is left is passed over. So the
    sample has a size that does not grow with the corpus, and no text is cut. The share is over all
    rows that may be learnt from. Of several labels for a document the greatest counts. Rows that
    share an id are one document, learnt from one of its texts, which is drawn by hash before
    anything is gathered; so an id with very many rows sends one row.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(target).isin(0, 1) & ~held_out(key, folds, fold))
        .groupBy(F.col(key).alias("_id"))
        .agg(F.max(target).cast("int").alias("_label"))
    )
    zeros, ones = known.agg(F.count_if(F.col("_label") == 0), F.count_if(F.col("_label") == 1)).first()
    if not zeros + ones:
        return [], None
    order = [F.xxhash64("_id", F.lit(17)), F.col("_id")]
    drawn = [known.where(F.col("_label") == v).orderBy(*order).limit(per_class[v]) for v in (0, 1)]
    ids = F.broadcast(drawn[0].unionByName(drawn[1]))
    has_text = F.col("_text").isNotNull()
    text_hash = F.when(has_text, F.xxhash64("_text", F.lit(17)))
    one = F.when(has_text, F.struct(text_hash.alias("hash"), F.length("_text").alias("chars")))
    given = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    # First what each would take, then the texts of those that there is room for.
    sizes = (
        given.join(ids, F.col("_key") == F.col("_id"))
        .groupBy("_id", "_label")
        .agg(F.min(one).alias("_one"), F.xxhash64("_id", F.lit(17)).alias("_draw"))
        .select("_id", "_label", "_draw", "_one.hash", F.coalesce("_one.chars", F.lit(0)).alias("chars"))
        .collect()
    )
    left, chosen = list(chars), []
    for r in sorted(sizes, key=lambda r: (r["_draw"], r["_id"])):
        if r["chars"] <= left[r["_label"]]:
            left[r["_label"]] -= r["chars"]
            chosen.append((r["_id"], r["_label"], r["hash"]))
    wanted = docs.sparkSession.createDataFrame(chosen, "_id long, _label int, _hash long")
    same = (F.col("_key") == F.col("_id")) & text_hash.eqNullSafe(F.col("_hash"))
    found = (
        given.join(F.broadcast(wanted), same)
        .groupBy("_id", "_label")
        .agg(F.coalesce(F.min("_text"), F.lit("")).alias("_text"))
        .collect()
    )
    # One order whatever the partitions.
    rows = sorted((r["_id"], r["_text"], r["_label"]) for r in found)
    return [(t, v) for _, t, v in rows], ones / (zeros + ones)
