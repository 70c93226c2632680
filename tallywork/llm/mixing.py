"""Mixing sources to target weights by proportionate-fair scheduling of blocks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywork.llm.shared import table

BLOCK_ROWS = 32  # documents of a source block
MAX_FRAME = 100_000  # slots of a frame: the sum of the weights, a parameter, not the data
REST = ""  # sources without a weight of their own, null among them, are mixed as one

# Production weights of the registered query, in blocks a frame.
WEIGHTS = {"src0": 8} | {f"src{i}": 4 for i in range(1, 5)} | {f"src{i}": 2 for i in range(5, 20)}
REST_WEIGHT = 1


def frame(weights: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """The slots of one frame, as (source, number of its block in the frame, slot).

    The frame has as many slots as the weights sum to. Block k of a source of weight w is
    released at floor(k * frame / w) and due at ceil((k + 1) * frame / w). Every slot goes to
    the released block with the earliest deadline. All deadlines are met, so after t slots
    each source has had t * w / frame blocks, give or take less than one; after the frame,
    exactly w. The next frame is then the same again.
    """
    if not weights or any(w < 1 or w != int(w) for w in weights.values()):
        raise ValueError("weights are whole numbers from 1 on")
    size = sum(weights.values())
    if size > MAX_FRAME:
        raise ValueError(f"weights sum to more than {MAX_FRAME}: give them in lower terms")
    done = dict.fromkeys(sorted(weights), 0)
    slots = []
    for slot in range(size):
        due = [
            (-(-(k + 1) * size // weights[s]), s)
            for s, k in done.items()
            if k < weights[s] and k * size // weights[s] <= slot
        ]
        deadline, source = min(due)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        slots.append((source, done[source], slot))
        done[source] += 1
    return slots


def mixed(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest_weight: int = 1,
    block_rows: int = BLOCK_ROWS,
    source: str = "source",
    key: str = "doc_id",
) -> DataFrame:
    """Every row with its place in the mixture: ``mix_block``, ``mix_slot``, ``mix_place``.

    Sorted by slot and place the rows are the mixture. In any first part of it, each source
    that still lasts has its share of the slots to within less than one block. No row is
    dropped or repeated: slots of a source that has run out stay empty, which leaves the
    others in their proportions. Sources not among the weights share ``rest_weight``.

    A source's rows are taken in the order of the md5 of their key, which is random to their
    content and the same in every run (rows with equal keys: in any order among themselves).
    Their ranks come from the counts of 4096 ranges of md5 values, so a source that holds most
    of the rows is ranked in as many parts. The frame has a size that the weights set, so it
    is broadcast; nothing else is, and nothing is gathered.
    """
    named = {s: int(w) for s, w in weights.items()} | {REST: int(rest_weight)}
    spark = docs.sparkSession
    slots = [(s, named[s], k, slot) for s, k, slot in frame(named)]
    frame_table = spark.createDataFrame(slots, "_mix_source string, _mix_weight long, _mix_turn long, _mix_slot long")
    size = sum(named.values())

    known = F.col(source).cast("string").isin(list(weights))
    parts = {
        "_mix_source": F.when(known, F.col(source).cast("string")).otherwise(REST),
        "_mix_hash": F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")),
    }
    rows = docs.withColumns(parts).withColumn("_mix_range", F.substring("_mix_hash", 1, 3))
    before = Window.partitionBy("_mix_source").orderBy("_mix_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        docs.select(source, key)
        .withColumns(parts)
        .groupBy("_mix_source", F.substring("_mix_hash", 1, 3).alias("_mix_range"))
        .agg(F.count("*").alias("_mix_rows"))
        .withColumn("_mix_before", F.coalesce(F.sum("_mix_rows").over(before), F.lit(0)))
        .drop("_mix_rows")
    )
    within = Window.partitionBy("_mix_source", "_mix_range").orderBy("_mix_hash", key)
    # The offsets have at most 4096 rows for each weight given, so their size is known.
    ranked = rows.withColumn("_mix_rank", F.row_number().over(within) - 1).join(
        F.broadcast(offsets), ["_mix_source", "_mix_range"]
    )
    rank = F.col("_mix_before") + F.col("_mix_rank")
    blocks = ranked.withColumns(
        {"mix_block": F.floor(rank / block_rows).cast("long"), "mix_place": (rank % block_rows).cast("int")}
    )
    weight_of = F.create_map(*[F.lit(x) for s, w in named.items() for x in (s, w)])[F.col("_mix_source")]
    turns = blocks.withColumn("_mix_turn", F.col("mix_block") % weight_of)
    placed = turns.join(F.broadcast(frame_table), ["_mix_source", "_mix_turn"])
    slot: Column = F.expr("mix_block div _mix_weight") * size + F.col("_mix_slot")
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], "mix_block", slot.alias("mix_slot"), "mix_place")


def in_order(rows: DataFrame, slots: int = 256) -> DataFrame:
    """Lay mixed rows out for writing: runs of whole slots, each in order within one file.

    A run of ``slots`` slots stays together, so any file holds the mixture at its weights.
    """
    return rows.repartition(F.expr(f"mix_slot div {slots}")).sortWithinPartitions("mix_slot", "mix_place")


def op2_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every document in the mixture."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixed(docs, WEIGHTS, REST_WEIGHT)


_NAMES = [REST, *sorted(WEIGHTS)]
_NAMED = WEIGHTS | {REST: REST_WEIGHT}

OP2_SQL = f"""
WITH RECURSIVE weights AS (
  SELECT {_NAMES!r} AS names, {[_NAMED[n] for n in _NAMES]!r} AS w, {sum(_NAMED.values())} AS size
),
steps(slot, done, pick) AS (
  SELECT -1, [0 FOR x IN names], 0 FROM weights
  UNION ALL
  SELECT slot + 1, [done[i] + CASE WHEN i = p THEN 1 ELSE 0 END FOR i IN range(1, len(names) + 1)], p
  FROM (
    SELECT slot, done, names, size, list_position(due, list_min(due)) AS p
    FROM (
      SELECT slot, done, names, size,
             [CASE WHEN done[i] < w[i] AND (done[i] * size) // w[i] <= slot + 1
                   THEN ((done[i] + 1) * size + w[i] - 1) // w[i] ELSE 1000000 END
              FOR i IN range(1, len(names) + 1)] AS due
      FROM steps, weights
      WHERE slot + 1 < size
    )
  )
),
frame AS (
  SELECT names[pick] AS name, w[pick] AS weight, size, slot, done[pick] - 1 AS turn
  FROM steps, weights WHERE pick > 0
),
ranked AS (
  SELECT doc_id, source, name,
         row_number() OVER (PARTITION BY name ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS r
  FROM (SELECT doc_id, source,
               CASE WHEN list_contains((SELECT names FROM weights), source) THEN source ELSE '{REST}' END AS name
        FROM documents)
)
SELECT doc_id, source, r // {BLOCK_ROWS} AS mix_block,
       (r // {BLOCK_ROWS} // weight) * size + slot AS mix_slot,
       CAST(r % {BLOCK_ROWS} AS INTEGER) AS mix_place
FROM ranked JOIN frame ON ranked.name = frame.name AND (r // {BLOCK_ROWS}) % weight = turn
"""
