"""Joins that stay whole and spread out when one key holds much of a side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.operators.sizes import reads_little
from tallywork.operators.sketches import frequent_estimates

Keys = Sequence[tuple[str, str]]


def _key_set(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct keys under names of their own, so that they clash with no other column."""
    return df.select(*[F.col(n).alias(f"_key_{i}") for i, n in enumerate(names)]).distinct()


def _equal(pairs: Keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(l) == F.col(r) for l, r in pairs])


def _equal_in_own_shuffle(left: DataFrame, right: DataFrame, pairs: Keys) -> Column:
    """Equal keys, and equal hashes of them.

    AQE splits a hot key only if both sides of a join are shuffled for that join. A side that
    a grouping has left partitioned by the key would not be; the hash as one more key has it
    shuffled again. Keys of unlike types hash differently and go without.
    """
    same = _equal(pairs)
    if any(left.schema[l].dataType != right.schema[r].dataType for l, r in pairs):
        return same
    left_hash = F.xxhash64(*[F.col(l) for l, _ in pairs])
    return same & (left_hash == F.xxhash64(*[F.col(r) for _, r in pairs]))


def _against_keys(left: DataFrame, right: DataFrame, on: Keys, how: str) -> DataFrame:
    keys = _key_set(right, [r for _, r in on])
    pairs = [(l, f"_key_{i}") for i, (l, _) in enumerate(on)]
    return left.join(keys, _equal_in_own_shuffle(left, keys, pairs), how)


def having_match(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Left rows with a match, each once (semi join).

    The right side is cut to its distinct keys before the shuffle.
    """
    return _against_keys(left, right, on, "left_semi")


def without_match(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    """Left rows without a match (anti join); a null key never matches, so its row stays."""
    return _against_keys(left, right, on, "left_anti")


HOT_ROWS = 500_000  # rows of one key that one task may join
HOT_KEYS = 1_000  # keys a side that may be found hot
TRACKED = 8_192  # keys that each sketch of frequent keys holds


def hot_keys(df: DataFrame, key: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``key`` and ``parts``: the frequent keys of a frame, and how many tasks' worth of rows each has.

    Found by a sketch of frequent items, which every task fills from its own rows. A key with a
    share above some 3.5 / TRACKED is surely found, a count may come out too large, and no key
    is reported that does not occur. Null is no key. At most ``HOT_KEYS`` rows.
    """
    found = frequent_estimates(df, {"key": key}, HOT_KEYS, TRACKED)
    return found.where((F.col("estimate") > hot_rows) & F.col("item").isNotNull()).select(
        F.col("item").alias("key"), F.ceil(F.col("estimate") / hot_rows).cast("int").alias("parts")
    )


def _unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _one_key(df: DataFrame, names: Sequence[str]) -> Column:
    """The join key as one column: itself, or the text of all its parts (null if one is)."""
    if len(names) == 1:
        return F.col(names[0])
    # Zeros of either sign are equal as keys, so they need one text.
    parts = [
        F.col(n) + 0 if df.schema[n].dataType.typeName() in ("double", "float") else F.col(n) for n in names
    ]
    whole = F.to_json(F.array(*[p.cast("string") for p in parts]))
    return F.when(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]), whole)


def _place(df: DataFrame, into: Column) -> Column:
    """A number below ``into`` that follows from the row alone, so a repeated task gives it again."""
    hashed = [F.col(f"`{f.name}`") for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*hashed), into).cast("int")


def spread_outer_join(
    left: DataFrame, right: DataFrame, on: Keys, how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """An outer join in which a hot key is dealt over many tasks; each side is shuffled once.

    A key with many rows on the left is cut into ``a`` parts, one with many on the right into
    ``b``: left rows go to one of the ``a`` parts and are repeated for each of the ``b``, right
    rows the other way round, so each pair meets exactly once. A sketch reports only keys that
    occur, so a row repeated for the other side's parts has a partner in some of them: without
    one in a part it is left out there. Rows not repeated are unmatched exactly if they have no
    partner. Rows with a null key never match; they are dealt out evenly. Rows equal in all
    columns stay together.
    """
    left_key, right_key = (_one_key(df, [pair[i] for pair in on]) for i, df in enumerate((left, right)))
    a, b, hot, salt, left_b, right_a = (_unused(n, left, right) for n in ("_a", "_b", "_hot", "_salt", "_left_b", "_right_a"))
    most = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = hot_keys(left, left_key, hot_rows).select(F.col("key").alias(hot), F.col("parts").alias(a), F.lit(1).alias(b))
    both = both.unionByName(
        hot_keys(right, right_key, hot_rows).select(F.col("key").alias(hot), F.lit(1).alias(a), F.col("parts").alias(b))
    )
    parts = F.broadcast(  # at most 2 * HOT_KEYS rows
        both.groupBy(hot).agg(*[F.least(F.max(n), F.lit(most)).alias(n) for n in (a, b)])
    )

    def salted(df: DataFrame, key: Column, own: str, other: str, repeats: str, order) -> DataFrame:
        known = df.join(parts, key == F.col(hot), "left").withColumns(
            {own: F.when(key.isNull(), most).otherwise(F.coalesce(own, F.lit(1))), other: F.coalesce(other, F.lit(1))}
        )
        dealt = known.withColumn(own, _place(df, F.col(own))).withColumn(repeats, F.col(other))
        salts = F.transform(F.sequence(F.lit(0), F.col(other) - 1), lambda n: order(F.col(own), n))
        return dealt.withColumn(salt, F.explode(salts)).drop(hot, own, other)

    # The salt is the pair (part on the left, part on the right) as one number.
    ours = salted(left, left_key, a, b, left_b, lambda i, j: i.cast("long") * most + j)
    theirs = salted(right, right_key, b, a, right_a, lambda j, i: i.cast("long") * most + j)
    theirs = theirs.withColumnRenamed(salt, f"{salt}r")
    joined = ours.join(theirs, _equal(on) & (F.col(salt) == F.col(f"{salt}r")), how)
    met = F.col(left_b).isNotNull() & F.col(right_a).isNotNull()
    whole = F.coalesce(left_b, right_a) == 1  # no copy elsewhere
    return joined.where(met | whole).select(*left.columns, *right.columns)


def outer_join(
    left: DataFrame, right: DataFrame, on: Keys, how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``left``, ``right`` or ``full`` outer join that holds when one key has much of a side.

    AQE splits a hot key on the kept side of an outer join, but never on the filled side and
    not at all in a full one; ``spread_outer_join`` does without. Where the sides read little,
    or their keys are of unlike types, it is Spark's own join.
    Column names must differ between the sides: rename first.
    """
    if how not in ("left", "right", "full"):
        raise ValueError(f"unknown outer join: {how}")
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if shared:
        raise ValueError(f"rename before the join: {', '.join(sorted(shared))}")
    unlike = any(left.schema[l].dataType != right.schema[r].dataType for l, r in on)
    if unlike or reads_little(left, right):
        return left.join(right, _equal(on), how)
    return spread_outer_join(left, right, on, how, hot_rows)


def contains_join(left: DataFrame, array: str, right: DataFrame, element: str) -> DataFrame:
    """Pairs whose left array holds the right element.

    ``array_contains`` as a join condition compares every pair of rows. Here each distinct
    array element becomes a row and meets the other side in an equi-join.
    """
    exploded = left.withColumn("_item", F.explode(F.array_distinct(array)))
    elements = right.withColumn("_element", F.col(element))
    same = _equal_in_own_shuffle(exploded, elements, [("_item", "_element")])
    return exploded.join(elements, same).drop("_item", "_element")


def is_small(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """Whether a frame stays within both bounds; reads at most ``max_rows + 1`` rows."""
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    rows, width = (
        df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    )
    return rows <= max_rows and width <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = 100_000, max_bytes: int = 8 * 1024 * 1024
) -> DataFrame:
    """Hint a broadcast once the size is checked; a larger frame is left to a shuffled join."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def all_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of rows of two dimension tables. The result has the product of their sizes."""
    return left.crossJoin(right)
